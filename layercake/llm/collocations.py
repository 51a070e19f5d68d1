"""Phrases whose words belong together, counted by an FM-index per shard (operator 13).

A task cuts its documents into shards of some million words, one index per shard and language. The index sorts the
places of the shard's word ids by the words that follow, as far as the longest phrase reaches, and keeps the
word before each place (the Burrows-Wheeler transform); a second one does so for the reversed text. Starting from
single words, an interval of places is extended by the word to its left: the words before its places, grouped,
are the extensions with their counts, and the same grouping moves the interval of the reversed index along. From
there on intervals are extended to the right. All intervals of one depth are extended at once, by one sort.
Shards' counts are summed by Spark.

Most pairs of words are rare, and a phrase is frequent only if all its pairs are. So a first pass sums pairs by a
64-bit hash; the hashes of frequent ones set bits of a filter of fixed size, which every task of the second pass
gets. The filter lets no frequent phrase go; what it lets through in error is counted and found rare.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from layercake.llm.scratch import Scratch
from layercake.llm.text import table
from layercake.llm.workers import give_back, ship

SHARD_WORDS = 1_000_000
FILTER_BITS = 26  # 8 MB
RANK_PARTS = 256
NO_LANGUAGE = "und"
BREAK = b"\n"  # stands for every mark between pieces
MARKS = b".,;:!?\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + MARKS + b"\t", bytes(range(97, 123)) + BREAK * len(MARKS) + b" "
)


class Shard:
    """Texts of one language as one row of word ids; 0 stands between pieces."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[BREAK]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> int:
        """Takes the words of a text: A-Z lower-cased, pieces cut at marks and line ends, words at spaces and tabs.
        Returns by how much the shard has grown."""
        found = text.translate(_PLAIN).replace(BREAK, b" \n ").split(b" ")
        ids = list(map(self.number.__getitem__, filter(None, found)))
        if ids:
            self.parts.append(np.array([*ids, 0], np.int32))
            self.size += len(ids) + 1
        return len(ids) + 1

    def ids(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.int32), *self.parts])

    def words(self) -> list[bytes]:
        return list(self.number)


class Index:
    """Places of a row of ids in the order of the ``depth`` ids from there on, and the id before each place."""

    def __init__(self, ids: np.ndarray, depth: int):
        n, reach, keys = len(ids), 1, ids.astype(np.int64)
        order = np.argsort(keys, kind="stable")
        while reach < depth:
            ranks = np.empty(n, np.int64)
            ranks[order] = np.cumsum(np.append(0, np.diff(keys[order]) != 0))
            later = np.zeros(n, np.int64)
            later[: n - reach] = ranks[reach:] + 1
            keys = ranks * (n + 1) + later
            order, reach = np.argsort(keys, kind="stable"), 2 * reach
        self.before = ids[order - 1].astype(np.int64)  # that of the first place is the last id; both are breaks
        self.limit = int(ids.max()) + 1
        self.starts = np.searchsorted(ids[order], np.arange(self.limit + 1))

    def extend(self, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
        """Intervals of places, each extended by every word before it: (interval, word, count, how many places of the
        interval have a smaller id before them, the first place with that word), by interval and word."""
        first = np.cumsum(width) - width
        of = np.repeat(np.arange(len(low)), width)
        places = np.arange(len(of)) + (low - first)[of]
        keys = of * self.limit + self.before[places]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        start = np.flatnonzero(np.append(True, np.diff(keys) != 0)[: len(keys)])
        count = np.diff(np.append(start, len(keys)))
        of, words = np.divmod(keys[start], self.limit)
        found = words > 0  # a break extends nothing, but is smaller than words
        return of[found], words[found], count[found], (start - first[of])[found], places[order[start[found]]]

    def lows(self, places: np.ndarray) -> np.ndarray:
        """Where the intervals of extended phrases begin: as many places before hold the same word before them."""
        order = np.argsort(self.before, kind="stable")
        step = np.empty(len(order), np.int64)
        step[order] = np.arange(len(order))
        return step[places]


def phrases(ids: np.ndarray, longest: int, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases, counts) for each length up to ``longest``, a phrase being a row of word ids. Of two words or more, only
    phrases all of whose neighbours ``keep(left words, right words)`` lets through."""
    forward = Index(ids, 1)
    words = np.arange(1, forward.limit)
    width = np.diff(forward.starts)[1:]
    yield words[:, None], width
    if longest < 2:
        return
    of, left, width, smaller, _ = forward.extend(forward.starts[1:-1], width)
    found = np.stack([left, words[of]], 1)
    kept = keep(*found.T)
    found, width, smaller = found[kept], width[kept], smaller[kept]
    yield found, width
    if longest < 3:
        return
    # Reversed, the pair begins with its last word; it lies in that word's interval, after the pairs with smaller words.
    backward = Index(ids[::-1], longest - 1)
    low = backward.starts[found[:, 1]] + smaller
    for length in range(3, longest + 1):
        of, right, count, _, places = backward.extend(low, width)
        kept = keep(found[of, -1], right)
        found, width = np.column_stack([found[of], right])[kept], count[kept]
        yield found, width
        if length < longest:
            low = backward.lows(places[kept])


def word_hashes(words: list[bytes], language: str) -> np.ndarray:
    def digest(x: bytes) -> int:
        return int.from_bytes(blake2b(x, digest_size=8).digest(), "little")

    return np.array([digest(w) for w in words], np.uint64) + np.uint64(digest(b"\n" + language.encode()))


def pair_hashes(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = hashes[left] * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) + hashes[right]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Shard]]:
    """Batches of (language, text) as shards of some million words."""
    made, held = defaultdict(Shard), 0
    for b in batches:
        texts = b.column(1).cast(pa.binary())
        for language, text in zip(b.column(0).to_pylist(), texts, strict=True):
            shard = made[NO_LANGUAGE if language is None else language]
            held += shard.add(text.as_py() or b"")
            if held >= SHARD_WORDS:
                yield from made.items()
                made, held = defaultdict(Shard), 0
        give_back()
    yield from made.items()


def frequent_pairs(texts: DataFrame, least: int) -> np.ndarray:
    """Bits of a filter of fixed size: those of the hashes of all pairs that occur ``least`` times."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, shard in shards(batches):
            if shard.size:
                hashes = word_hashes(shard.words(), language)
                _, (pairs, counts) = phrases(shard.ids(), 2, lambda left, right: np.ones(len(left), bool))
                pairs = pair_hashes(hashes, *pairs.T).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    counted = texts.mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    slots = counted.filter(F.col("n") >= least).select(F.expr(f"pair & {(1 << FILTER_BITS) - 1}L AS slot"))
    cells = slots.groupBy(F.expr("slot >> 6 AS cell")).agg(F.expr("bit_or(shiftleft(1L, int(slot & 63))) AS bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return bits


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, words, phrase, n): all words with their counts, all phrases of 2 to ``longest`` words that occur
    ``least`` times or more, and per language one row without a phrase that counts all words."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    sent = spark.sparkContext.broadcast(frequent_pairs(texts, least))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, shard in shards(batches):
            words = shard.words()
            hashes, names = word_hashes(words, language), pa.array(words, pa.binary()).cast(pa.string())

            def keep(left: np.ndarray, right: np.ndarray, hashes: np.ndarray = hashes) -> np.ndarray:
                slot = pair_hashes(hashes, left, right).view(np.int64) & ((1 << FILTER_BITS) - 1)
                return (sent.value[slot >> 6] >> (slot & 63)) & 1 == 1

            def made(length: int, phrase: pa.Array, counts: np.ndarray, language: str = language) -> pa.RecordBatch:
                n = len(counts)
                columns = [pa.repeat(language, n), pa.repeat(pa.scalar(length, pa.int32()), n), phrase, pa.array(counts, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])

            ids = shard.ids()
            yield made(0, pa.nulls(1, pa.string()), np.array([np.count_nonzero(ids)]))
            if shard.size:
                for found, counts in phrases(ids, longest, keep):
                    parts = [names.take(pa.array(c)) for c in found.T]
                    yield made(found.shape[1], pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0], counts)

    counted = texts.mapInArrow(work, "lang string, words int, phrase string, n long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter((F.col("words") < 2) | (F.col("n") >= least))


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    top: int = 2_000,
    covered_percent: int = 50,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``longest`` words whose words belong together: rank, phrase, its count
    ``a``, the counts ``l`` and ``r`` of its two parts at the cut with the lowest score, the language's
    words ``n``, and the score in millionths, a * a / (l * r).

    A phrase occurs ``least`` times or more, and no longer one that contains it has ``covered_percent`` of its count.
    Null languages count as ``und``, null and empty texts hold no words, repeated rows count each, an empty table
    has no phrases; other columns are not read. A long text is in one shard, and phrases never reach over marks. Ties
    of rank go by count, then by the phrase's bytes. Products are decimals of 38 digits, exact up to counts of 10^15.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    counts = scratch.put(phrase_counts(docs, longest, least, text, lang), "counts")
    candidates = counts.filter("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"))
    parts = counts.filter(F.col("words").between(1, longest - 1)).filter(F.col("n") >= least)

    split = candidates.withColumn("w", F.split("phrase", " "))
    if longest > 2:
        shorter = f"""explode(flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1),
            i -> array_join(slice(w, i, k), ' '))))) AS phrase"""
        inside = split.filter("words > 2").select("lang", F.expr(shorter), F.col("a").alias("longer"))
        both = candidates.withColumn("longer", F.lit(None).cast("long")).unionByName(
            inside.select("lang", F.lit(None).cast("int").alias("words"), "phrase", F.lit(None).cast("long").alias("a"), "longer")
        )
        # One row per phrase leaves a map task, however many longer phrases contain it.
        whole = both.groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.max("a").alias("a"), F.max("longer").alias("longer"))
        kept = whole.filter(f"a IS NOT NULL AND NOT coalesce(100 * longer >= {int(covered_percent)} * a, false)")
        split = kept.drop("longer").withColumn("w", F.split("phrase", " "))

    cut = split.select(
        "lang", "phrase", "a", F.explode(F.expr("transform(sequence(1, words - 1), k -> struct(k, array_join(slice(w, 1, k), ' ') AS first, array_join(slice(w, k + 1, words), ' ') AS rest))")).alias("cut")
    ).select("lang", "phrase", "a", "cut.*")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    wide = [F.col(c).cast("decimal(38,0)") for c in "alr"]
    score = F.expr("bigint((da * da * 1000000BD) div (dl * dr))")
    scored = (
        cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        .withColumns(dict(zip(("da", "dl", "dr"), wide)))
        .withColumn("score", score)
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x"))
        .select("lang", "phrase", "x.a", "x.l", "x.r", "x.score")
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language's phrases are cut into parts first, so that its last task sees no more than the best of each part.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).cast("int")
    of_part = Window.partitionBy("lang", "part").orderBy(*order)
    scored = scored.withColumn("part", part).withColumn("rank", F.row_number().over(of_part)).filter(F.col("rank") <= top)
    best = Window.partitionBy("lang").orderBy(*order)
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
