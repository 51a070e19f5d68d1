"""Benchmark decontamination with a distributed positional inverted index (operator 4).

Benchmark items become windows of consecutive words. The training texts are indexed by position, for the
terms that decide: every window is looked up by its two rarest terms, by their counts in all training
texts. Their postings (term, document, position) are stored in the shared folder. A posting less its
term's offset in the window is where the window would begin; the lists of both terms are intersected on
(document, window, begin), the rarest first. What is left is compared word by word with the text, which
gives exact phrase matches. ``proximity_matches`` finds rare terms near each other instead.

Everything is built-in expressions and joins on equality. The benchmark's terms and windows are broadcast
only if they are few; else Spark shuffles, and splits frequent terms at run time. A text is identified by
its id and its hash, so ids may repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layercake.llm.text import UPPER, lower_words, numbers, table, without
from layercake.session import written

# Whatever in ASCII is no letter and no digit; all characters beyond ASCII belong to words.
SEPARATORS = "".join(c for c in map(chr, range(128)) if not (c.isdigit() or c in UPPER + UPPER.lower()))
WINDOW = 13
SMALL_ROWS = 200_000  # of ids or short terms: some ten megabytes at most
RESULTS = ["n_words", "n_hit", "n_items", "items", "contaminated"]


def terms(text: Column) -> Column:
    return lower_words(text, SEPARATORS)


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; else Spark decides how to join it."""
    return F.broadcast(df) if df.count() <= rows else df


def item_windows(items: DataFrame, item: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """(item, start, words) of every window; an item of fewer words is one window. A null id reads as ''."""
    cut = items.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("item"), terms(F.col(f"`{text}`")).alias("ws")
    ).filter(F.size("ws") > 0)
    starts = numbers(F.greatest(F.size("ws") - (width - 1), F.lit(1)))
    return cut.select("item", "ws", F.explode(starts).alias("start")).select(
        "item", "start", F.slice("ws", F.col("start") + 1, F.lit(width)).alias("words")
    )


def term_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each wanted term occurs in the texts of ``docs`` (column ``_text``)."""
    every = docs.select(F.explode(terms(F.col("_text"))).alias("term"))
    return every.join(small(wanted), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def postings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, _id, _hash, pos) of the wanted terms: the positional index, from which terms are fetched."""
    every = docs.select("_id", "_hash", F.posexplode(terms(F.col("_text"))).alias("pos", "term"))
    return every.join(small(wanted), "term")


def rarest_terms(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, each with its two rarest terms and their offsets.

    ``windows`` has ``window`` (an id) and ``words``.
    """
    each = windows.select("window", "words", F.posexplode("words").alias("offset", "term")).join(counts, "term")
    ranked = each.groupBy("window", "words").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("n", "term", "offset"))), 1, 2).alias("rare"),
        F.count(F.lit(1)).alias("present"),
    )
    first, second = F.get("rare", F.lit(0)), F.coalesce(F.get("rare", F.lit(1)), F.get("rare", F.lit(0)))
    return ranked.filter(F.col("present") == F.size("words")).select(
        "window",
        "words",
        F.struct(first["term"].alias("term"), first["offset"].alias("offset")).alias("first"),
        F.struct(second["term"].alias("term"), second["offset"].alias("offset")).alias("second"),
    )


def begins(index: DataFrame, windows: DataFrame, which: str) -> DataFrame:
    """Where windows would begin, from the postings of one of their terms."""
    looked = windows.select("window", F.col(f"{which}.term").alias("term"), F.col(f"{which}.offset").alias("offset"))
    found = index.join(small(looked), "term").withColumn("begin", F.col("pos") - F.col("offset"))
    return found.filter("begin >= 0").select("_id", "_hash", "window", "begin")


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{key}`").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_hash"), F.col(f"`{text}`").alias("_text")
    )


def phrase_matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(_id, _hash, window, begin, length) of every exact occurrence of a window in ``docs``."""
    vocabulary = written(windows.select(F.explode("words").alias("term")).distinct(), "terms")
    lookup = written(rarest_terms(windows, term_counts(docs, vocabulary)), "windows")
    wanted = written(lookup.select("first.term").union(lookup.select("second.term")).distinct(), "terms")
    index = written(postings(docs, wanted), "postings")
    same = ["_id", "_hash", "window", "begin"]
    mine, theirs = begins(index, lookup, "first"), begins(index, lookup, "second")
    on = mine["_id"].eqNullSafe(theirs["_id"])
    for c in same[1:]:
        on = on & (mine[c] == theirs[c])
    both = mine.join(theirs, on, "left_semi").distinct()
    with_words = both.join(small(lookup.select("window", "words")), "window")
    place = F.struct("begin", "window", "words")
    likely = written(with_words.groupBy("_id", "_hash").agg(F.collect_list(place).alias("places")), "candidates")
    some = docs.join(small(likely.select("_id", "_hash").distinct()), _same_text(docs, likely), "left_semi")
    read = some.select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), terms(F.col("_text")).alias("ws")).dropDuplicates(["_i", "_h"])
    checked = likely.join(read, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")))
    found = F.filter("places", lambda p: F.slice(F.col("ws"), p["begin"] + 1, F.size(p["words"])) == p["words"])
    hits = checked.select("_id", "_hash", F.explode(found).alias("p"))
    return hits.select("_id", "_hash", "p.window", "p.begin", F.size("p.words").alias("length"))


def _same_text(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_hash"] == right["_hash"])


def proximity_matches(docs: DataFrame, items: DataFrame, within: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item, near): how often an item's two rarest terms stand at most ``within`` words apart.

    Positions meet by blocks of ``within`` words, so no pairs are made of a document's whole lists.
    """
    source = identified(docs, key, text)
    whole = item_windows(items, width=2**30).groupBy("item").agg(F.max("words").alias("words"))
    named = whole.select(F.col("item").alias("window"), F.array_distinct("words").alias("words"))
    counts = term_counts(source, named.select(F.explode("words").alias("term")).distinct())
    lookup = written(rarest_terms(named, counts).filter("first.term <> second.term"), "windows")
    wanted = lookup.select("first.term").union(lookup.select("second.term")).distinct()
    index = written(postings(source, wanted).distinct(), "postings")

    def of(which: str, name: str) -> DataFrame:
        term = lookup.select("window", F.col(f"{which}.term").alias("term"))
        return index.join(small(term), "term").select("_id", "_hash", "window", F.col("pos").alias(name))

    block = F.floor(F.col("p1") / within)
    left = of("first", "p1").withColumn("b", F.explode(F.array(block - 1, block, block + 1)))
    right = of("second", "p2").withColumn("b", F.floor(F.col("p2") / within)).withColumnsRenamed({"_id": "_i", "_hash": "_h", "window": "w", "b": "c"})
    on = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")) & (F.col("window") == F.col("w")) & (F.col("b") == F.col("c"))
    near = left.join(right, on).filter(F.abs(F.col("p1") - F.col("p2")) <= within)
    return near.groupBy(F.col("_id").alias(key), "_hash", F.col("window").alias("item")).agg(F.count(F.lit(1)).alias("near")).drop("_hash")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WINDOW,
    share: int = 20,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``n_items`` and ``items``
    (ids as text, sorted) of the items that occur, and ``contaminated``: one word in ``share`` is hit.

    Null and empty texts have no words and no hits; repeated rows are judged alike; without items nothing
    is hit. Input columns named like a result are replaced. Rows with a null key are judged like others.
    """
    source = identified(docs, key, text)
    every = written(item_windows(benchmark, width=width), "items")
    named = every.groupBy("words").agg(F.min(F.struct("item", "start")).alias("window"))
    hits = written(phrase_matches(source, named.select("window", "words")), "hits")
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def cover(acc: Column, x: Column) -> Column:
        end = x["begin"] + x["length"]
        fresh = F.greatest(end - F.greatest(x["begin"], acc["reach"]), F.lit(0))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["reach"], end).alias("reach"))

    hit = hits.select("_id", "_hash", "begin", "length").distinct().groupBy("_id", "_hash").agg(
        F.aggregate(F.sort_array(F.collect_list(F.struct("begin", "length"))), begin, cover, lambda a: a["n"]).alias("_hit")
    )
    owners = every.join(named, "words").select("window", "item").distinct()
    which = hits.select("_id", "_hash", "window").distinct().join(small(owners), "window")
    which = which.groupBy("_id", "_hash").agg(F.sort_array(F.collect_set("item")).alias("_items"))
    found = hit.join(which, _same_text(hit, which)).select(hit["_id"].alias("_i"), hit["_hash"].alias("_h"), "_hit", "_items")
    mine = without(docs, [*RESULTS, "_i", "_h", "_hit", "_items"]).withColumn("_h0", F.xxhash64(F.col(f"`{text}`")))
    mine = mine.withColumn("n_words", F.size(terms(F.col(f"`{text}`"))).cast("long"))
    found = written(found, "found")
    joined = mine.join(small(found), mine[f"`{key}`"].eqNullSafe(found["_i"]) & (mine["_h0"] == found["_h"]), "left")
    n_hit = F.coalesce("_hit", F.lit(0)).cast("long")
    items = F.coalesce("_items", F.array().cast("array<string>"))
    return joined.withColumns(
        {
            "n_hit": n_hit,
            "n_items": F.size(items).cast("long"),
            "items": items,
            "contaminated": (n_hit > 0) & (share * n_hit >= F.col("n_words")),
        }
    ).drop("_h0", "_i", "_h", "_hit", "_items")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = decontaminate(docs, table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")
