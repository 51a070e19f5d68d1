"""Toxicity by averaged subword embeddings and a linear softmax (operator 1).

A word is the bag of its character n-grams and itself, hashed to rows of an embedding table. The vectors of
a window of words are averaged and go through a linear softmax over (clean, toxic). A text scores as its
most toxic window, so that a few words count alike in short and long texts. Embeddings and softmax are
trained jointly, in numpy, from labels of whole texts: while training, windows share a text's gradient by
how toxic they look. Misspelt words that no label has shown share n-grams with known ones. What has no
spaces, such as Chinese text or words glued by other marks, is read whole: a long word is cut into
overlapping pieces, each of which is a word of a window.

The average of linear scores is the linear score of the average: a worker computes one number per word,
remembers it, and reads texts of any length in one pass. Nothing is shuffled for scoring.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.text import table, without
from layercake.llm.workers import give_back, ship

PUNCTUATION = " \t\n\r\f\v.,;:!?\"'`()[]{}<>*#$%&|~^_=+-/\\…«»“”‘’¿¡"
WINDOW, STRIDE = 8, 4
SMALLEST, LARGEST = 3, 5
LONGEST = 30  # code points of a word; a longer one becomes pieces
PIECE, STEP = 6, 2  # each n-gram of a longer word is within a piece; a window of pieces spans some ten short words
KNOWN_WORDS = 150_000  # remembered per worker; beyond that it starts anew
WORDS_AT_ONCE = 20_000


def words_of(text: str | None) -> list[str]:
    """The words of a text. One of more than ``LONGEST`` code points is given as overlapping pieces of it."""
    words = text.lower().split() if text else []
    if not words or max(map(len, words)) <= LONGEST:
        return words
    return [p for w in words for p in ([w] if len(w) <= LONGEST else pieces(w))]


def pieces(word: str) -> list[str]:
    """Pieces that hang over both ends, so that n-grams there are in as many as those in the middle."""
    return [word[max(0, i) : i + PIECE] for i in range(-STEP, len(word) - SMALLEST + 1, STEP)]


def ngrams(words: Sequence[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of code points of all words, and where each word's begin; every word has one at least (itself)."""
    raw = [f"<{w.strip(PUNCTUATION)}>" for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    codes = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(raw)), lengths)
    mult = np.uint64(0x9E3779B97F4A7C15)
    found, owners = [], []
    whole = np.zeros(len(raw), np.uint64)
    for i in range(int(lengths.max()) if len(raw) else 0):
        has = lengths > i
        whole[has] = (whole[has] ^ codes[starts[has] + i]) * mult
        whole[has] ^= whole[has] >> np.uint64(29)
    found.append(whole)
    owners.append(np.arange(len(raw)))
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, LARGEST + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        rolling = (rolling[:size] ^ codes[n - 1 :]) * mult
        rolling ^= rolling >> np.uint64(31)
        if n >= SMALLEST:
            inside = np.flatnonzero(owner[:size] == owner[n - 1 :])
            found.append(rolling[inside] + np.uint64(n))
            owners.append(owner[inside])
    every, of = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    ids = ((every[order] * mult) >> np.uint64(40)) % np.uint64(buckets)
    return ids.astype(np.int64), np.searchsorted(of[order], np.arange(len(raw)))


def windows(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of a text's windows; together they hold all n words."""
    begin = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
    return begin, np.minimum(begin + WINDOW, max(n, 1))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class SubwordSoftmax:
    def __init__(self, buckets: int = 1 << 16, dim: int = 6, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
        self.softmax = rng.normal(0, 0.3, (dim, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.known: dict[str, float] = {}

    def vectors(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.table[ids], starts) / counts[:, None]

    def bags(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Table rows of all words, where each word's begin, and how many it has."""
        ids, starts = ngrams(words, len(self.table))
        return ids.astype(np.int32), starts, np.diff(np.append(starts, len(ids)))

    def fit(self, texts: Sequence[str], labels: Sequence[int], epochs: int = 10, largest_batch: int = 128, rate: float = 0.05, seed: int = 1):
        """Adam over batches in shuffled order. A label of the rarer class weighs more, by the square root of the odds.

        Without any text the model scores everything alike, as clean.
        """
        if not len(texts):
            self.table[:], self.softmax[:], self.bias[:] = 0, 0, (1, 0)
            return self
        rng, step = np.random.default_rng(seed), 0
        labels = np.asarray(labels)
        params = {"table": self.table, "softmax": self.softmax, "bias": self.bias}
        m = {k: np.zeros_like(x) for k, x in params.items()}
        v = {k: np.zeros_like(x) for k, x in params.items()}
        batch = min(largest_batch, max(16, len(texts) // 16))
        positive = max(1, int(labels.sum()))
        weights = np.where(labels == 1, np.sqrt(max(1, len(labels) - positive) / positive), 1.0)
        order = rng.permutation(len(texts))
        batches = [(self._batch([texts[i] for i in part]), part) for part in np.split(order, range(batch, len(order), batch)) if len(part)]
        rounds = epochs * len(batches)
        for epoch in range(epochs):
            sharp = 0.5 + 3.5 * epoch / max(1, epochs - 1)
            for at in rng.permutation(len(batches)):
                cut, part = batches[at]
                g = self._gradients(cut, labels[part], weights[part], sharp)
                step += 1
                now = rate * (1 - step / (rounds + 1))
                for k, x in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * x
                    v[k] = 0.99 * v[k] + 0.01 * x * x
                    params[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)
        return self

    def _batch(self, texts: Sequence[str | None]):
        """Bags of the distinct words of some texts, the words in order, and the windows of each text."""
        words: dict[str, int] = {}
        cut = [np.array([words.setdefault(w, len(words)) for w in words_of(t) or [""]], np.int32) for t in texts]
        spans, owner, base = [], [], 0
        for i, t in enumerate(cut):
            spans.append(np.stack(windows(len(t))) + base)
            owner.append(np.full(spans[-1].shape[1], i))
            base += len(t)
        return self.bags(list(words)), np.concatenate(cut), np.concatenate(spans, 1), np.concatenate(owner), len(cut)

    def _gradients(self, batch, labels: np.ndarray, weights: np.ndarray, sharp: float) -> dict[str, np.ndarray]:
        (ids, starts, counts), flat, (begin, end), of, texts = batch
        vectors = self.vectors(ids, starts, counts)
        sums = np.concatenate([np.zeros((1, vectors.shape[1])), np.cumsum(vectors[flat], 0, dtype=np.float64)])
        mean = ((sums[end] - sums[begin]) / (end - begin)[:, None]).astype(np.float32)
        logits = mean @ self.softmax + self.bias
        score = logits[:, 1] - logits[:, 0]
        first = np.searchsorted(of, np.arange(texts))
        top = np.maximum.reduceat(score, first)
        share = np.exp(sharp * (score - top[of]))
        share /= np.add.reduceat(share, first)[of]
        whole = np.add.reduceat(share * score, first)
        error = (((sigmoid(whole) - labels) * weights)[of] * share / texts).astype(np.float32)
        both = np.stack([-error, error], 1)
        dmean = both @ self.softmax.T / (end - begin)[:, None]
        size, dims = len(flat) + 1, range(dmean.shape[1])
        edge = np.stack([np.bincount(begin, dmean[:, d], size) - np.bincount(end, dmean[:, d], size) for d in dims], 1)
        dword = np.cumsum(edge, 0)[:-1]
        dvector = np.stack([np.bincount(flat, dword[:, d], len(counts)) for d in dims], 1) / counts[:, None]
        dtable = np.stack([np.bincount(ids, np.repeat(dvector[:, d], counts), len(self.table)) for d in dims], 1)
        return {"table": dtable.astype(np.float32), "softmax": mean.T @ both, "bias": both.sum(0)}

    def learn_words(self, words: Sequence[str]) -> None:
        toward = self.softmax[:, 1] - self.softmax[:, 0]
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE]
            self.known.update(zip(part, (self.vectors(*self.bags(part)) @ toward).tolist(), strict=True))

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """The probability that each text is toxic: that of its most toxic window."""
        cut = [words_of(t) or [""] for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        self.learn_words(list(set().union(*cut).difference(self.known)))
        out, get, bias = np.empty(len(cut)), self.known.__getitem__, float(self.bias[1] - self.bias[0])
        for i, t in enumerate(cut):
            sums = np.concatenate([[0.0], np.cumsum(np.fromiter(map(get, t), np.float64, len(t)))])
            begin, end = windows(len(t))
            out[i] = ((sums[end] - sums[begin]) / (end - begin)).max() + bias
        return sigmoid(out)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 4_000, max_chars: int = 20_000, text: str = "text", key: str = "doc_id") -> SubwordSoftmax:
    """A model fitted on at most ``sample_rows`` labelled rows of at most ``max_chars`` characters.

    ``labels`` has the key and ``toxic`` (0 or 1; other values are no label). Up to half of the sample is toxic
    rows. Rows are chosen among those short enough, by their key's hash; of several texts of a key, the first
    in their order is taken. Without any row to learn from, every text scores alike, and below 0.5.
    """
    source = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).filter(F.length("_text") <= max_chars)
    known = labels.filter("toxic IN (0, 1)").groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max("toxic").alias("toxic"))
    known = known.join(source.select("_key").distinct(), "_key", "left_semi")

    def some(value: int, n: int) -> DataFrame:
        return known.filter(F.col("toxic") == value).orderBy(F.xxhash64(F.col("_key").cast("string")), "_key").limit(n)

    chosen = some(1, sample_rows // 2).unionByName(some(0, sample_rows - sample_rows // 2))
    rows = (
        source.join(F.broadcast(chosen), "_key")  # sample_rows rows of two numbers
        .groupBy("_key").agg(F.min("_text").alias("_text"), F.first("toxic").alias("toxic"))
        .collect()
    )
    rows.sort(key=lambda r: str(r._key))
    return SubwordSoftmax().fit([r._text for r in rows], [int(r.toxic) for r in rows])


def score(docs: DataFrame, model: SubwordSoftmax, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts, without words, score as an empty window does. Repeated rows score alike. Input
    columns named like a result are replaced.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            parts = (b.iloc[i : i + 256].tolist() for i in range(0, len(b), 256))
            yield pd.Series(np.concatenate([model.scores(texts) for texts in parts] or [np.zeros(0)]))
            give_back()

    return without(docs, ["score", "predicted"]).withColumn("score", rate(F.col(f"`{text}`"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic").filter(~held_out())
    return score(docs, train(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
