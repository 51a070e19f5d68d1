"""Runs of words that repeat with a period, by recursive frequency splitting (operator 11).

A run is a maximal stretch of at least twelve words, and of at least two periods, in which words one period
apart are the same. So each of its words stands in it twice or more. A word that a segment holds only once is in
no run of that segment and splits it; the parts are split again by their own counts, until every word of a part
occurs there twice. Of a split, only the smaller parts are counted anew: the largest takes over its parent's
counts, less what lies outside of it, so a text of n words costs n log n however it falls apart.

What survives is scanned lag by lag. Words that are the same at some lag matter only if enough of them stand in a
row, so a lag looks at every so many places, and only a place that agrees is followed to both sides. A lag
that is a multiple of the period of a run already known is not followed inside that run.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layercake.llm.text import let, numbers, table, without, words
from layercake.llm.workers import give_back, ship

LEAST_WORDS = 12
ROWS_AT_ONCE = 500
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
Run = tuple[int, int, int]  # start, length, period


def surviving(ids: Sequence[int], least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """The segments (begin, end) of ``least`` words or more in which every word occurs at least twice, after
    all others have been split away."""
    found: list[tuple[int, int]] = []
    places: dict[int, list[int]] = {}
    todo: list[tuple[int, int, Counter | None, list[int]]] = [(0, len(ids), None, [])]
    while todo:
        begin, end, counts, rare = todo.pop()
        if end - begin < least:
            continue
        if counts is None:
            counts = Counter(ids[begin:end])
            rare = [i for i in range(begin, end) if counts[ids[i]] == 1]
        if not rare:
            found.append((begin, end))
            continue
        edges = [begin - 1, *sorted(rare), end]
        parts = [(a + 1, b) for a, b in zip(edges, edges[1:]) if b - a - 1 >= least]
        largest = max(parts, key=lambda p: p[1] - p[0], default=(0, 0))
        for a, b in parts:
            if (a, b) != largest or 2 * (b - a) < end - begin:
                todo.append((a, b, None, []))
                continue
            if not places:
                places = defaultdict(list)
                for i, w in enumerate(ids):
                    places[w].append(i)
            fallen = set()
            for w in (*ids[begin:a], *ids[b:end]):
                counts[w] -= 1
                if counts[w] == 1:
                    fallen.add(w)
            left = [places[w][bisect_left(places[w], a)] for w in fallen if counts[w] == 1]
            todo.append((a, b, counts, left))
    return found


def _equal_until(x: np.ndarray, lag: int, at: int, stop: int) -> int:
    """The first place from ``at`` on, at most ``stop``, that differs from the one ``lag`` later."""
    size = 32
    while at < stop:
        to = min(at + size, stop)
        other = np.flatnonzero(x[at:to] != x[at + lag : to + lag])
        if len(other):
            return at + int(other[0])
        at, size = to, 2 * size
    return stop


def _equal_from(x: np.ndarray, lag: int, at: int, stop: int) -> int:
    """The first place, at least ``stop``, from which on all up to ``at`` equal the ones ``lag`` later."""
    size = 32
    while at > stop:
        to = max(at - size, stop)
        other = np.flatnonzero(x[to:at] != x[to + lag : at + lag])
        if len(other):
            return to + int(other[-1]) + 1
        at, size = to, 2 * size
    return stop


def scan(x: np.ndarray, least: int = LEAST_WORDS) -> list[Run]:
    """All runs of a segment of word ids."""
    n, runs = len(x), {}
    starts = ends = periods = np.zeros(0, np.int64)
    for lag in range(1, n // 2 + 1):
        need = max(least - lag, lag)  # so many equal places in a row make a run
        places = x[need - 1 : n - lag : need]
        hits = np.flatnonzero(places == x[need - 1 + lag :: need][: len(places)]) * need + need - 1
        done = i = 0
        while (i := i + int(np.searchsorted(hits[i:], done))) < len(hits):
            at = int(hits[i])
            known = (starts <= at) & (ends > at + lag) & (lag % np.maximum(periods, 1) == 0)
            if known.any():
                done = int(ends[known].max()) - lag
                continue
            begin = _equal_from(x, lag, at, done)
            end = _equal_until(x, lag, at, n - lag)
            if end - begin >= need and (begin, end + lag) not in runs:
                runs[begin, end + lag] = lag
                starts, ends = np.append(starts, begin), np.append(ends, end + lag)
                periods = np.append(periods, lag)
            done = end + 1
    return [(a, b - a, p) for (a, b), p in runs.items()]


def runs_of(ids: Sequence[int], least: int = LEAST_WORDS) -> list[Run]:
    """All runs of a text of word ids, by start and period."""
    found = []
    for begin, end in surviving(ids, least):
        found += [(begin + s, n, p) for s, n, p in scan(np.asarray(ids[begin:end], np.int64), least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(text_words: Sequence[str], runs: Sequence[Run]) -> str:
    """The words that no run contains after its first period, joined by single spaces."""
    if not runs:
        return " ".join(text_words)
    gone = np.zeros(len(text_words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
    return " ".join([text_words[i] for i in kept])


def collapse_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period, all in words) and ``collapsed``, the text without the
    repetitions of its runs.

    Null and empty texts have no runs and collapse to an empty text. Each row stands for itself: repeated rows
    get the same result, an empty table gives an empty one, and a long text is read whole by the task
    that has its row. Input columns named like a result are replaced.
    """
    ship(docs.sparkSession)
    df = without(docs, ["runs", "collapsed"])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def one(t: str | None) -> tuple[list[dict[str, int]], str]:
        ws = _WORD.findall(t or "")
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        runs = runs_of([number[w] for w in ws], least)
        return [{"start": s, "length": n, "period": p} for s, n, p in runs], collapsed(ws, runs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                made = [one(t) for t in b.column(b.schema.names.index(text)).to_pylist()]
                columns = [*b.columns, pa.array([m[0] for m in made], run_type), pa.array([m[1] for m in made], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, "runs", "collapsed"])
                give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    result = "runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return df.mapInArrow(work, f"{fields}, {result}")


def planted(doc_id: Column, text: Column) -> Column:
    """The text of a tenth of the documents with a periodic tail, as the query's contract sets it; others as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def periodic(ws: Column) -> Column:
        n = F.size(ws)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        from_word = numbers(n)
        moved = F.transform(from_word, lambda i: F.get(ws, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise(text)

    return F.when(h % 10 == 0, let(words(text), periodic)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    made = collapse_runs(docs)
    top = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return made.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
