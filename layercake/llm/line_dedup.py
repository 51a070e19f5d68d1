"""Repeated line runs by prefix doubling over line ids (operator 7).

Every document is a sequence of lines (those with a word, compared without surrounding white space). Lines
that occur once cannot be part of a repeated run and end it. Each other line gets its rank in the order of
all distinct repeated lines; it begins a suffix. Doubling then ranks suffixes by their first 2, 4, 8, ...
lines: the rank of 2k lines follows from those of two neighbouring k lines, and a suffix whose 2k lines
occur once leaves. Ranks are dense and keep the order of the suffix array, so equal ranks are an interval of
it whose longest common prefix is that long.

A run counts from ``min_words`` words on. The interval of any run length is known from two overlapping
powers of two. For each line the shortest runs that begin and that end with it are looked up; together
they cover every maximal repeated run of so many words, and nothing else. In each interval the copy that
comes first stays (by document id, then place), and the lines of later copies are deleted.

Pairs of ranks are counted before they are sorted, so a line that a third of all documents share is one
row there; where rows meet their ranks again, Spark splits frequent ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from layercake.llm.decontaminate import small
from layercake.llm.scratch import Scratch
from layercake.llm.text import table, without
from layercake.llm.workers import give_back, ship

MIN_WORDS = 50


def run_lengths(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest run of ``least`` words from each line on, and up to each line; 0 if there is none."""
    sums = np.concatenate([[0], np.cumsum(words)])
    at = np.arange(len(words))
    end = np.searchsorted(sums, sums[:-1] + least, "left")
    begin = np.searchsorted(sums, sums[1:] - least, "right") - 1
    return np.where(end < len(sums), end - at, 0), np.where(begin >= 0, at - begin + 1, 0)


def line_table(docs: DataFrame, least: int) -> DataFrame:
    """(doc, seq, h1, h2, from_here, up_to_here) of every line with a word; ``docs`` has ``_id``, ``_text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows, seqs, digests, starts, ends = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    lines = [x for x in (text or "").split("\n") if x and not x.isspace()]
                    if not lines:
                        continue
                    start, end = run_lengths(np.array([max(1, len(x.split())) for x in lines]), least)
                    rows.append(np.full(len(lines), i))
                    seqs.append(np.arange(len(lines), dtype=np.int32))
                    digests += [hashlib.blake2b(x.strip().encode(), digest_size=16).digest() for x in lines]
                    starts.append(start)
                    ends.append(end)
                if rows:
                    h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    row = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(row),
                            part.column(2).take(row),
                            pa.array(np.concatenate(seqs)),
                            pa.array(h[:, 0].copy()),
                            pa.array(h[:, 1].copy()),
                            pa.array(np.concatenate(starts).astype(np.int32)),
                            pa.array(np.concatenate(ends).astype(np.int32)),
                        ],
                        names=["_id", "_hash", "seq", "h1", "h2", "from_here", "up_to_here"],
                    )
            give_back()

    kind = docs.schema["_id"].dataType.simpleString()
    fields = f"_id {kind}, _hash long, seq int, h1 long, h2 long, from_here int, up_to_here int"
    return docs.select("_id", "_text", F.xxhash64("_text")).mapInArrow(cut, fields)


def dense_ranks(keys: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """``keys`` (distinct pairs of numbers) with ``next``: their place in sorted order, from 1.

    Ranges are sorted in parallel; a place is that in its range after the sizes of the ranges before.
    """
    ranged = scratch.put(keys.repartitionByRange(a, b).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("range").count()
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = sizes.select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(a, b))
    return ranged.withColumn("inside", inside).join(F.broadcast(sizes), "range").select(a, b, (F.col("before") + F.col("inside")).alias("next"))


def repeated(rows: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """The rows whose pair (a, b) occurs twice or more, with its dense rank as ``next``."""
    pairs = rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(a, b)
    return rows.join(dense_ranks(pairs, a, b, scratch), [a, b])


def doubled(lines: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The repeated lines, and the ranks (doc, seq, level, rank) of suffixes by their first 2 ** level lines."""
    first = repeated(lines, "h1", "h2", scratch).select("_id", "_hash", "seq", "from_here", "up_to_here", F.col("next").alias("rank"))
    first = scratch.put(first, "level")
    longest = first.agg(F.max(F.greatest("from_here", "up_to_here"))).first()[0] or 0
    now = first.select("_id", "_hash", "seq", "rank")
    levels, level = now.withColumn("level", F.lit(0)), 0
    while 2 ** (level + 1) <= longest:
        there = Window.partitionBy("_id", "_hash").orderBy("seq").rangeBetween(2**level, 2**level)
        pairs = now.withColumn("right", F.max("rank").over(there)).filter("right IS NOT NULL")
        level += 1
        found = repeated(scratch.put(pairs, "pairs"), "rank", "right", scratch)
        now = scratch.put(found.select("_id", "_hash", "seq", F.col("next").alias("rank")), "level")
        if now.isEmpty():
            break
        levels = levels.union(now.withColumn("level", F.lit(level)))
    return first, levels


def later_copies(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """(_id, _hash, start, length) of runs that an equal run comes before."""
    first, levels = doubled(lines, scratch)
    begin = first.filter("from_here > 0").select("_id", "_hash", F.col("seq").alias("start"), F.col("from_here").alias("length"))
    end = first.filter("up_to_here > 0").select(
        "_id", "_hash", (F.col("seq") - F.col("up_to_here") + 1).alias("start"), F.col("up_to_here").alias("length")
    )
    runs = begin.union(end).distinct().withColumn("doc", F.struct("_id", "_hash"))
    runs = runs.withColumn("level", F.length(F.bin(F.col("length").cast("long"))) - 1)
    runs = runs.withColumn("second", F.col("start") + F.col("length") - F.expr("shiftleft(1, level)"))
    ranks = levels.select(F.struct("_id", "_hash").alias("doc"), "seq", "level", "rank")

    def at(place: str, name: str) -> DataFrame:
        return ranks.select("doc", "level", F.col("seq").alias(place), F.col("rank").alias(name))

    known = runs.select("doc", "start", "length", "level", "second")
    known = known.join(at("start", "r1"), ["doc", "level", "start"]).join(at("second", "r2"), ["doc", "level", "second"])
    known = scratch.put(known.select("doc", "start", "length", "r1", "r2"), "runs")
    interval = ["length", "r1", "r2"]
    place = F.struct("doc", "start")
    original = known.groupBy(*interval).agg(F.min(place).alias("original"), F.max(place).alias("last")).filter("original <> last")
    copies = known.join(original.drop("last"), interval).filter(place > F.col("original"))
    return copies.select("doc._id", "doc._hash", "start", "length").distinct()


def once_per_document(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """``lines`` of repeated rows once, so that a row's copies meet neither each other nor others' runs."""
    doc = F.struct("_id", "_hash").alias("doc")
    again = scratch.put(lines.filter("seq = 0").groupBy(doc).count().filter("count > 1").select("doc"), "repeated-rows")
    if again.isEmpty():
        return lines
    marked = lines.withColumn("doc", doc)
    one = marked.join(again, "doc", "left_semi").drop("doc").distinct()
    return scratch.put(marked.join(again, "doc", "left_anti").drop("doc").unionByName(one), "lines-once")


DELETED = "array<struct<first:int,last:int>>"


def without_runs(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without these runs (start and length among lines with a word), and the line ranges deleted.

    Lines without a word between the lines of a run go with it.
    """
    lines = text.split("\n")
    place = [i for i, x in enumerate(lines) if x and not x.isspace()]
    ranges: list[tuple[int, int]] = []
    for start, length in sorted(runs):
        first, last = place[start], place[start + length - 1]
        if ranges and first <= ranges[-1][1] + 1:
            ranges[-1] = (ranges[-1][0], max(last, ranges[-1][1]))
        else:
            ranges.append((first, last))
    kept, at = [], 0
    for first, last in ranges:
        kept += lines[at:first]
        at = last + 1
    return "\n".join(kept + lines[at:]), ranges


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later copies of repeated runs gone from ``text``, and ``deleted``: the line numbers gone.

    Null and empty texts stay as they are. Repeated rows (same id and text) are one document: they count
    as one place and get the same text. Of documents that share an id the order is that of their texts'
    hashes; a null id comes first. Input columns named like a result are replaced.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "line_dedup")
    source = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    lines = once_per_document(scratch.put(line_table(source, min_words), "lines"), scratch)
    runs = later_copies(lines, scratch)
    runs = runs.groupBy("_id", "_hash").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_runs"))
    runs = scratch.put(runs.select(F.struct("_id", "_hash").alias("_doc"), "_runs"), "copies")
    scratch.tidy()

    @F.pandas_udf(f"struct<text:string,deleted:{DELETED}>")
    def cut(texts: pd.Series, deleted: pd.Series) -> pd.DataFrame:
        made = [
            (None, None) if t is None or r is None else without_runs(t, [(int(x["start"]), int(x["length"])) for x in r])
            for t, r in zip(texts, deleted, strict=True)
        ]
        gone = [None if d is None else [{"first": a, "last": b} for a, b in d] for _, d in made]
        return pd.DataFrame({"text": [t for t, _ in made], "deleted": gone})

    mine = without(docs, ["deleted", "_doc", "_runs", "_cut"])
    mine = mine.withColumn("_doc", F.struct(F.col(f"`{key}`").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_hash")))
    met = mine.join(small(runs), "_doc", "left").withColumn("_cut", cut(F.when(F.col("_runs").isNotNull(), F.col(f"`{text}`")), "_runs"))
    return met.withColumns(
        {
            text: F.when(F.col("_runs").isNotNull(), F.col("_cut.text")).otherwise(F.col(f"`{text}`")),
            "deleted": F.coalesce("_cut.deleted", F.array().cast(DELETED)),
        }
    ).drop("_doc", "_runs", "_cut")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    made = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    gone = F.aggregate("deleted", F.lit(0), lambda n, x: n + x["last"] - x["first"] + 1)
    shown = F.transform("deleted", lambda x: F.concat_ws("-", x["first"].cast("string"), x["last"].cast("string")))
    return made.select(
        "doc_id",
        gone.cast("long").alias("n_deleted"),
        F.array_join(shown, ",").alias("deleted_lines"),
        F.length("text").cast("long").alias("chars_left"),
        F.sha2("text", 256).alias("text_sha256"),
    )
