"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix (operator 3).

How many rows each input partition sends to each shard is drawn first, from the law that a uniform random
permutation of all rows would give: multivariate hypergeometric, with row sums the sizes of partitions and
column sums the sizes of shards. A binary tree over the partitions splits the shard sizes at each node, so a
task draws its own row of the matrix from the sizes of partitions alone, in log(partitions) steps, and
the same row whenever it is run again.

A task then permutes locally: it hands the labels of its row out in random order. Rows are exchanged once.
Within a shard they are permuted again, by random keys: a shard is cut into blocks by key, so that no task
sorts a whole shard, and a row's slot is its place in its block after the sizes of the blocks before.
Sizes are exact (at most one row apart) and slots have no gaps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from layercake.llm.text import table, without
from layercake.llm.workers import ship

REACH = 12  # standard deviations; what lies beyond has a probability below 10^-30


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    return rows // shards + (np.arange(shards) < rows % shards)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn without replacement are among the ``good`` ones. One law at every size: the
    probabilities follow from the likeliest number by exact ratios, as far as they matter, and one uniform number
    picks among them."""
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    total = good + bad
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    spread = math.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1)))
    reach = int(REACH * spread) + 64
    up = np.arange(min(high - mode, reach), dtype=np.float64)
    down = np.arange(min(mode - low, reach), dtype=np.float64)
    rest = bad - n + mode
    above = np.cumprod(((good - mode) - up) * ((n - mode) - up) / ((mode + 1 + up) * (rest + 1 + up)))
    below = np.cumprod((mode - down) * (rest - down) / ((good - mode + 1 + down) * (n - mode + 1 + down)))
    sums = np.cumsum(np.concatenate([below[::-1], [1.0], above]))
    place = int(np.searchsorted(sums, rng.random() * sums[-1], side="right"))
    return mode - len(below) + min(place, len(sums) - 1)


def draw(rng: np.random.Generator, sizes: np.ndarray, n: int) -> np.ndarray:
    """How many of each colour n draws without replacement give."""
    got, left = [], int(sizes.sum())
    for size in sizes.tolist():
        left -= size
        got.append(hypergeometric(rng, size, left, n))
        n -= got[-1]
    return np.array(got, np.int64)


def matrix_row(ends: np.ndarray, shards: int, partition: int, seed: int) -> np.ndarray:
    """Row ``partition`` of the matrix; ``ends`` are the running sums of partition sizes."""
    low, high = 0, len(ends)
    sizes = shard_sizes(int(ends[-1]), shards)
    while high - low > 1:
        middle = (low + high) // 2
        before = int(ends[low - 1]) if low else 0
        left = draw(np.random.default_rng([seed, low, high]), sizes, int(ends[middle - 1]) - before)
        if partition < middle:
            sizes, high = left, middle
        else:
            sizes, low = sizes - left, middle
    return sizes


def uniform_shards(rows: DataFrame, shards: int = 40, seed: int = 17, block_rows: int = 5_000, pin: bool = True) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, whole rows exchanged once.

    Every arrangement of the rows is equally likely. The sizes of input partitions are counted first, so
    a partition must hold the same rows in the same order when it is read again. ``pin`` sees to that with
    a checkpoint; without it, ``rows`` must come straight from files. A partition that has changed
    nevertheless fails the job. Nulls, empty and long texts and repeated rows are rows like any other; an
    empty table has no shards. Input columns named like a result are replaced. The driver receives one
    number per input partition.
    """
    spark = rows.sparkSession
    ship(spark)
    if pin:
        rows = rows.checkpoint()
    rows = without(rows, ["shard", "slot", "_dealt", "_block", "_key", "_before"])
    counted = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    counts = np.zeros(max((r.p for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r.p] = r["count"]
    total, ends = int(counts.sum()), np.cumsum(counts)
    bits = max(0, int(np.ceil(np.log2(max(1, total / shards / block_rows)))))
    sent = spark.sparkContext.broadcast(ends)  # one number per partition

    @F.pandas_udf("struct<shard:int,key:long>")
    def deal(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        left = rng = None
        for b in batches:
            if left is None:
                partition = int(b.iloc[0]) if len(b) else 0
                left = matrix_row(sent.value, shards, partition, seed).copy()
                rng = np.random.default_rng([seed, partition, 1])
            if len(b) > left.sum():
                raise RuntimeError("a partition has more rows than were counted: pin the input")
            got = draw(rng, left, len(b))
            left -= got
            labels = np.repeat(np.arange(shards, dtype=np.int32), got)
            rng.shuffle(labels)
            yield pd.DataFrame({"shard": labels, "key": rng.integers(0, 2**62, len(b))})
        if left is not None and left.sum():
            raise RuntimeError("a partition has fewer rows than were counted: pin the input")

    def dealt(df: DataFrame) -> DataFrame:
        return (
            df.withColumn("_dealt", deal.asNondeterministic()(F.spark_partition_id()))
            .withColumns({"shard": F.col("_dealt.shard"), "_key": F.col("_dealt.key")})
            .withColumn("_block", F.shiftright("_key", 62 - bits).cast("int"))
            .drop("_dealt")
        )

    sizes = dealt(rows.select()).groupBy("shard", "_block").count()
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("shard", "_block").orderBy("_key"))
    return (
        dealt(rows)
        .withColumn("slot", place.cast("long"))
        .join(sizes, ["shard", "_block"])
        .withColumn("slot", F.col("slot") - 1 + F.col("_before"))
        .drop("_block", "_key", "_before")
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return uniform_shards(docs, pin=False).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
