"""Rows of a key in their order, with what came before, however many rows one key has.

A plain window sorts a whole key in one task. Keys with many rows are therefore cut into pieces by range over (key,
order): Spark samples where to cut, so a piece is a task's worth of rows even where a key's rows all have the same
time. A piece knows everything but what the pieces before it end with, and that is one summary row per key and piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from layercake.operators.skew import split_hot
from layercake.session import written

PIECE = "_piece"
HOT_ROWS = 1_000_000


def in_pieces(rows: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` with the number of their piece, -1 for keys of fewer than ``hot_rows`` rows. Without any hot key there are
    no pieces, and no such column."""
    hot, cold = split_hot(rows, keys, hot_rows)
    if hot is None:
        return cold
    # The last column cuts rows that agree in all others. Written, as the cuts are drawn anew whenever they are planned.
    ranged = hot.withColumn("_nth", F.monotonically_increasing_id()).repartitionByRange(*keys, *order, "_nth")
    cut = written(ranged.drop("_nth").withColumn(PIECE, F.spark_partition_id()), "pieces")
    return cold.withColumn(PIECE, F.lit(-1)).unionByName(cut)


def within(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """A key's rows in order, as far as their piece goes."""
    return Window.partitionBy(*keys, *[PIECE] * (PIECE in rows.columns)).orderBy(*order)


def from_other_pieces(
    rows: DataFrame, ends: DataFrame, keys: Sequence[str], value: str, end: Column, later: bool = False
) -> DataFrame:
    """``rows`` with every NULL in ``value`` replaced by the aggregate ``end`` of the nearest earlier, or ``later``, piece of
    ``ends`` that has one. One row per key and piece is all that is joined."""
    if PIECE not in rows.columns:
        return rows
    order = F.desc(PIECE) if later else F.asc(PIECE)
    along = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summary = ends.filter(F.col(PIECE) >= 0).groupBy(*keys, PIECE).agg(end.alias("_end_of"))
    summary = summary.select(*keys, PIECE, F.last("_end_of", ignorenulls=True).over(along).alias("_other"))
    joined = rows.join(summary, [*keys, PIECE], "left").withColumn(value, F.coalesce(value, "_other"))
    return joined.select(*rows.columns)


def carry_last(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` with every NULL in ``value`` replaced by the last one before it in its key's order, if any."""
    cut = in_pieces(rows, keys, order, hot_rows)
    running = within(cut, keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
    filled = cut.withColumn(value, F.last(value, ignorenulls=True).over(running))
    return from_other_pieces(filled, cut, keys, value, last).select(*rows.columns)


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str | None = None,
    values: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` with ``values`` of the version of their ``key`` that is valid at their time ``at``.

    Both sides have the key column; a version is valid from ``start`` until before ``end`` (NULL or no column: until
    the next one starts). Rows and versions are put into one order per key and the last version is carried on, so
    a row never meets more than one version. Rows with no valid version, no key or no time get NULLs.
    """
    until = F.lit(None).cast("timestamp") if end is None else F.col(end).cast("timestamp")
    held = F.struct(*[F.col(v) for v in values], until.alias("_until"))
    timed = rows.select(
        F.col(key).alias("_key"), F.col(at).cast("timestamp").alias("_at"), F.lit(1).alias("_kind"), F.struct("*").alias("_row")
    )
    placed = timed.filter("_key IS NOT NULL AND _at IS NOT NULL")
    lost = timed.filter("_key IS NULL OR _at IS NULL")
    marks = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).cast("timestamp").alias("_at"), F.lit(0).alias("_kind"), held.alias("_held")
    )
    nobody = F.lit(None).cast(timed.schema["_row"].dataType).alias("_row")
    both = placed.withColumn("_held", F.lit(None).cast(marks.schema["_held"].dataType)).unionByName(marks.select("*", nobody))
    carried = carry_last(both, ["_key"], ["_at", "_kind"], "_held", hot_rows).filter("_kind = 1")
    valid = F.col("_held._until").isNull() | (F.col("_at") < F.col("_held._until"))
    found = carried.select("_row", F.when(valid, F.col("_held")).alias("_held"))
    nothing = lost.select("_row", F.lit(None).cast(found.schema["_held"].dataType).alias("_held"))
    return found.unionByName(nothing).select("_row.*", *[F.col(f"_held.{v}").alias(v) for v in values])
