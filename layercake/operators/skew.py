"""Keeping one hot key from ending up in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from layercake.session import written


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """The keys with ``min_rows`` rows or more.

    Counting combines on the map side, so the hot key itself is no problem here.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows).select(*keys)


def split_hot(df: DataFrame, keys: Sequence[str], min_rows: int) -> tuple[DataFrame | None, DataFrame]:
    """(rows of hot keys, all other rows). Every row is in exactly one of the two; None without a hot key.

    Which keys count as hot changes the plan, never the result. The list is counted and written once, so
    Spark knows its size and broadcasts it only if it is small.
    """
    hot = written(hot_keys(df, keys, min_rows), "hot-keys")
    if hot.isEmpty():
        return None, df
    return df.join(hot, list(keys), "left_semi"), df.join(hot, list(keys), "left_anti")
