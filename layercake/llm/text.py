"""Expressions over text columns that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column, pattern: str = WORD) -> Column:
    """All matches of ``pattern``; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def lower_words(text: Column, separators: str) -> Column:
    """Words between any of the ASCII ``separators``, A-Z lower-cased; none for null.

    One pass turns separators into spaces and letters into small ones; cutting at a plain space then needs
    no regular expression, which would take three times as long.
    """
    plain = F.translate(text, separators + UPPER, " " * len(separators) + UPPER.lower())
    return F.coalesce(F.array_remove(F.split(plain, " "), ""), F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and however deep ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbers(n: Column) -> Column:
    """0 .. n - 1; empty for n <= 0. ``sequence`` alone would count down."""
    empty = F.array().cast("array<int>")
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(empty)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The columns of ``df`` but those that a result of one of these names replaces."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
