"""Checks that sort rows into good and bad, and checks on whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from layercake.functions.parse import typed
from layercake.operators.clean import clean_values
from layercake.registry import MASKS, Entity


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a row that breaks the rule."""

    reason: str
    broken: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column} missing", F.col(column).isNull())


def max_length(column: str, n: int) -> Rule:
    return Rule(f"{column} longer than {n}", F.length(column) > n)


def castable(column: str, kind: str) -> Rule:
    return Rule(f"{column} not {kind}", F.col(column).isNotNull() & typed(column, kind).isNull())


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``_reasons``, the reasons of the rules a row breaks; empty for a good row."""
    found = [F.when(r.broken, F.lit(r.reason)) for r in rules]
    return df.withColumn("_reasons", F.array_compact(F.array(*found, F.lit(None).cast("string"))))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``_reasons``)."""
    marked = with_reasons(df, rules)
    bad = F.size("_reasons") > 0
    return marked.filter(~bad).drop("_reasons"), marked.filter(bad)


def stage_rules(entity: Entity) -> list[Rule]:
    """What a stage row must satisfy for its clean row to be valid."""
    values = clean_values(entity)
    rules = []
    for c in entity.cols:
        if c.required:
            rules.append(Rule(f"{c.name} missing or unreadable", values[c.name].isNull()))
        if c.max_len:
            rules.append(Rule(f"{c.name} longer than {c.max_len}", F.length(values[c.name]) > c.max_len))
    return rules


def split_stage(entity: Entity, stage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loadable stage rows, quarantined rows with ``_reasons``). All-empty rows are neither: their key
    is missing, and there is nothing in them to keep."""
    good, bad = split_valid(stage, stage_rules(entity))
    return good, bad.dropna(how="all", subset=entity.headers)


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Counts combine before the shuffle."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_foreign_keys(fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows without partner per reference: ``constraint``, ``rows``, ``orphans``.

    ``references`` maps a fact column to (dimension, its key column). The fact is read once: its key
    values are counted per constraint, which shrinks a hot key to one row per task before the shuffle,
    and only the distinct keys meet the dimensions. A NULL key counts as an orphan.
    """
    pairs = F.array(*[_tagged(c, F.col(c)) for c in references])
    used = (
        fact.select(F.inline(pairs))
        .groupBy("constraint", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = None
    for c, (dim, key) in references.items():
        part = dim.select(F.lit(c).alias("constraint"), F.col(key).cast("string").alias("key")).distinct()
        known = part if known is None else known.unionByName(part)
    joined = used.join(known.withColumn("found", F.lit(True)), ["constraint", "key"], "left")
    return joined.groupBy("constraint").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("found").isNull(), F.col("n")).otherwise(F.lit(0))).alias("orphans"),
    )


def mask(df: DataFrame, tags: Mapping[str, str], masks: Mapping[str, str] = MASKS) -> DataFrame:
    """Tagged columns show their tag's text; NULL stays NULL. A masked column becomes a string.

    A tag without a mask is an error, so that no tagged column is shown by mistake.
    """
    unknown = sorted({tag for c, tag in tags.items() if c in df.columns and tag not in masks})
    if unknown:
        raise ValueError(f"no mask for {', '.join(unknown)}")
    hidden = {c: F.when(F.col(c).isNotNull(), F.lit(masks[tag])) for c, tag in tags.items() if c in df.columns}
    return df.withColumns(hidden)


def _tagged(name: str, key: Column) -> Column:
    return F.struct(F.lit(name).alias("constraint"), key.cast("string").alias("key"))
