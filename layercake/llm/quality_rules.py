"""Quality rules as a short-circuit cascade, ordered by rejections per cost (operator 2).

Every document gets its counts (words, symbols, repeated lines and windows) in one pass without a
shuffle. The rules then run one after the other, and the first that rejects ends the work on a document.
A rule's cost and selectivity are measured on a sample, and rules run by rejections per second. The order
changes the time taken and which of several rejecting rules is named, never whether a document is kept.

Everything is built-in expressions. Repeated windows are found by sorting hashes, so a text of n words
takes n log n steps, however long it is.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layercake.llm.text import SPACES, let, numbers, table, without, words

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over the counts, ``text``, ``word_list`` and ``lines``; null means no."""

    name: str
    rejects: str


MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
LETTER, LINE_END = r"\\p{L}", r"(\\.\\.\\.|…)\\s*$"
RULES = [
    Rule("mean_word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * size(lines)"),
    Rule("words_without_letter", f"5 * size(filter(word_list, w -> NOT w RLIKE '{LETTER}')) > n_words"),
    Rule("shouting", r"2 * length(regexp_replace(text, '\\P{Lu}+', '')) > length(regexp_replace(text, '\\P{L}+', ''))"),
    Rule("ellipses", f"10 * size(filter(lines, l -> l RLIKE '{LINE_END}')) > 3 * size(lines)"),
    Rule("bullets", r"10 * size(filter(lines, l -> l RLIKE '^\\s*[-*•‣]')) > 9 * size(lines)"),
    Rule("exclamations", r"2 * length(regexp_replace(text, '[^!?]+', '')) > n_words"),
]


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts and the arrays ``word_list`` and ``lines`` (lines with a word).

    Null counts as no words. Input columns of these names are replaced.
    """
    source = F.col(f"`{text}`")
    df = without(docs, [*COUNTS, "word_list", "lines", "_windows", "_doubled"])
    df = df.withColumn("word_list", words(source)).withColumn(
        "lines",
        F.filter(F.coalesce(F.split(source, "\n"), F.array().cast("array<string>")), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )
    df = df.withColumns(
        {
            "n_words": F.size("word_list").cast("long"),
            "word_chars": F.coalesce(F.length(F.regexp_replace(source, SPACES, "")), F.lit(0)).cast("long"),
            "n_symbols": F.coalesce(F.length(F.regexp_replace(source, "[^#*$%&|<>]+", "")), F.lit(0)).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "_windows": _window_hashes(F.col("word_list")),
        }
    )
    df = df.withColumn("_doubled", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    covered = F.when(F.col("_doubled"), _covered(_repeated(F.col("_windows")))).otherwise(F.lit(0))
    return df.withColumn("n_repeat_words", covered.cast("long")).drop("_windows", "_doubled")


def _window_hashes(word_list: Column) -> Column:
    """The hash of each three consecutive words, by position."""

    def at(i: Column) -> Column:
        return F.xxhash64(F.get(word_list, i), F.get(word_list, i + 1), F.get(word_list, i + 2))

    return F.transform(numbers(F.size(word_list) - 2), at)


def _repeated(hashes: Column) -> Column:
    """Sorted positions whose hash occurs twice or more.

    A position is packed into the bits that it needs, next to the low or the high bits of its hash, so
    that sorting plain numbers brings equal hashes together. Low and high bits are sorted on their own,
    and a position counts if both have an equal neighbour: together they hold the whole hash.
    """

    def doubled(packed: Column, bits: Column) -> Column:
        def kept(s: Column) -> Column:
            def same(v: Column, j: Column) -> Column:
                mine = _shift_right(v, bits)
                return (mine == _shift_right(F.get(s, j - 1), bits)) | (mine == _shift_right(F.get(s, j + 1), bits))

            return F.transform(F.filter(s, same), lambda v: v.bitwiseAND(_shift_left(F.lit(1).cast("long"), bits) - 1))

        return let(F.sort_array(packed), kept)

    def both(bits: Column) -> Column:
        low = F.transform(hashes, lambda h, i: _shift_left(h, bits).bitwiseOR(i.cast("long")))
        high = F.transform(hashes, lambda h, i: _shift_left(_shift_right(h, bits), bits).bitwiseOR(i.cast("long")))
        return F.sort_array(F.array_intersect(doubled(low, bits), doubled(high, bits)))

    return let(F.length(F.bin(F.size(hashes).cast("long"))), both)


def _shift_left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _shift_right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _covered(starts: Column) -> Column:
    """How many words windows of three words at these sorted starts cover."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))

    def add(acc: Column, start: Column) -> Column:
        return F.struct(
            (acc["n"] + start + 3 - F.greatest(start, acc["reach"])).alias("n"), (start + 3).alias("reach")
        )

    return F.aggregate(starts, begin, add, lambda acc: acc["n"])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 2_000, seed: int = 7) -> list[Rule]:
    """The rules by rejections per second, as measured on a sample of about ``sample_rows`` rows of ``docs``.

    The sample only orders rules; an empty one leaves them as given.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = with_counts(docs.sample(min(1.0, sample_rows / total), seed)).persist()
    try:
        seen = sample.count()
        floor, _ = _timed(sample.filter("n_words < 0"))
        worth = {}
        for rule in rules:
            seconds, rejected = _timed(sample.filter(rule.rejects))
            worth[rule.name] = (rejected + 0.5) / (seen + 1) / max(seconds - floor, 0.005)
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda r: -worth[r.name])


def _timed(df: DataFrame) -> tuple[float, int]:
    """Seconds that counting ``df`` takes, and the count."""
    start = time.perf_counter()
    n = df.count()
    return time.perf_counter() - start, n


def cascade(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``docs`` with its counts, ``base_failed``, ``rejected_by`` (the first rule to reject) and ``kept``."""
    branches = "".join(f" WHEN {r.rejects} THEN '{r.name}'" for r in rules)
    first = F.expr(f"CASE WHEN base_failed THEN 'base'{branches} END")
    return (
        without(docs, ["base_failed", "rejected_by", "kept"])
        .withColumn("base_failed", base_failed())
        .withColumn("rejected_by", first)
        .withColumn("kept", F.col("rejected_by").isNull())
    )


def quality_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 2_000) -> DataFrame:
    """Counts, verdict and first rejecting rule for every row of ``docs``, in its own columns besides.

    Null and empty texts have no words and fail the base rule. Repeated rows are judged alike. An empty
    table gives an empty result. Input columns named like a result are replaced.
    """
    named = docs.withColumnRenamed(text, "text")
    order = plan_cascade(named.select("text"), rules, sample_rows)
    return cascade(with_counts(named), order).drop("word_list", "lines").withColumnRenamed("text", text)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")
