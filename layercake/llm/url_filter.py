"""URL rules indexed by their rarest literal token (operator 8).

A rule is a pattern for a whole URL, written as host patterns are in block lists: ``||`` stands for the
begin of a host or of one of its labels, ``|`` for an end of the URL, ``^`` for a separator or the end, and
``*`` for anything. A rule is indexed by one token: of the tokens that every matching URL must hold, the one
that fewest URLs hold. A URL's tokens fetch candidate rules by an equi-join, and only these run regular
expressions. Rules without a literal token are candidates for every URL. The best matching rule decides:
by priority, then by length, then by its text.

Distinct URLs are judged once, so a URL that a third of all rows share costs as much as any other.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layercake.llm.text import UPPER, table, without

TOKEN = "[a-z0-9]+"
ANY = ""  # the token of rules that have none


@dataclass(frozen=True)
class Rule:
    """``pattern`` for the host (lower-cased) and path, written without a scheme; higher ``priority`` wins."""

    pattern: str
    verdict: str
    priority: int = 0


def regex_of(pattern: str) -> str:
    """A Java regular expression for a pattern."""
    head, body = ("^(?:[^/]*\\.)?", pattern[2:]) if pattern.startswith("||") else ("^", pattern[1:]) if pattern.startswith("|") else ("", pattern)
    body, tail = (body[:-1], "$") if body.endswith("|") else (body, "")
    special = {"*": ".*", "^": "(?:[^A-Za-z0-9_.%-]|$)"}
    return "(?s)" + head + "".join(special.get(c) or re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", c) for c in body) + tail


def tokens_of(pattern: str) -> list[str]:
    """Tokens that every URL which the pattern matches holds as whole tokens."""
    anchored, ended = pattern.startswith("|"), pattern.endswith("|")
    body = pattern.strip("|").lower()
    found = []
    for m in re.finditer(TOKEN, body):
        whole_left = m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and anchored
        whole_right = m.end() < len(body) and body[m.end()] != "*" or m.end() == len(body) and ended
        if whole_left and whole_right:
            found.append(m[0])
    return list(dict.fromkeys(found)) or [ANY]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(subject: Column) -> Column:
    lower = F.translate(subject, UPPER, UPPER.lower())
    return F.array_distinct(F.concat(F.regexp_extract_all(lower, F.lit(TOKEN), F.lit(0)), F.array(F.lit(ANY))))


def rule_index(spark: SparkSession, rules: Sequence[Rule], url_tokens: DataFrame) -> DataFrame:
    """One row per rule with its rarest token, by how many rows of ``url_tokens`` (column ``token``) have it.

    Tokens that no URL has come first; ties go by the token's text.
    """
    rows = [(r.pattern, r.verdict, r.priority, regex_of(r.pattern), tokens_of(r.pattern)) for r in rules]
    made = spark.createDataFrame(rows, "pattern string, verdict string, priority int, regex string, tokens array<string>")
    each = made.dropDuplicates().select("pattern", "verdict", "priority", "regex", F.explode("tokens").alias("token"))
    seen = url_tokens.join(each.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rated = each.join(seen, "token", "left").withColumn("rate", F.struct(F.coalesce("count", F.lit(0)), "token"))
    return rated.groupBy("pattern", "verdict", "priority", "regex").agg(F.min_by("token", "rate").alias("token"))


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``pattern`` (of the rule that decides; else null) and ``verdict``.

    Null URLs and those without ``://`` have an empty host and path, which only rules without a token can
    match. Repeated rows are judged alike. Input columns named like a result are replaced.
    """
    spark = pages.sparkSession
    mine = without(pages, ["host", "path", "pattern", "verdict", "_subject"])
    mine = mine.withColumns({"host": host_of(F.col(f"`{url}`")), "path": path_of(F.col(f"`{url}`"))})
    mine = mine.withColumn("_subject", F.concat("host", "path"))
    each = mine.select("_subject").distinct().select("_subject", F.explode(tokens(F.col("_subject"))).alias("token"))
    index = rule_index(spark, rules, each.select("token"))
    rank = F.struct("priority", F.length("pattern"), "pattern", "verdict")
    decided = (
        each.join(index, "token")
        .filter(F.regexp_like("_subject", F.col("regex")))
        .groupBy("_subject")
        .agg(F.max(rank).alias("_best"))
        .select("_subject", F.col("_best.pattern").alias("pattern"), F.col("_best.verdict").alias("verdict"))
    )
    return mine.join(decided, "_subject", "left").withColumn("verdict", F.coalesce("verdict", F.lit(default))).drop("_subject")


BASE = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
# Rules of the method itself: kinds of hosts and paths that are rarely worth reading.
PATTERNS = [
    Rule("||spam-farm.", "block"),
    Rule("||cheap-pills.", "block"),
    Rule("||casino-", "block"),
    Rule("-casino.", "block"),
    Rule("/wp-login.php", "block"),
    Rule("/cgi-bin/", "block"),
    Rule("/login/*.php|", "block"),
    Rule("||ads.", "block"),
    Rule("||tracker.", "block"),
]
RULES = [*(Rule(f"||{rule}", verdict, 1) for rule, verdict in BASE), *PATTERNS]


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "pages").select("page_id", "url"), RULES)
    base = F.col("pattern").isin([f"||{rule}" for rule, _ in BASE])
    return judged.select("page_id", "host", "path", F.when(base, F.expr("substr(pattern, 3)")).alias("rule"), "verdict")
