"""Text to typed value, never failing a row: what cannot be read becomes NULL.

All functions take the text as SQL (mostly a column name). Text that cannot be of its type by its shape is
not cast at all: a cast that fails raises and catches an exception inside Spark for every such row, ten
to twenty times the cost of a match. Numbers are only looked at by how they begin, which is cheaper still
and keeps words away from the cast; the cast itself decides.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted shapes, written without backslashes, which SQL text would need escaped.
ISO_SHAPE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,9})?)?$"
US_MINUTE_SHAPE = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}$"
US_DATE_SHAPE = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
# Digits, signs, points and blanks sort before it, letters after it.
AFTER_DIGITS = ":"


def typed_sql(text: str, kind: str) -> str:
    """SQL for the lenient cast of raw text to ``kind``: a Spark type name, or ``text`` for trimmed
    strings. Timestamps and dates may be ISO or US, with or without time; time-only text is NULL."""
    if kind == "string":
        return text
    if kind == "text":
        return f"trim({text})"
    if kind == "timestamp":
        t = f"trim({text})"
        return f"""CASE WHEN {t} RLIKE '{ISO_SHAPE}' THEN try_cast({t} AS timestamp)
            WHEN {t} RLIKE '{US_MINUTE_SHAPE}' THEN try_to_timestamp({t}, 'M/d/yyyy H:mm')
            WHEN {t} RLIKE '{US_DATE_SHAPE}' THEN try_to_timestamp({t}, 'M/d/yyyy') END"""
    if kind == "date":
        return f"to_date({typed_sql(text, 'timestamp')})"
    if kind == "boolean":
        return f"CASE lower(trim({text})) WHEN 'true' THEN true WHEN 'false' THEN false END"
    if kind == "bigint":
        return f"CASE WHEN {text} < '{AFTER_DIGITS}' AND NOT contains({text}, '.') THEN try_cast({text} AS bigint) END"
    if kind.startswith("decimal"):
        return f"CASE WHEN {text} < '{AFTER_DIGITS}' THEN try_cast({text} AS {kind}) END"
    raise ValueError(f"no such kind: {kind}")


def typed(text: str, kind: str) -> Column:
    return F.expr(typed_sql(text, kind))


def strict(text: str, kind: str) -> Column:
    """As ``typed``, but text that cannot be read fails the query."""
    value = typed_sql(text, kind)
    failed = f"CAST(raise_error(concat('not a {kind}: ', {text})) AS {spark_type(kind)})"
    return F.expr(f"CASE WHEN {text} IS NOT NULL AND ({value}) IS NULL THEN {failed} ELSE {value} END")


def parse_ts(text: str) -> Column:
    return typed(text, "timestamp")


def parse_date(text: str) -> Column:
    return typed(text, "date")


def parse_bool(text: str) -> Column:
    return typed(text, "boolean")


def spark_type(kind: str) -> str:
    return "string" if kind == "text" else kind


def name_part(name: str, n: int) -> Column:
    """The n-th blank-separated word; an empty string past the end."""
    return F.expr(f"split_part({name}, ' ', {n})")


def json_field(text: str, schema: str, field: str) -> Column:
    return F.expr(f"from_json({text}, '{schema}').{field}")


def month_label(month: str) -> Column:
    return F.expr(f"date_format(make_date(2000, CAST({month} AS int), 1), 'MMM')")
