"""Keys from content: stable across runs, machines and partitionings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Both are control characters, so no cleaned text contains them.
SEPARATOR = "\u001f"
NULL_MARK = "\u001e"


def row_hash(values: Sequence[str]) -> Column:
    """sha1 over values given as SQL, such as column names. NULL differs from empty text, and 'a','bc'
    from 'ab','c'."""
    return F.expr(row_hash_sql(values))


def row_hash_sql(values: Sequence[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({v} AS string), '{NULL_MARK}')" for v in values)
    return f"sha1(concat_ws('{SEPARATOR}', {parts}))"


def packed(value: str) -> str:
    """SQL for the 20 bytes of a hash given as hex text, which shuffles do not compress; other text as such, after 21 zeros."""
    is_hash = f"length({value}) = 40 AND lower(hex(unhex({value}))) = {value}"
    return f"CASE WHEN {is_hash} THEN unhex({value}) ELSE concat(X'{'00' * 21}', CAST({value} AS binary)) END"


def unpacked(value: str) -> str:
    """SQL for the text that was ``packed``."""
    return f"CASE WHEN length({value}) = 20 THEN lower(hex({value})) ELSE CAST(substring({value}, 22) AS string) END"


def quoted(names: Sequence[str]) -> list[str]:
    """Column names as SQL."""
    return [f"`{n}`" for n in names]


def surrogate_key(keys: Sequence[str]) -> Column:
    """Key of a row from its business key. A dense running number would need one global sort."""
    return row_hash(quoted(keys))


def compact_key(hex_hash: Column) -> Column:
    """First 60 bits of a hex hash as a long. For small tables: collisions get likely near 10^9 rows."""
    return F.conv(F.substring(hex_hash, 1, 15), 16, 10).cast("long")

