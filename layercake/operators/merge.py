"""Deduplicate, upsert, delete and compare keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then by all other columns, so ties never flip.

    Spark limits each map task to one row per key before the shuffle, so a hot key costs no more
    than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    window = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in [*order, *rest]])
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    update: Sequence[str] | None = None,
    keep_if_null: Sequence[str] = (),
) -> DataFrame:
    """``target`` after merging ``source``; both hold one row per key (see ``latest_per_key``).

    A matched row changes when a ``compare`` column differs, NULLs included; then its ``update``
    columns take the new value, except that a NULL leaves a ``keep_if_null`` column as it was.
    Columns outside ``update`` are written on insert only. Columns whose name starts with an
    underscore describe the load, so they are updated but not compared.
    """
    joined, out = _matched(target, source, keys, compare, update, keep_if_null)
    return joined.selectExpr(*[f"{out[c]} AS `{c}`" if c in out else f"`{c}`" for c in target.columns])


def merge_images(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    update: Sequence[str] | None = None,
    keep_if_null: Sequence[str] = (),
    delete: Column | None = None,
) -> DataFrame:
    """As ``upsert``, with each key's row ``before`` and ``after`` as structs, NULL where there is none; rows for which
    ``delete`` is true after the merge are gone. The new table and its change feed (``rows_of``, ``feed_of``) both
    come out of this one join."""
    joined, out = _matched(target, source, keys, compare, update, keep_if_null)
    before = ", ".join(f"'{c}', `t_{c}`" for c in out)
    after = ", ".join(f"'{c}', {sql}" for c, sql in out.items())
    images = joined.selectExpr(
        *[f"`{k}`" for k in keys], f"CASE WHEN in_t THEN named_struct({before}) END AS before", f"named_struct({after}) AS after"
    )
    if delete is None:
        return images
    gone = images.select("*", "after.*").withColumn("_gone", F.coalesce(delete, F.lit(False)))
    return gone.select(*keys, "before", F.when(~F.col("_gone"), F.col("after")).alias("after"))


def rows_of(images: DataFrame, keys: Sequence[str]) -> DataFrame:
    return images.filter("after IS NOT NULL").select(*keys, "after.*")


def feed_of(images: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net changes as rows with ``_action`` and ``_is_update``; see ``snapshot_diff``."""
    before, after = F.col("before"), F.col("after")

    def image(side: Column, action: str, is_update: bool) -> Column:
        return F.struct(side.alias("row"), F.lit(action).alias("_action"), F.lit(is_update).alias("_is_update"))

    made = (
        F.when(after.isNull(), F.array(image(before, "DELETE", False)))
        .when(before.isNull(), F.array(image(after, "INSERT", False)))
        .otherwise(F.array(image(before, "DELETE", True), image(after, "INSERT", True)))
    )
    changed = images.filter(~before.eqNullSafe(after)).select(*keys, F.inline(made))
    return changed.select(*keys, "row.*", "_action", "_is_update")


def _matched(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None,
    update: Sequence[str] | None,
    keep_if_null: Sequence[str],
) -> tuple[DataFrame, dict[str, str]]:
    """Both sides side by side, and per value column its value after the merge."""
    values = [c for c in target.columns if c not in keys]
    compare = [c for c in values if not c.startswith("_")] if compare is None else compare
    update = values if update is None else update
    joined = _side(target, keys, values, "t").join(_side(source, keys, values, "s"), list(keys), "full_outer")

    def new(c: str) -> str:
        return f"coalesce(`s_{c}`, `t_{c}`)" if c in keep_if_null else f"`s_{c}`"

    differs = " OR ".join([f"NOT (`t_{c}` <=> {new(c)})" for c in compare]) or "false"
    flags = {
        "is_new": F.expr("in_s IS NOT NULL AND in_t IS NULL"),
        "is_changed": F.expr(f"in_s IS NOT NULL AND in_t IS NOT NULL AND ({differs})"),
    }
    out = {c: f"CASE WHEN is_new{' OR is_changed' if c in update else ''} THEN {new(c)} ELSE `t_{c}` END" for c in values}
    return joined.withColumns(flags), out


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net changes from ``old`` to ``new`` as rows with ``_action`` and ``_is_update``.

    An update is the old row as DELETE and the new row as INSERT, both flagged as update.
    """
    values = [c for c in new.columns if c not in keys]
    joined = _packed(old, keys, values, "before").join(_packed(new, keys, values, "after"), list(keys), "full_outer")
    return feed_of(joined, keys).select(*new.columns, "_action", "_is_update")


def apply_diff(old: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with a change feed applied; the inverse of ``snapshot_diff``."""
    values = [c for c in old.columns if c not in keys]
    inserted = F.when(F.col("_action") == "INSERT", F.struct(*values))
    net = diff.groupBy(*keys).agg(F.max(inserted).alias("after"), F.lit(True).alias("touched"))
    joined = _packed(old, keys, values, "before").join(net, list(keys), "full_outer")
    row = F.when(F.col("touched"), F.col("after")).otherwise(F.col("before"))
    return joined.select(*keys, row.alias("row")).filter("row IS NOT NULL").select(*keys, "row.*").select(*old.columns)


def _side(df: DataFrame, keys: Sequence[str], values: Sequence[str], tag: str) -> DataFrame:
    return df.selectExpr(*[f"`{k}`" for k in keys], *[f"`{c}` AS `{tag}_{c}`" for c in values], f"true AS in_{tag}")


def _packed(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    """Key columns and all others as one struct, NULL only where an outer join finds no row.

    Two rows then compare as two columns. Spelled out column by column, the comparison makes Catalyst
    derive a filter for every combination of columns and renamings: minutes for a 15-column table.
    """
    return df.select(*keys, F.struct(*values).alias(name))

