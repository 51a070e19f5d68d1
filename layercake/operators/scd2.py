"""Dimensions that keep every version of a row (slowly changing, type 2).

A dimension has its key and tracked columns plus ``hk`` (key of the version), ``attr_hash`` (content
of the tracked columns), ``eff_start``, ``eff_end`` (NULL while open) and ``is_current``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from layercake.functions.hashing import quoted, row_hash, row_hash_sql
from layercake.operators.merge import latest_per_key
from layercake.operators.sequence import HOT_ROWS, from_other_pieces, in_pieces, within
from layercake.session import written

META = ["hk", "attr_hash", "eff_start", "eff_end", "is_current"]


def open_dimension(rows: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective_ts: datetime | Column) -> DataFrame:
    """First load: one open version per row."""
    return rows.select(*keys, *tracked, _ts(effective_ts).alias("eff_start")).selectExpr(
        *quoted([*keys, *tracked]),
        f"{row_hash_sql(quoted([*keys, *tracked, 'eff_start']))} AS hk",
        f"{row_hash_sql(quoted(tracked))} AS attr_hash",
        "eff_start",
        "CAST(NULL AS timestamp) AS eff_end",
        "true AS is_current",
    )


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_ts: datetime | Column,
    delete: str = "ignore",
) -> DataFrame:
    """``dim`` after a batch no earlier than any before it. Closed versions pass through without a shuffle."""
    columns = [*keys, *tracked, *META]
    history = dim.filter(~F.col("is_current")).select(*columns)
    current = dim.filter("is_current")
    return history.unionByName(advance(current, changes, keys, tracked, effective_ts, delete))


def scd2_apply_late(
    dim: DataFrame,
    seen: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_ts: datetime | Column,
    delete: str = "ignore",
) -> tuple[DataFrame, DataFrame]:
    """``dim`` and ``seen`` after a batch of any time. Only keys of the batch are taken apart; see ``splice``."""
    touched = changes.select(*keys).distinct()
    seen = nothing_seen(dim, keys, tracked) if seen is None else seen
    versions, noted = splice(
        dim.join(touched, list(keys), "left_semi"), seen.join(touched, list(keys), "left_semi"), changes, keys, tracked, effective_ts, delete
    )
    rest = dim.join(touched, list(keys), "left_anti").select(*versions.columns)
    return rest.unionByName(versions), seen.join(touched, list(keys), "left_anti").unionByName(noted)


def nothing_seen(dim: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    return dim.select(*keys, *tracked, "eff_start").filter("false")


def splice(
    versions: DataFrame,
    seen: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_ts: datetime | Column,
    delete: str = "ignore",
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(versions, seen) of some keys after a batch that may be earlier than some of their versions.

    The version valid at the batch's time ends there, and the new one lasts until the next known change. A row like
    the version before it changes nothing now, but would if another came between them later: such rows are
    kept in ``seen`` (key and tracked columns, and their time as ``eff_start``). So the versions depend on the rows
    and times of the batches, never on the order in which these arrive. Of two batches of one time the later one counts.
    """
    values = [*keys, *tracked, "eff_start"]

    def at(df: DataFrame, rank: int) -> DataFrame:
        return df.select(*values, F.lit(False).alias("_gone"), F.lit(rank).alias("_rank"))

    no_values = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in tracked]
    ends = versions.filter("eff_end IS NOT NULL").select(
        *keys, *no_values, F.col("eff_end").alias("eff_start"), F.lit(True).alias("_gone"), F.lit(0).alias("_rank")
    )
    batch = _one_per_key(changes, keys, tracked, delete).select(
        *keys, "new.*", _ts(effective_ts).alias("eff_start"), F.col("gone").alias("_gone"), F.lit(2).alias("_rank")
    )
    known = at(versions, 1).unionByName(at(seen, 1)).unionByName(ends).unionByName(batch)
    content = F.when(F.col("_gone"), F.lit("")).otherwise(row_hash(quoted(tracked)))
    # Read four times below, and the history behind it is read and shuffled once.
    events = written(latest_per_key(known, [*keys, "eff_start"], ["_rank"]).withColumn("attr_hash", content), "events")
    flagged = _flagged(events, keys, ["eff_start"], hot_rows)
    changed = _until_next(flagged.filter("_changed"), keys, "eff_start", ["eff_start"])
    noted = flagged.filter("NOT _changed AND NOT _gone").select(*values)
    return _versions(changed.filter("NOT _gone"), keys, tracked, "eff_start"), noted


def advance(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_ts: datetime | Column,
    delete: str = "ignore",
) -> DataFrame:
    """Open versions after a batch, plus the versions this batch closes.

    ``changes`` holds one new row per key, or a change feed with ``_action`` and ``_is_update``. A row
    whose tracked columns equal the open version changes nothing. Real deletes close the open version
    with ``delete='close'``. One shuffle per side, on the key; keys are unique on both sides.

    A batch of the time of the open version replaces it, or removes it. So no interval is empty, and
    versions of a key never share a start or ``hk``. An earlier batch needs the history: see ``splice``. Here
    it leaves the open version as it is.
    """
    cur = current.select(*keys, F.struct(*tracked, *META).alias("cur"))
    joined = cur.join(_one_per_key(changes, keys, tracked, delete), list(keys), "full_outer")

    def version(row: str, hk: str, attr_hash: str, start: str, end: str, is_current: str) -> str:
        fields = [f"'{c}', {row}.`{c}`" for c in tracked]
        fields += [f"'{n}', {v}" for n, v in zip(META, (hk, attr_hash, start, end, is_current))]
        return f"named_struct({', '.join(fields)})"

    fresh_hk = row_hash_sql([*quoted(keys), *[f"new.`{c}`" for c in tracked], "at"])
    opened = version("new", fresh_hk, "new_hash", "at", "CAST(NULL AS timestamp)", "true")
    closed = version("cur", "cur.hk", "cur.attr_hash", "cur.eff_start", "at", "false")
    versions = f"""
        CASE WHEN new IS NULL OR late THEN array(cur)
             WHEN cur IS NULL THEN array({opened})
             WHEN gone THEN IF(replaces, slice(array({closed}), 1, 0), array({closed}))
             WHEN cur.attr_hash = new_hash THEN array(cur)
             WHEN replaces THEN array({opened})
             ELSE array({closed}, {opened}) END
    """
    started = F.col("cur.eff_start")
    known = joined.filter("cur IS NOT NULL OR NOT gone").withColumn("at", _ts(effective_ts))
    known = known.withColumns({"replaces": started == F.col("at"), "late": F.coalesce(started > F.col("at"), F.lit(False))})
    return known.selectExpr(*quoted(keys), f"inline({versions})")


def scd2_from_log(
    log: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All versions at once from a timestamped log (backfill).

    Log rows of one key form a sequence. Keys with ``hot_rows`` log rows or more are cut into pieces by range; which
    keys are changes the plan, never the result. Rows without key or time have no place in the sequence;
    ``unplaced_rows`` counts them.
    """
    order = [ts, *tiebreak, "attr_hash"]
    rows = (
        log.dropna(subset=[*keys, ts])
        .select(*dict.fromkeys([*keys, *tracked, ts, *tiebreak]))
        .withColumn("attr_hash", row_hash(quoted(tracked)))
    )
    changed = _flagged(rows, keys, order, hot_rows).filter("_changed")
    return _versions(_until_next(changed, keys, ts, order), keys, tracked, ts)


def unplaced_rows(log: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """How many log rows ``scd2_from_log`` leaves out, by what they lack, and how many it takes."""
    no_key = F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))
    what = F.when(no_key & F.col(ts).isNull(), "key and time").when(no_key, "key").when(F.col(ts).isNull(), "time").otherwise("nothing")
    return log.groupBy(what.alias("lacks")).agg(F.count(F.lit(1)).alias("rows"))


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def as_of(dim: DataFrame, ts: datetime | Column) -> DataFrame:
    """The version of each key that was open at ``ts``."""
    at = _ts(ts)
    return dim.filter((F.col("eff_start") <= at) & (F.col("eff_end").isNull() | (at < F.col("eff_end"))))


def _flagged(rows: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """``rows`` with ``_changed``: whether their ``attr_hash`` differs from that of the row before."""
    cut = in_pieces(rows, keys, order, hot_rows)
    local = cut.withColumn("_before", F.lag("attr_hash").over(within(cut, keys, order)))
    known = from_other_pieces(local, cut, keys, "_before", F.max_by("attr_hash", F.struct(*order)))
    changed = F.col("_before").isNull() | (F.col("_before") != F.col("attr_hash"))
    return known.withColumn("_changed", changed).drop("_before")


def _until_next(rows: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with the time of the next one of their key as ``_end``."""
    local = rows.withColumn("_end", F.lead(ts).over(within(rows, keys, order)))
    return from_other_pieces(local, rows, keys, "_end", F.min(ts), later=True)


def _versions(rows: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str) -> DataFrame:
    """Rows with ``attr_hash`` and ``_end`` as versions that start at ``ts``."""
    return rows.selectExpr(
        *quoted([*keys, *tracked]),
        f"{row_hash_sql(quoted([*keys, *tracked, ts]))} AS hk",
        "attr_hash",
        f"CAST(`{ts}` AS timestamp) AS eff_start",
        "CAST(_end AS timestamp) AS eff_end",
        "_end IS NULL AS is_current",
    )


def _one_per_key(changes: DataFrame, keys: Sequence[str], tracked: Sequence[str], delete: str) -> DataFrame:
    if delete not in ("ignore", "close"):
        raise ValueError(f"delete must be 'ignore' or 'close', not {delete!r}")
    gone = F.lit(False)
    if "_action" in changes.columns:
        inserted = F.col("_action") == "INSERT"
        gone = (F.col("_action") == "DELETE") & ~F.col("_is_update")
        changes = changes.filter(inserted | gone if delete == "close" else inserted)
    return changes.select(
        *keys, F.struct(*tracked).alias("new"), row_hash(quoted(tracked)).alias("new_hash"), gone.alias("gone")
    )


def _ts(value: datetime | Column) -> Column:
    """A naive datetime is read in the session's time zone, like any timestamp text."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp")
