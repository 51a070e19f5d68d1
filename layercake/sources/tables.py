"""Keyed Parquet tables with versions.

Spark's MERGE needs a table format that plain Parquet is not, so a table here is a folder of Parquet
parts plus a log of commits:

    data/v=<version>/_append=<0|1>/_bucket=<n>/*.parquet
    commits/v=<version>/*.json

Rows live in the bucket of their key. A merge rewrites the buckets its batch touches and no other,
into the folder of the new version; appended rows are never rewritten. The commit is the last write,
so a reader sees a version whole or not at all and a failed write leaves nothing behind that counts.
One writer per table, as with any streaming sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from layercake.operators.merge import snapshot_diff
from layercake.session import free_shuffles, rounds

COMMIT_SCHEMA = (
    "version long, op string, batch_id string, buckets array<int>, live array<int>, rewritten array<int>, appended boolean,"
    " sources map<string, long>, cut int"
)

PLACE = "_place"


@dataclass(frozen=True)
class State:
    """A version of a table.

    ``buckets`` maps each bucket ever written to the version that wrote it last and whether it has rows
    since then; ``appended`` lists the versions with appended rows, ``floors`` the buckets of which only rows appended
    from a version on count, ``consumed`` the version taken in of each source.
    """

    version: int
    buckets: dict[int, tuple[int, bool]]
    appended: list[int]
    floors: dict[int, int]
    consumed: dict[str, int]


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str] = (),
        bucket_by: Sequence[str] = (),
        buckets: int = 16,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.bucket_by, self.buckets = list(keys), list(bucket_by or keys), buckets
        self._latest: State | None = None

    # -- reading -------------------------------------------------------------------------------

    def version(self) -> int:
        """Latest version, 0 for a table never written."""
        return self._state().version

    def refresh(self) -> None:
        """Sees what another session has written since."""
        self._latest = None

    def read(
        self, version: int | None = None, buckets: Sequence[int] | None = None, appended: bool = True, whole: bool = False
    ) -> DataFrame:
        """Rows of a version, optionally of some buckets only, optionally without appended rows. Appended rows are
        those of all buckets, unless ``whole`` asks for ``buckets`` only."""
        if whole:
            rows = self._appended(self._state(version)).filter(self._bucket().isin(list(buckets or [])))
            return self.read(version, buckets, appended=False).unionByName(rows)
        state = self._state(version)
        wanted = set(state.buckets if buckets is None else buckets)
        filled = sorted((b, v) for b, (v, has_rows) in state.buckets.items() if has_rows and b in wanted)
        rows = [f"v={v}/_append=0/_bucket={b}" for b, v in filled]
        if not state.floors:
            return self._load(rows + [f"v={v}/_append=1" for v in state.appended if appended])
        return self._load(rows).unionByName(self._appended(state)) if appended else self._load(rows)

    def appended_since(self, version: int) -> DataFrame:
        """Rows appended after ``version``: the unread part of an append-only feed."""
        return self._load([f"v={v}/_append=1" for v in self._state().appended if v > version])

    def touched_since(self, version: int) -> list[int]:
        """Buckets written after ``version``."""
        return sorted(b for b, (v, _) in self._state().buckets.items() if v > version)

    def changes(self, since: int, columns: Sequence[str] | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """Net change feed from a version to the latest over ``columns`` (default: all that do not start
        with an underscore), optionally of some buckets only. Reads only the buckets written in between."""
        columns = columns or [c for c in self.schema.names if not c.startswith("_")]
        touched = [b for b in self.touched_since(since) if buckets is None or b in buckets]
        old, new = (self.read(v, touched, appended=False).select(*columns) for v in (since, None))
        return snapshot_diff(old, new, self.keys)

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Buckets the rows belong to: at most one number per bucket comes to the driver."""
        self._state()  # fails if the table is cut into another number of them
        return sorted(r[0] for r in rows.select(self._bucket().alias("_bucket")).distinct().collect())

    def filled(self, buckets: Sequence[int]) -> bool:
        """Whether one of the buckets has rows of its own."""
        state = self._state().buckets
        return any(state.get(b, (0, False))[1] for b in buckets)

    def near(self, rows: DataFrame, touched: Sequence[int]) -> DataFrame:
        """``rows`` by ``PLACE``, a part of their bucket: those of a place are in one task, which so has few buckets to write.
        As many places as Spark has tasks for a shuffle, one per bucket at least."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, -(-tasks // max(1, len(touched))))
        place = F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets * parts))
        return rows.withColumn(PLACE, place).repartition(PLACE)

    def has_batch(self, batch_id: str) -> bool:
        log = self._commits()
        return log is not None and not log.filter(F.col("batch_id") == batch_id).isEmpty()

    def consumed(self, source: str) -> int:
        """Version of ``source`` this table has taken in; 0 if none."""
        return self._state().consumed.get(source, 0)

    # -- writing -------------------------------------------------------------------------------

    def append(
        self,
        rows: DataFrame,
        batch_id: str | None = None,
        sources: dict[str, int] | None = None,
        check: Callable[[], None] | None = None,
    ) -> int:
        """Adds rows without looking at those present. They count only if ``check``, called once they are written, lets them."""
        placed = rows.select(*self.schema.names, F.lit(1).alias("_append"), F.lit(0).alias("_bucket"))
        version = self.version() + 1
        placed.write.mode("overwrite").partitionBy("_append", "_bucket").parquet(f"{self.path}/data/v={version}")
        if check is not None:
            check()
        return self._commit(version, "append", [], batch_id, sources)

    def merge(
        self,
        batch: DataFrame,
        combine: Callable[[DataFrame, DataFrame], DataFrame | tuple[DataFrame | None, DataFrame]],
        touched: Sequence[int],
        batch_id: str | None = None,
        sources: dict[str, int] | None = None,
        whole: bool = False,
        after: Sequence[int] = (),
        last: bool = True,
    ) -> int:
        """Replaces the ``touched`` buckets by ``combine(their rows, batch)``; with ``whole``, also the rows appended to them.

        Every row of ``batch`` must belong to one of them: see ``buckets_of``, or ``touched_since`` of a
        source that is cut the same way. ``combine`` may return an ``_append`` column; rows with 1 there
        are appended for good instead of staying in their bucket. It may also return two parts, the second of which
        lies ``near`` its buckets and is written as it lies; the first may be None.

        Where many rows are there, ``combine`` gets some buckets after the others. One version may also be made by several calls: the
        buckets of the calls before are ``after``, and only the ``last`` one commits.
        """
        if not touched and not after:
            return self._commit(self.version() + 1, "merge", [], batch_id, sources, written=False)
        done, old = list(after), self.read(buckets=touched, appended=False, whole=whole)
        groups = self.groups(touched, old)
        for group in groups:
            if len(groups) == 1:
                made = combine(old, batch)
            else:
                made = combine(self.read(buckets=group, appended=False, whole=whole), self.within(batch, group))
            rows, lying = made if isinstance(made, tuple) else (made, None)
            if last and len(groups) == 1 and not done:
                return self._replace("merge", rows, list(touched), batch_id, sources, list(touched) if whole else [], lying)
            self._put(rows, lying, onto=bool(done))
            done += group
            del rows, lying, made  # else their shuffle files stay
            free_shuffles(self.spark)
        if not last:
            return self.version()
        return self._commit(self.version() + 1, "merge", sorted(done), batch_id, sources, rewritten=sorted(done) if whole else [])

    def groups(self, touched: Sequence[int], *sources: DataFrame) -> list[list[int]]:
        """``touched``, in several parts where ``sources`` are large."""
        count = rounds(self.spark, max(1, len(touched)), *sources) if self.bucket_by else 1
        return [list(touched[n::count]) for n in range(count)]

    def within(self, rows: DataFrame, buckets: Sequence[int]) -> DataFrame:
        """Those of ``rows`` that belong to one of the buckets."""
        return rows.filter(self._bucket().isin(list(buckets)))

    def overwrite(self, rows: DataFrame, batch_id: str | None = None, sources: dict[str, int] | None = None) -> int:
        """Replaces all rows. Rows with 1 in an ``_append`` column become appended rows."""
        return self._replace("overwrite", rows, list(range(self.buckets)), batch_id, sources)

    def truncate(self) -> int:
        return self._commit(self.version() + 1, "overwrite", list(range(self.buckets)), None, None, written=False)

    def mark_consumed(self, sources: dict[str, int]) -> int:
        """Moves the read position in ``sources`` without taking their changes in."""
        return self._commit(self.version() + 1, "mark", [], None, sources, written=False)

    # -- inside --------------------------------------------------------------------------------

    def _appended(self, state: State) -> DataFrame:
        """Appended rows but those of buckets that were rewritten whole later on."""
        groups: dict[tuple[int, ...], list[str]] = {}
        for v in state.appended:
            groups.setdefault(tuple(b for b, floor in sorted(state.floors.items()) if floor > v), []).append(f"v={v}/_append=1")
        rows = self._load([])
        for gone, folders in groups.items():
            rows = rows.unionByName(self._load(folders).filter(~self._bucket().isin(*gone)) if gone else self._load(folders))
        return rows

    def _replace(
        self,
        op: str,
        rows: DataFrame | None,
        touched: list[int],
        batch_id: str | None,
        sources: dict[str, int] | None,
        rewritten: Sequence[int] = (),
        lying: DataFrame | None = None,
    ) -> int:
        version = self._put(rows, lying)
        return self._commit(version, op, touched, batch_id, sources, rewritten=rewritten)

    def _put(self, rows: DataFrame | None, lying: DataFrame | None, onto: bool = False) -> int:
        """Writes rows to the folder of the next version; ``onto`` keeps those that are there."""

        def in_folders(df: DataFrame) -> DataFrame:
            df = df if "_append" in df.columns else df.withColumn("_append", F.lit(0))
            return df.select(*self.schema.names, "_append", self._bucket().alias("_bucket"))

        version, parts = self.version() + 1, [] if lying is None else [in_folders(lying)]
        if rows is not None:
            placed = in_folders(rows)
            # Rebalancing brings a bucket together and lets Spark cut one that is too large for a task. A table that is not
            # cut has one bucket, so its rows stay where they are.
            parts.insert(0, placed.hint("rebalance", F.col("_append"), F.col("_bucket")) if self.bucket_by else placed)
        whole, mode = reduce(DataFrame.unionByName, parts), "append" if onto else "overwrite"
        whole.write.mode(mode).partitionBy("_append", "_bucket").parquet(f"{self.path}/data/v={version}")
        return version

    def _commit(
        self,
        version: int,
        op: str,
        touched: list[int],
        batch_id: str | None,
        sources: dict[str, int] | None,
        written: bool = True,
        rewritten: Sequence[int] = (),
    ) -> int:
        live, appended = self._written(version) if written else ([], False)
        sources = sources or {}

        def ints(values: Sequence[int]) -> Column:
            # As one text literal: a table may have thousands of buckets.
            joined = F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")
            return joined if values else F.array().cast("array<int>")

        pairs = [F.lit(x) for pair in sources.items() for x in pair]
        row = self.spark.range(1).select(
            F.lit(version).cast("long").alias("version"),
            F.lit(op).alias("op"),
            F.lit(batch_id).cast("string").alias("batch_id"),
            ints(touched).alias("buckets"),
            ints(live).alias("live"),
            ints(rewritten).alias("rewritten"),
            F.lit(appended).alias("appended"),
            F.create_map(*pairs).cast("map<string,long>").alias("sources"),
            F.lit(self.buckets).alias("cut"),
        )
        before = self._state()
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/commits/v={version}")
        earlier = [] if op == "overwrite" else before.appended
        self._latest = State(
            version,
            before.buckets | {b: (version, b in live) for b in touched},
            earlier + [version] * appended,
            before.floors | dict.fromkeys(rewritten, version),
            before.consumed | sources,
        )
        return version

    def _written(self, version: int) -> tuple[list[int], bool]:
        """Buckets that got rows in ``version``, and whether rows were appended."""
        files = (
            self.spark.read.format("binaryFile")
            .options(recursiveFileLookup="true", pathGlobFilter="*.parquet")
            .load(f"{self.path}/data/v={version}")
        )
        place = files.select(
            F.regexp_extract("path", "_append=([01])", 1).alias("a"),
            F.regexp_extract("path", "_bucket=([0-9]+)", 1).try_cast("int").alias("b"),
        )
        found = place.filter(F.col("b").isNotNull()).distinct().collect()
        return sorted(r["b"] for r in found if r["a"] == "0"), any(r["a"] == "1" for r in found)

    def _commits(self) -> DataFrame | None:
        reader = self.spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true")
        try:
            return reader.json(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _state(self, version: int | None = None) -> State:
        """One small row per bucket, append and source comes to the driver, however long the log."""
        if self._latest is not None and version in (None, self._latest.version):
            return self._latest
        log = None if version == 0 else self._commits()
        newest = [] if log is None else self._newest(log if version is None else log.filter(F.col("version") <= version))
        by_kind = {k: [r for r in newest if r["kind"] == k] for k in ("bucket", "any", "append", "reset", "floor", "source", "cut")}
        for r in by_kind["cut"]:
            if self.bucket_by and r["value"] != self.buckets:
                raise ValueError(f"{self.path} is cut into {r['value']} buckets, not {self.buckets}")
        reset = max([r["version"] for r in by_kind["reset"]], default=0)
        state = State(
            max([r["version"] for r in by_kind["any"]], default=0),
            {int(r["id"]): (r["version"], r["value"] == 1) for r in by_kind["bucket"]},
            sorted(r["version"] for r in by_kind["append"] if r["version"] >= reset),
            {int(r["id"]): r["version"] for r in by_kind["floor"]},
            {r["id"]: r["value"] for r in by_kind["source"]},
        )
        if version is None:
            self._latest = state
        return state

    @staticmethod
    def _newest(log: DataFrame) -> list[Row]:
        """What the commits say, reduced to the last word on each thing."""
        facts = """
            concat(
                array(struct('any' AS kind, '' AS id, 1L AS value)),
                transform(buckets, b -> struct('bucket' AS kind, string(b) AS id, bigint(array_contains(live, b)) AS value)),
                transform(coalesce(rewritten, array()), b -> struct('floor' AS kind, string(b) AS id, 1L AS value)),
                transform(map_entries(sources), e -> struct('source' AS kind, e.key AS id, e.value AS value)),
                if(appended, array(struct('append' AS kind, string(version) AS id, 1L AS value)), array()),
                if(op = 'overwrite', array(struct('reset' AS kind, '' AS id, 1L AS value)), array()),
                if(cut IS NOT NULL, array(struct('cut' AS kind, '' AS id, bigint(cut) AS value)), array())
            )
        """
        return (
            log.select("version", F.expr(f"inline({facts})"))
            .groupBy("kind", "id")
            .agg(F.max(F.struct("version", "value")).alias("at"))
            .select("kind", "id", "at.*")
            .collect()
        )

    def _load(self, folders: list[str]) -> DataFrame:
        if not folders:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            return self.spark.range(1).filter(F.lit(False)).select(*nothing)
        # Looking up files recursively leaves the folder columns out, so the schema is as declared.
        reader = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true")
        return reader.parquet(*[f"{self.path}/data/{f}" for f in folders])

    def _bucket(self) -> Column:
        if not self.bucket_by:
            return F.lit(0)
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")
