"""The warehouse: every entity's tables under one folder, and the steps between its layers."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from layercake.operators.clean import clean, clean_schema, dimension_schema, stage_schema
from layercake.operators.merge import delete_where, latest_per_key, upsert
from layercake.operators.quality import split_stage, stage_rules, with_reasons
from layercake.operators.scd2 import advance, scd2_apply_late
from layercake.plans.star import DATE_SCHEMA, DIMENSION_KEYS, FACT_COLUMNS, FACT_KEYS, FACT_SCHEMA, build_date_dim
from layercake.plans.star import pack_keys, packed_keys, resolve, unpack_keys
from layercake.plans.views import register
from layercake.registry import DIMENSIONS, ENTITIES, Entity
from layercake.session import free_shuffles, scratch
from layercake.sources.files import new_files, read_files
from layercake.sources.tables import PLACE, VersionedTable

# Later load first, then file time and name, so the last delivered version of a row wins.
LOAD_ORDER = ["_copy_data_ts", "_stg_file_load_ts", "_stg_file_name"]
FILES_SCHEMA = T.StructType(
    [
        T.StructField("_stg_file_name", T.StringType()),
        T.StructField("_stg_file_md5", T.StringType()),
        T.StructField("_stg_file_load_ts", T.TimestampType()),
    ]
)
UNKNOWN_HEADER = "unknown header"
FACT_FEEDS = {"orders": "order_id", "order_item": "order_id_fk", "delivery": "order_id_fk"}


class Warehouse:
    """Tables live at ``root/{stage,quarantine,clean,consumption}/{entity}``.

    ``buckets`` is the number of parts a keyed table is cut into; choose it so that one part stays
    below about a gigabyte. Orders, items, deliveries and the fact are cut by order, so a change to an
    order concerns the same part of all four.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._tables: dict[str, VersionedTable] = {}

    def stage(self, entity: Entity) -> VersionedTable:
        return self._table(f"stage/{entity.name}", stage_schema(entity))

    def files(self, entity: Entity) -> VersionedTable:
        return self._table(f"stage/{entity.name}_files", FILES_SCHEMA)

    def quarantine(self, entity: Entity) -> VersionedTable:
        schema = stage_schema(entity).add("_reasons", T.ArrayType(T.StringType()))
        return self._table(f"quarantine/{entity.name}", schema)

    def clean(self, entity: Entity) -> VersionedTable:
        return self._table(f"clean/{entity.name}", clean_schema(entity), entity.keys, entity.bucket_by)

    def dim(self, entity: Entity) -> VersionedTable:
        return self._table(f"consumption/{entity.name}_dim", dimension_schema(entity), entity.keys, entity.bucket_by)

    def fact(self) -> VersionedTable:
        schema = T.StructType.fromDDL(FACT_SCHEMA)
        return self._table("consumption/order_item_fact", schema, FACT_KEYS, ["order_id"])

    def pending(self) -> VersionedTable:
        """Orders that wait for a dimension row; one row per order, dimension and key."""
        schema = T.StructType.fromDDL("order_id long, dimension string, key long")
        return self._table("consumption/pending_orders", schema, schema.names, ["order_id"])

    def dates(self) -> VersionedTable:
        return self._table("consumption/date_dim", T.StructType.fromDDL(DATE_SCHEMA))

    # -- steps ---------------------------------------------------------------------------------

    def load_stage(
        self,
        entity: Entity,
        path: str | list[str],
        load_ts: datetime,
        on_error: str = "abort",
        by: str = "header",
        once: bool = True,
        batch_id: str | None = None,
    ) -> int:
        """Appends the files at ``path`` to the stage table. With ``once``, files loaded before are left out before
        anything of them is read; with ``on_error='abort'`` a row that cannot be loaded fails the load unwritten."""
        paths = path
        if once:
            paths = new_files(self.spark, path, self.loaded_files(entity))
            if not paths:
                return self.stage(entity).version()
        return self.load_files(entity, paths, load_ts, on_error, by, once, batch_id)

    def load_files(
        self,
        entity: Entity,
        paths: str | list[str],
        load_ts: datetime,
        on_error: str,
        by: str = "header",
        once: bool = True,
        batch_id: str | None = None,
    ) -> int:
        """As ``load_stage``, of these files. Rows of files whose header cannot be bound go to quarantine, or fail the load."""
        loaded = self.loaded_files(entity) if once else None
        rows, refused = read_files(self.spark, entity, paths, load_ts, by, loaded)
        if refused is not None:
            if on_error == "abort":
                raise ValueError(f"{entity.name}: {refused.agg(F.min('_stg_file_name')).first()[0]}: {UNKNOWN_HEADER}")
            held = self.quarantine(entity)
            note = f"refused {batch_id or load_ts}"
            if not held.has_batch(note):
                held.append(refused.withColumn("_reasons", F.array(F.lit(UNKNOWN_HEADER))), note)
                self.files(entity).append(refused.select(*FILES_SCHEMA.names).distinct())
        return self.append_stage(entity, rows, on_error, batch_id)

    def delete_stage(self, entity: Entity, condition: Column) -> int:
        """Deletes stage rows, such as those of a malformed file. What was unread is taken in first, so
        the deletion takes nothing away from the clean table."""
        stage, readers = self.stage(entity), [self.clean(entity), self.quarantine(entity), self.files(entity)]
        self.refresh_clean(entity)
        self.loaded_files(entity)
        version = stage.overwrite(delete_where(stage.read(), condition).withColumn("_append", F.lit(1)))
        for table in readers:
            table.mark_consumed({"stage": version})
        return version

    def loaded_files(self, entity: Entity) -> DataFrame:
        """Files in the stage table, one row each, kept up to date from its unread part."""
        stage, files = self.stage(entity), self.files(entity)
        read_to, upto = files.consumed("stage"), stage.version()
        if read_to < upto:
            new = stage.appended_since(read_to).select(*FILES_SCHEMA.names).distinct()
            files.append(new, sources={"stage": upto})
        return files.read()

    def append_stage(self, entity: Entity, rows: DataFrame, on_error: str, batch_id: str | None = None) -> int:
        if on_error not in ("continue", "abort"):
            raise ValueError(f"on_error must be 'continue' or 'abort', not {on_error!r}")
        stage = self.stage(entity)
        if batch_id is not None and stage.has_batch(batch_id):
            return stage.version()
        if on_error == "continue":
            return stage.append(rows, batch_id)
        # Bad rows are counted while the batch is written; it becomes a version of the table only if there are none.
        seen = Observation()
        bad = (F.size("_reasons") > 0) & F.coalesce(*entity.headers).isNotNull()
        first = F.min(F.when(bad, F.struct("_stg_file_name", "_reasons"))).alias("first")
        watched = with_reasons(rows, stage_rules(entity)).observe(seen, first).drop("_reasons")

        def refuse_bad() -> None:
            if (found := seen.get["first"]) is not None:
                raise ValueError(f"{entity.name}: {found['_stg_file_name']}: {', '.join(found['_reasons'])}")

        return stage.append(watched, batch_id, check=refuse_bad)

    def refresh_clean(self, entity: Entity) -> int:
        """Merges the unread part of the stage table; rows that cannot be loaded go to quarantine."""
        stage, target = self.stage(entity), self.clean(entity)
        read_to, upto = target.consumed("stage"), stage.version()
        if read_to == upto:
            return target.version()
        good, bad = split_stage(entity, stage.appended_since(read_to))
        held = self.quarantine(entity)
        if held.consumed("stage") < upto:
            held.append(bad, sources={"stage": upto})
        rows = clean(entity, good)
        batch = latest_per_key(rows, entity.keys, LOAD_ORDER)

        touched = target.buckets_of(rows)

        def combine(old: DataFrame, new: DataFrame) -> DataFrame | tuple[None, DataFrame]:
            if not target.filled(touched):
                return new.select(*old.columns)
            # Both meet by place, so that old rows are shuffled once and written as they lie.
            old, new = target.near(old, touched), target.near(new, touched)
            return None, upsert(old, new, [*entity.keys, PLACE], keep_if_null=entity.keep_if_null)

        return target.merge(batch, combine, touched, sources={"stage": upto})

    def refresh_dim(self, entity: Entity, effective_ts: datetime, delete: str = "ignore") -> int:
        """Applies the net changes of the clean table since the last refresh.

        Of a batch no earlier than all before it only open versions are read. An earlier one is spliced into the history of
        its keys, for which the buckets it touches are rewritten whole.
        """
        source, target = self.clean(entity), self.dim(entity)
        read_to, upto = target.consumed("clean"), source.version()
        if read_to == upto:
            return target.version()
        feed, touched = source.changes(read_to, entity.columns), source.touched_since(read_to)
        at = (effective_ts - datetime(1970, 1, 1)) // timedelta(microseconds=1)
        latest = max(at, target.consumed("effective")) if target.version() else at
        sources = {"clean": upto, "effective": latest}

        def placed(versions: DataFrame) -> DataFrame:
            # Closed versions rarely change again: they are appended, only open ones stay in buckets.
            return versions.withColumn("_append", F.when(F.col("is_current"), 0).otherwise(1))

        if at == latest:
            return target.merge(
                feed, lambda old, new: placed(advance(old, new, entity.keys, entity.tracked, effective_ts, delete)), touched, sources=sources
            )
        noted = self.seen(entity)
        seen = noted.read(version=target.consumed("seen"))
        with scratch(self.spark, "late") as put:
            feed = put(feed)
            history = target.read(buckets=touched, whole=True)
            versions, now_seen = scd2_apply_late(history, seen, feed, entity.keys, entity.tracked, effective_ts, delete)
            # The dimension knows which version of this table belongs to it.
            sources["seen"] = noted.overwrite(now_seen)
            return target.merge(versions, lambda _, new: placed(new), touched, sources=sources, whole=True)

    def seen(self, entity: Entity) -> VersionedTable:
        """Rows of late batches that were like the version before them; see ``scd2.splice``."""
        fields = [f for f in dimension_schema(entity) if f.name in (*entity.columns, "eff_start")]
        return self._table(f"consumption/{entity.name}_seen", T.StructType(fields), entity.keys, entity.bucket_by)

    def refresh_fact(self) -> int:
        """Rebuilds the items of every order that changed, whose items or delivery changed, or for which a dimension row
        that it lacked has arrived.

        Orders that lack one wait in the pending table, which is written before the fact. The fact knows the version
        of it that it has taken in, so after a crash in between the same orders are rebuilt.
        """
        target, pending = self.fact(), self.pending()
        feeds = {n: self.clean(ENTITIES[n]) for n in FACT_FEEDS}
        dims = {n: self.dim(ENTITIES[n]) for n in DIMENSIONS}
        upto = {n: t.version() for n, t in feeds.items()} | {f"{n}_dim": t.version() for n, t in dims.items()}
        read_to = {n: target.consumed(n) for n in upto}
        waiting = pending.read(version=target.consumed("pending"))
        quiet = all(read_to[n] == upto[n] for n in feeds)
        if quiet and (read_to == upto or waiting.isEmpty()):
            return target.version()
        touched = {b for n in feeds for b in feeds[n].touched_since(read_to[n])}
        with scratch(self.spark, "fact") as put:
            arrived = put(self._arrived(waiting, read_to).distinct())
            touched = sorted(touched | set(target.buckets_of(arrived)))
            first = not any(read_to[n] for n in feeds)  # all orders are new, so none is looked for
            noted, done, waits = pending.version(), [], []
            groups = target.groups(touched, *[t.read(buckets=touched, appended=False) for t in feeds.values()])
            for group in groups:
                last, changed = group is groups[-1], target.within(arrived, group)
                for n, key in FACT_FEEDS.items():
                    feed = feeds[n].changes(read_to[n], ENTITIES[n].columns, group)
                    changed = changed.unionByName(feed.select(F.col(key).alias("order_id")))

                def of_changed(n: str) -> DataFrame:
                    # All three are cut by order, so the buckets that changed in one are all that is needed.
                    rows = feeds[n].read(buckets=group, appended=False)
                    key = FACT_FEEDS[n]
                    return rows if first else rows.join(changed.select(F.col("order_id").alias(key)), key, "left_semi")

                def still_waiting(old: DataFrame, more: DataFrame) -> DataFrame:
                    return old.join(changed, "order_id", "left_anti").unionByName(more)

                def combine(old: DataFrame, more: DataFrame) -> tuple[None, DataFrame]:
                    if not target.filled(group):
                        return None, more
                    # Old rows are shuffled once, whether their orders changed or not, and written as they lie.
                    old, more = (target.near(pack_keys(rows), touched) for rows in (old, more))
                    return None, unpack_keys(upsert(old, more, [*FACT_KEYS, PLACE]))

                with scratch(self.spark, "found") as put_found:
                    # Read several times below, and the diffs behind it are costly: written once.
                    changed = put_found(changed.distinct())
                    free_shuffles(self.spark)
                    # Laid out for the fact's buckets when it is made, so that it is not shuffled again to be written there.
                    found = put_found(
                        resolve(
                            of_changed("order_item"),
                            of_changed("orders"),
                            of_changed("delivery"),
                            {n: packed_keys(t.read(appended=False)) for n, t in dims.items()},
                            near=lambda rows: target.near(rows, touched),
                        )
                    )
                    free_shuffles(self.spark)
                    lacking = found.select("order_id", F.inline("_missing")).distinct()
                    if noted or waits or not lacking.isEmpty():
                        version = pending.merge(lacking, still_waiting, group, after=waits, last=last)
                        noted, waits = version if last else noted, [*waits, *group]
                    fresh = found.dropna(subset=DIMENSION_KEYS).select(*FACT_COLUMNS)
                    sources = upto | {"pending": noted}
                    version = target.merge(fresh, combine, group, sources=sources, after=done, last=last)
                    done += group
        free_shuffles(self.spark)
        return version

    def _arrived(self, waiting: DataFrame, read_to: dict[str, int]) -> DataFrame:
        """Waiting orders of which a dimension row was written since."""
        found = waiting.select("order_id").filter("false")
        for n in DIMENSIONS:
            dim, entity = self.dim(ENTITIES[n]), ENTITIES[n]
            written_since = dim.read(buckets=dim.touched_since(read_to[f"{n}_dim"]), appended=False)
            keys = written_since.select(F.col(entity.keys[0]).alias("key"))
            found = found.unionByName(waiting.filter(F.col("dimension") == n).join(keys, "key", "left_semi").select("order_id"))
        return found

    def refresh_dates(self) -> int:
        """Days of new orders to the date dimension. Only orders that changed are read."""
        source, target = self.clean(ENTITIES["orders"]), self.dates()
        read_to, upto = target.consumed("orders"), source.version()
        if read_to == upto:
            return target.version()
        days = source.changes(read_to, ["order_id", "order_date"]).select("order_date")
        known = target.read()
        ends = known.agg(F.min("calendar_date").alias("a"), F.max("calendar_date").alias("b"))
        both = days.unionByName(ends.select(F.explode(F.array("a", "b")).alias("order_date")).select(F.col("order_date").cast("timestamp")))
        fresh = build_date_dim(both, "order_date").join(known, "date_dim_hk", "left_anti")
        return target.append(fresh.select(*target.schema.names), sources={"orders": upto})

    def run_increment(self, entity: Entity, effective_ts: datetime) -> None:
        """Unread stage rows through clean table and dimension. Repeating it changes nothing."""
        self.refresh_clean(entity)
        if entity.dimension:
            self.refresh_dim(entity, effective_ts)

    def run_all(self, effective_ts: datetime, at_once: int = 4) -> None:
        """Entities do not depend on each other, so some of them run side by side; the fact comes last."""

        def one(entity: Entity) -> None:
            self.run_increment(entity, effective_ts)
            free_shuffles(self.spark)

        with ThreadPoolExecutor(at_once) as pool:
            for done in [pool.submit(inheritable_thread_target(one), e) for e in ENTITIES.values()]:
                done.result()
        self.refresh_dates()
        self.refresh_fact()

    def register_views(self, until: date | None = None) -> list[str]:
        """The consumption layer as temporary views for SQL: see ``views.register``."""
        dims = {n: self.dim(ENTITIES[n]).read() for n in DIMENSIONS}
        self.refresh_dates()
        days = self.dates().read()
        return register(self.fact().read(), days if until is None else build_date_dim(days, "calendar_date", until), dims)

    def reset_feed(self, entity: Entity) -> None:
        """The next refreshes start from now: what is unread stays unread for good."""
        self.clean(entity).mark_consumed({"stage": self.stage(entity).version()})
        if entity.dimension:
            self.dim(entity).mark_consumed({"clean": self.clean(entity).version()})
        if entity.name in FACT_FEEDS:
            self.fact().mark_consumed({entity.name: self.clean(entity).version()})

    def _table(self, name: str, schema: T.StructType, keys: list[str] | None = None, bucket_by: list[str] | None = None) -> VersionedTable:
        if name not in self._tables:
            path = f"{self.root}/{name}"
            self._tables[name] = VersionedTable(self.spark, path, schema, keys or [], bucket_by or [], self.buckets)
        return self._tables[name]

