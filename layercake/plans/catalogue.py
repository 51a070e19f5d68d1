"""Every operator of the library as a query over the retail tables.

Each query takes (spark, folder of the Parquet tables) and returns a DataFrame over whole tables, with
plain column types: money as double, dates and timestamps as text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layercake.functions.hashing import compact_key, row_hash, surrogate_key
from layercake.functions.parse import json_field, month_label, name_part, parse_bool, parse_date, parse_ts, strict, typed
from layercake.operators import quality, scd2
from layercake.operators.clean import clean
from layercake.operators.merge import apply_diff, delete_where, feed_of, latest_per_key, merge_images, snapshot_diff, upsert
from layercake.plans import dashboard, kpis, retail
from layercake.plans.pipeline import Warehouse
from layercake.plans.star import FACT_KEYS, ORDER_TIME, build_date_dim, build_fact, key_columns, packed_keys
from layercake.plans.views import register
from layercake.registry import AUDIT, DIMENSIONS, ENTITIES
from layercake.session import by_parts, rounds, shared_dir, written
from layercake.sources.files import csv_options, list_stage, read_stage
from layercake.sources.tables import VersionedTable
from layercake.streaming.ingest import batch_time, stream_entity, stream_stage

Query = Callable[[SparkSession, str], DataFrame]

YEAR, MONTH = 1998, 3
LOADED = datetime(2025, 1, 1)
NEXT_DAY = datetime(2025, 1, 2)
AS_OF = datetime(2024, 1, 15, 12)


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike."""

    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[column(f) for f in df.schema])


# -- KPI marts -------------------------------------------------------------------------------------


def date_dim(spark: SparkSession, folder: str) -> DataFrame:
    return build_date_dim(retail.table(spark, folder, "orders"), "o_orderdate")


def kpi_yearly(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_yearly(retail.order_facts(spark, folder), date_dim(spark, folder), retail.DONE)


def kpi_yearly_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_yearly_dedup(retail.order_item_fact(spark, folder), date_dim(spark, folder), retail.DONE)


def kpi_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_monthly(retail.order_facts(spark, folder), date_dim(spark, folder), retail.DONE)


def kpi_daily(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_daily(retail.order_facts(spark, folder), date_dim(spark, folder), retail.DONE)


def kpi_dayname(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_dayname(retail.order_facts(spark, folder), date_dim(spark, folder))


def kpi_monthly_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = retail.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("hk"), F.col("s_name").alias("name"))
    fact = retail.order_item_fact(spark, folder)
    return kpis.kpi_monthly_by_restaurant(fact, date_dim(spark, folder), suppliers)


def kpi_by_nation_year(spark: SparkSession, folder: str) -> DataFrame:
    """The nation of the customer stands for the city of the address."""
    nations = retail.table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    places = retail.table(spark, folder, "customer").join(nations, "c_nationkey").select(F.col("c_custkey").alias("hk"), "city")
    found = kpis.kpi_by_city(retail.order_facts(spark, folder), date_dim(spark, folder), places)
    return found.withColumnRenamed("city", "nation")


def _part_types(spark: SparkSession, folder: str) -> DataFrame:
    return retail.table(spark, folder, "part").select(F.col("p_partkey").alias("hk"), F.col("p_type").alias("category"))


def kpi_by_part_type(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_by_category(retail.order_item_fact(spark, folder), _part_types(spark, folder), retail.DONE)


def kpi_by_part_type_order_totals(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_by_category_order_totals(retail.order_item_fact(spark, folder), _part_types(spark, folder), retail.DONE)


def delivered_rows(spark: SparkSession, folder: str) -> DataFrame:
    fact = kpis.delivered(retail.order_item_fact(spark, folder), retail.DONE)
    return fact.select("order_item_id", "order_id", "order_date", "delivery_status", "subtotal")


# -- dashboard -------------------------------------------------------------------------------------


def dash_yearly(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.yearly(kpi_yearly(spark, folder))


def dash_month_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.monthly_revenue(kpi_monthly(spark, folder), YEAR)


def dash_months(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.months(kpi_monthly_by_supplier(spark, folder), YEAR)


def dash_top10(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_restaurants(kpi_monthly_by_supplier(spark, folder), YEAR, MONTH)


def dash_yoy(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.year_over_year(kpi_yearly(spark, folder))


def dash_totals(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.totals(kpi_yearly(spark, folder))


def dash_latest_period(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.latest_period(kpi_monthly(spark, folder))


def dash_month_labels(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.month_labels(kpi_monthly(spark, folder), YEAR)


# -- merging and change feeds ----------------------------------------------------------------------


def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(retail.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _orders_now(spark: SparkSession, folder: str) -> DataFrame:
    return retail.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", retail.money("o_totalprice").alias("o_totalprice"), "o_orderpriority"
    )


def _orders_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A delivery of all orders: open ones are now fulfilled, low priorities are not given, customers
    are wrong, and every order in progress comes with a new order of negative number."""
    now = _orders_now(spark, folder)
    low = F.col("o_orderpriority") == "5-LOW"
    sent = now.withColumns(
        {
            "o_custkey": F.col("o_custkey") + 1,
            "o_orderstatus": F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus")),
            "o_orderpriority": F.when(~low, F.col("o_orderpriority")),
        }
    )
    added = now.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return sent.unionByName(added)


_ORDER_VALUES = ["o_orderstatus", "o_totalprice", "o_orderpriority"]


def _merge_orders(old: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(
        old,
        batch,
        ["o_orderkey"],
        compare=_ORDER_VALUES,
        update=_ORDER_VALUES,
        keep_if_null=["o_orderpriority"],
    )


def upsert_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _merge_orders(_orders_now(spark, folder), _orders_batch(spark, folder))


def upsert_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Every column compared and written, values becoming NULL included."""
    return upsert(_orders_now(spark, folder), _orders_batch(spark, folder), ["o_orderkey"])


def _orders_table(spark: SparkSession, folder: str, name: str) -> VersionedTable:
    now = _orders_now(spark, folder)
    made = VersionedTable(spark, shared_dir(spark, name), now.schema, ["o_orderkey"])
    made.overwrite(now)
    return made


def table_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The upsert on a versioned table, bucket by bucket."""
    orders = _orders_table(spark, folder, "table-upsert")
    batch = _orders_batch(spark, folder)
    orders.merge(batch, _merge_orders, orders.buckets_of(batch))
    return orders.read()


def table_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change feed between two versions of a table."""
    orders = _orders_table(spark, folder, "table-changes")
    batch = _orders_batch(spark, folder)
    orders.merge(batch, _merge_orders, orders.buckets_of(batch))
    return orders.changes(1)


def delete_where_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Neither a false nor an unknown condition deletes."""
    returned = (F.col("l_returnflag") == "R") & (F.nullif("l_linestatus", F.lit("F")) == "O")
    return delete_where(retail.table(spark, folder, "lineitem"), returned)


def truncate_table(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders_table(spark, folder, "truncate")
    before = orders.read()
    orders.truncate()
    counts = before.agg(F.count(F.lit(1)).alias("n")).select(F.lit(1).alias("version"), "n")
    return counts.unionByName(orders.read().agg(F.count(F.lit(1)).alias("n")).select(F.lit(2).alias("version"), "n"))


def _orders_after(spark: SparkSession, folder: str) -> DataFrame:
    return delete_where(upsert_orders(spark, folder), F.col("o_orderpriority") == "1-URGENT")


def snapshot_diff_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The change feed of an upsert and a deletion, out of the upsert's own join."""
    merged = merge_images(
        _orders_now(spark, folder), _orders_batch(spark, folder), ["o_orderkey"], _ORDER_VALUES, _ORDER_VALUES, ["o_orderpriority"],
        delete=F.col("o_orderpriority") == "1-URGENT",
    )
    return feed_of(merged, ["o_orderkey"])


def snapshot_diff_two(spark: SparkSession, folder: str) -> DataFrame:
    """The same feed from the two states of the table."""
    return snapshot_diff(_orders_now(spark, folder), _orders_after(spark, folder), ["o_orderkey"])


def snapshot_diff_applied(spark: SparkSession, folder: str) -> DataFrame:
    """The old table with the feed applied is the new table."""
    return apply_diff(_orders_now(spark, folder), snapshot_diff_orders(spark, folder), ["o_orderkey"])


# -- versions --------------------------------------------------------------------------------------


def scd2_log_events(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.scd2_from_log(retail.table(spark, folder, "events"), ["user_id"], ["event_type"], "ts", ["event_id"])


def scd2_log_hot_users(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every user of 20 events or more treated as a hot key."""
    log = retail.table(spark, folder, "events")
    return scd2.scd2_from_log(log, ["user_id"], ["event_type"], "ts", ["event_id"], hot_rows=20)


def scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.current(scd2_log_events(spark, folder))


def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.as_of(scd2_log_events(spark, folder), AS_OF)


def _weekly_events(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of each user and week."""
    events = retail.table(spark, folder, "events").withColumn("week", F.date_trunc("WEEK", "ts").cast("timestamp"))
    last = latest_per_key(events.select("user_id", "week", "ts", "event_id", "event_type"), ["user_id", "week"], ["ts", "event_id"])
    return written(last.select("user_id", "week", "event_type"), "weekly-events")


def scd2_weekly_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Week after week, the last event of each user is applied to a dimension table."""
    weekly = _weekly_events(spark, folder)
    schema = scd2.open_dimension(weekly, ["user_id"], ["event_type"], LOADED).schema
    dim = VersionedTable(spark, shared_dir(spark, "weekly-dim"), schema, ["user_id"], buckets=4)
    first, until = weekly.agg(F.min("week"), F.max("week")).first()
    while first <= until:
        batch, start = weekly.filter(F.col("week") == F.lit(str(first)).cast("timestamp")), first

        def combine(old: DataFrame, changes: DataFrame, at: datetime = start) -> DataFrame:
            moved = scd2.advance(old, changes, ["user_id"], ["event_type"], at)
            return moved.withColumn("_append", F.when(F.col("is_current"), 0).otherwise(1))

        dim.merge(batch, combine, dim.buckets_of(batch))
        first += timedelta(days=7)
    return dim.read()


def scd2_late_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks applied in no order of time: every second one first, then the others backwards."""
    weekly = _weekly_events(spark, folder)
    weeks = sorted(r[0] for r in weekly.select("week").distinct().collect())
    dim, seen = scd2.open_dimension(weekly.filter("false"), ["user_id"], ["event_type"], LOADED), None
    for at in weeks[1::2] + weeks[::2][::-1]:
        batch = weekly.filter(F.col("week") == F.lit(str(at)).cast("timestamp"))
        dim, seen = scd2.scd2_apply_late(dim, seen, batch, ["user_id"], ["event_type"], at)
        dim, seen = written(dim, "late-dim"), written(seen, "late-seen")
    return dim


def scd2_log_unplaced(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks have lost their user, and errors their time."""
    log = retail.table(spark, folder, "events").withColumns(
        {"user_id": F.expr("if(event_type = 'click', null, user_id)"), "ts": F.expr("if(event_type = 'error', null, ts)")}
    )
    return scd2.unplaced_rows(log, ["user_id"], "ts")


def scd2_close_deleted(spark: SparkSession, folder: str) -> DataFrame:
    """Deleted orders close their version; updated ones close one and open the next."""
    keys, tracked = ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    dim = scd2.open_dimension(_orders_now(spark, folder), keys, tracked, LOADED)
    return scd2.scd2_apply(dim, snapshot_diff_orders(spark, folder), keys, tracked, NEXT_DAY, delete="close")


# -- cleaning and quality --------------------------------------------------------------------------


def clean_rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _cleaned(spark, folder, name).drop(*AUDIT)


def _cleaned(spark: SparkSession, folder: str, name: str) -> DataFrame:
    entity = ENTITIES[name]
    return clean(entity, quality.split_stage(entity, retail.stage_rows(spark, folder, entity))[0])


def _clean_query(name: str) -> Query:
    return lambda spark, folder: clean_rows(spark, folder, name)


def clean_min_item_id(spark: SparkSession, folder: str) -> DataFrame:
    """Items from an id on."""
    entity = ENTITIES["order_item"]
    good = quality.split_stage(entity, retail.stage_rows(spark, folder, entity))[0]
    return clean(entity, good, min_id=1000).drop(*AUDIT)


def strict_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Text that must be readable: a value that is not would fail the query."""
    text = retail.table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "CAST(o_orderkey AS string) AS whole",
        "CAST(CAST(o_totalprice AS decimal(18,2)) AS string) AS price",
        "CASE WHEN o_orderkey % 2 = 0 THEN date_format(o_orderdate, 'M/d/yyyy') ELSE CAST(CAST(o_orderdate AS date) AS string) END AS day",
        "CASE WHEN o_orderkey % 5 <> 0 THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") END AS moment",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END AS flag",
    )
    kinds = {"whole": "bigint", "price": "decimal(18,2)", "day": "date", "moment": "timestamp", "flag": "boolean"}
    return text.select("o_orderkey", *[strict(c, kind).alias(c) for c, kind in kinds.items()])


def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    """One moment written in each accepted form, and in some that are not."""
    at = F.col("o_orderdate").cast("timestamp") + F.expr("make_dt_interval(0, 10, 5, 7)")
    forms = {
        "iso_t": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
        "iso_micros": F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "us_minute": F.date_format(at, "M/d/yyyy H:mm"),
        "us_date": F.date_format(at, "M/d/yyyy"),
        "iso_date": F.date_format(at, "yyyy-MM-dd"),
        "time_only": F.date_format(at, "HH:mm:ss"),
        "wrong_order": F.date_format(at, "d.M.yyyy"),
        "no_such_day": F.concat(F.date_format(at, "yyyy"), F.lit("-02-30")),
    }
    written_out = retail.table(spark, folder, "orders").select("o_orderkey", *[t.alias(n) for n, t in forms.items()])
    return written_out.select("o_orderkey", *[parse_ts(n).alias(n) for n in forms], parse_date("us_minute").alias("as_date"))


def lenient_casts(spark: SparkSession, folder: str) -> DataFrame:
    lines = retail.table(spark, folder, "lineitem").withColumns(
        {
            "price_text": retail.money("l_extendedprice").cast("string"),
            "flag_text": F.when(F.col("l_linestatus") == "O", "TRUE").when(F.col("l_returnflag") == "R", "False").otherwise("?"),
            "wide_status": F.concat(F.lit("  "), F.col("l_linestatus"), F.lit(" ")),
        }
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        typed("string(l_partkey)", "bigint").alias("whole"),
        typed("price_text", "bigint").alias("fraction_as_whole"),
        typed("price_text", "decimal(10,2)").alias("price"),
        typed("price_text", "decimal(6,2)").alias("small_price"),
        typed("l_returnflag", "bigint").alias("letter"),
        typed("wide_status", "text").alias("trimmed"),
        parse_bool("flag_text").alias("flag"),
    )


def json_props(spark: SparkSession, folder: str) -> DataFrame:
    props = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props"))
    events = retail.table(spark, folder, "events").withColumn("props", props)
    return events.select("event_id", json_field("props", "k bigint", "k").alias("k"))


def split_names(spark: SparkSession, folder: str) -> DataFrame:
    return retail.table(spark, folder, "part").select(
        "p_partkey", *[name_part("p_name", n).alias(f"word{n}") for n in (1, 2, 3)]
    )


def month_names(spark: SparkSession, folder: str) -> DataFrame:
    counted = retail.table(spark, folder, "orders").groupBy(F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    return counted.select("month", month_label("month").alias("label"), "orders")


def hash_keys(spark: SparkSession, folder: str) -> DataFrame:
    whole = row_hash(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    return _orders_now(spark, folder).select(
        "o_orderkey", whole.alias("row_key"), surrogate_key(["o_orderkey"]).alias("sk"), compact_key(whole).alias("short_key")
    )


def _order_rules() -> list[quality.Rule]:
    return [
        quality.not_null("o_clerk"),
        quality.max_length("o_orderpriority", 8),
        quality.castable("o_total_text", "decimal(7,2)"),
    ]


def _orders_to_check(spark: SparkSession, folder: str) -> DataFrame:
    return retail.table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_clerk"),
        "o_orderpriority",
        retail.money("o_totalprice").cast("string").alias("o_total_text"),
    )


def quality_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    bad = quality.split_valid(_orders_to_check(spark, folder), _order_rules())[1]
    return bad.select("o_orderkey", F.concat_ws("; ", "_reasons").alias("reasons"))


def quality_good_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.split_valid(_orders_to_check(spark, folder), _order_rules())[0]


def unique_check(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_unique(retail.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_check(spark: SparkSession, folder: str) -> DataFrame:
    """Large parts are missing on purpose."""
    lines = retail.table(spark, folder, "lineitem")
    return quality.check_foreign_keys(
        lines,
        {
            "l_orderkey": (retail.table(spark, folder, "orders"), "o_orderkey"),
            "l_partkey": (retail.table(spark, folder, "part").filter("p_size <= 40"), "p_partkey"),
            "l_suppkey": (retail.table(spark, folder, "supplier"), "s_suppkey"),
        },
    )


def masked_customers(spark: SparkSession, folder: str) -> DataFrame:
    return quality.mask(clean_rows(spark, folder, "customer"), ENTITIES["customer"].tags)


def masked_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    return quality.mask(clean_rows(spark, folder, "restaurant"), ENTITIES["restaurant"].tags)


# -- star schema -----------------------------------------------------------------------------------


def _dimension(spark: SparkSession, folder: str, name: str) -> DataFrame:
    entity = ENTITIES[name]
    return scd2.open_dimension(clean_rows(spark, folder, name), entity.keys, entity.tracked, LOADED)


def _dimension_query(name: str) -> Query:
    return lambda spark, folder: _dimension(spark, folder, name).select(
        *ENTITIES[name].keys, *scd2.META
    )


def star_date_dim(spark: SparkSession, folder: str) -> DataFrame:
    return build_date_dim(clean_rows(spark, folder, "orders"), "order_date")


def _star_tables(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, str]]:
    """What the fact is made of, with the column that names the order."""
    orders = clean_rows(spark, folder, "orders").select("order_id", "customer_id_fk", "restaurant_id_fk", "order_date")
    return {"orders": (orders, "order_id")} | {n: (clean_rows(spark, folder, n), "order_id_fk") for n in ("order_item", "delivery")}


def _star_of(tables: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], days: DataFrame | None, as_of: str | None = None) -> DataFrame:
    lines = latest_per_key(tables["order_item"], ["order_item_id", "order_id_fk"], ["modified_dt"])
    return build_fact(lines, tables["orders"], tables["delivery"], dims, days, as_of)


def _star_fact(spark: SparkSession, folder: str) -> DataFrame:
    """As one plan, of which the marts take what they need."""
    tables = {n: rows for n, (rows, _) in _star_tables(spark, folder).items()}
    return _star_of(tables, {n: _dimension(spark, folder, n) for n in DIMENSIONS}, star_date_dim(spark, folder))


def _star_by_parts(
    spark: SparkSession,
    folder: str,
    then: Callable[[DataFrame], DataFrame] = lambda fact: fact,
    dimension: Callable[[SparkSession, str, str], DataFrame] = _dimension,
    as_of: str | None = None,
    store: bool = False,
) -> DataFrame:
    """What ``then`` makes of the fact, some orders after the others where there are many; see ``by_parts``."""
    dims = {n: dimension(spark, folder, n) for n in DIMENSIONS}
    days, tables = None if as_of else star_date_dim(spark, folder), _star_tables(spark, folder)
    if rounds(spark, 2, *[rows for rows, _ in tables.values()]) > 1:  # what every part reads is made once
        dims = {n: packed_keys(written(key_columns(n, dim), f"star-{n}")) for n, dim in dims.items()}
        days = None if days is None else packed_keys(written(days, "star-days"), "date_dim_hk")
    return by_parts("star-fact", lambda part: then(_star_of(part, dims, days, as_of)), tables, store)


def star_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _star_by_parts(spark, folder)


def star_kpi_yearly(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_yearly(_star_fact(spark, folder), star_date_dim(spark, folder))


def star_kpi_by_restaurant(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_monthly_by_restaurant(
        _star_fact(spark, folder), star_date_dim(spark, folder), _dimension(spark, folder, "restaurant")
    )


def star_kpi_by_city(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_by_city(
        _star_fact(spark, folder), star_date_dim(spark, folder), _dimension(spark, folder, "customer_address")
    )


def star_kpi_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.kpi_by_category(_star_fact(spark, folder), _dimension(spark, folder, "menu"))


def star_views(spark: SparkSession, folder: str) -> DataFrame:
    """The marts by name, from SQL."""
    dims = {n: _dimension(spark, folder, n) for n in DIMENSIONS}
    register(_star_by_parts(spark, folder, store=True), star_date_dim(spark, folder), dims)
    return spark.sql("SELECT year, month, total_revenue, total_orders FROM vw_monthly_revenue_kpis WHERE total_orders > 1")


def star_fact_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The fact merged into an earlier state of itself, in which nothing was delivered yet."""

    def merged(fact: DataFrame) -> DataFrame:
        return upsert(fact.withColumn("delivery_status", F.lit("Pending")), fact, FACT_KEYS)

    return _star_by_parts(spark, folder, merged)


def _next_day(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stage rows of the day after: orders in progress are pending now, delivered by the same agents."""
    rows = retail.stage_rows(spark, folder, ENTITIES[name]).withColumn("_copy_data_ts", F.lit(str(NEXT_DAY)).cast("timestamp"))
    if name == "orders":
        return rows.filter("status = 'Processing'").withColumn("status", F.lit("Pending"))
    return rows.filter("deliverystatus = 'Processing'").withColumn("deliverystatus", F.lit("Pending"))


def star_fact_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """All entities through the warehouse, then a day of order and delivery changes. Only the orders
    that changed are rebuilt."""
    warehouse = Warehouse(spark, shared_dir(spark, "warehouse"), buckets=8)
    for name, rows in retail.stage_rows_of(spark, folder).items():
        if name == "order_item":
            rows = latest_per_key(rows, ["orderitemid", "orderid"], ["modifieddate"])
        warehouse.append_stage(ENTITIES[name], rows, "continue")
    warehouse.run_all(LOADED)
    for name in ("orders", "delivery"):
        warehouse.append_stage(ENTITIES[name], _next_day(spark, folder, name), "continue")
    warehouse.run_all(NEXT_DAY)
    return warehouse.fact().read()


def _warehouse_without(spark: SparkSession, folder: str, entity: str, late: str) -> Warehouse:
    """All entities through the warehouse but those rows of ``entity`` for which ``late`` is true."""
    warehouse = Warehouse(spark, shared_dir(spark, "warehouse"), buckets=4)
    for name, rows in retail.stage_rows_of(spark, folder).items():
        if name == "order_item":
            rows = latest_per_key(rows, ["orderitemid", "orderid"], ["modifieddate"])
        warehouse.append_stage(ENTITIES[name], delete_where(rows, F.expr(late)) if name == entity else rows, "continue")
    warehouse.run_all(LOADED)
    return warehouse


def _then_late(spark: SparkSession, folder: str, warehouse: Warehouse, entity: str, late: str) -> DataFrame:
    rows = retail.stage_rows(spark, folder, ENTITIES[entity]).filter(late)
    warehouse.append_stage(ENTITIES[entity], rows.withColumn("_copy_data_ts", F.lit(str(NEXT_DAY)).cast("timestamp")), "continue")
    warehouse.run_all(NEXT_DAY)
    return warehouse.fact().read()


LATE = {"customer": "customerid % 5 = 2", "menu": "category LIKE 'PROMO%'", "location": "locationid % 3 = 1"}


def star_fact_late_customer(spark: SparkSession, folder: str) -> DataFrame:
    """A fifth of the customers arrive a day after their orders, which then enter the fact."""
    return _then_late(spark, folder, _warehouse_without(spark, folder, "customer", LATE["customer"]), "customer", LATE["customer"])


def star_fact_late_menu(spark: SparkSession, folder: str) -> DataFrame:
    """Menu entries arrive a day after the items that order them."""
    return _then_late(spark, folder, _warehouse_without(spark, folder, "menu", LATE["menu"]), "menu", LATE["menu"])


def star_pending(spark: SparkSession, folder: str) -> DataFrame:
    """What orders wait for while some locations are missing, and again, for nothing, after these have come."""
    warehouse = _warehouse_without(spark, folder, "location", LATE["location"])
    before = written(warehouse.pending().read().withColumn("day", F.lit(1)), "pending")
    _then_late(spark, folder, warehouse, "location", LATE["location"])
    return before.unionByName(warehouse.pending().read().withColumn("day", F.lit(2)))


def star_fact_reassigned(spark: SparkSession, folder: str) -> DataFrame:
    """A day later, deliveries in progress have another agent and the first item of each order another menu entry."""
    warehouse = _warehouse_without(spark, folder, "", "")
    stamp = F.lit(str(NEXT_DAY)).cast("timestamp")
    moved = retail.stage_rows(spark, folder, ENTITIES["delivery"]).filter("deliverystatus = 'Processing'")
    agent = F.col("deliveryagentid").cast("long")
    warehouse.append_stage(
        ENTITIES["delivery"], moved.withColumns({"deliveryagentid": F.abs(agent - 1).cast("string"), "_copy_data_ts": stamp}), "continue"
    )
    items = retail.stage_rows(spark, folder, ENTITIES["order_item"]).filter("orderitemid % 10 = 1")
    items = latest_per_key(items, ["orderitemid", "orderid"], ["modifieddate"])
    warehouse.append_stage(ENTITIES["order_item"], items.withColumns({"menuid": F.lit("0"), "_copy_data_ts": stamp}), "continue")
    warehouse.run_all(NEXT_DAY)
    return warehouse.fact().read()


# Entity -> stage column that changes on the second day, and what to.
UPDATES = {
    "location": ("zipcode", "999999"),
    "restaurant": ("openstatus", "Moved"),
    "customer": ("mobile", "1"),
    "customer_address": ("locality", "Quarter 99"),
    "menu": ("itemname", "renamed"),
    "delivery_agent": ("phone", "1"),
    "orders": ("paymentmethod", "Card"),
    "order_item": ("quantity", "7"),
    "delivery": ("estimatedtime", "late"),
}


def _after_update(spark: SparkSession, folder: str, name: str) -> Warehouse:
    """A fifth of the rows come on the second day, and a third of all have a new value then."""
    entity, (column, value) = ENTITIES[name], UPDATES[name]
    warehouse, rows = Warehouse(spark, shared_dir(spark, f"update-{name}"), buckets=4), retail.stage_rows(spark, folder, entity)
    if name == "order_item":
        rows = latest_per_key(rows, ["orderitemid", "orderid"], ["modifieddate"])
    number = F.col(entity.headers[0]).cast("bigint")
    late, moved = number % 5 == 4, number % 3 == 1
    second = rows.filter(late | moved).withColumns(
        {column: F.when(moved, F.lit(value)).otherwise(F.col(column)), "_copy_data_ts": F.lit(str(NEXT_DAY)).cast("timestamp")}
    )
    for batch, at in ((rows.filter(~late), LOADED), (second, NEXT_DAY)):
        warehouse.append_stage(entity, batch, "continue")
        warehouse.run_increment(entity, at)
    return warehouse


def _update_query(name: str) -> Query:
    return lambda spark, folder: _after_update(spark, folder, name).clean(ENTITIES[name]).read().drop(*AUDIT)


def _update_dim_query(name: str) -> Query:
    return lambda spark, folder: _after_update(spark, folder, name).dim(ENTITIES[name]).read().select(*ENTITIES[name].keys, *scd2.META)


def feed_reset_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Delivery changes that were unread when their feed was reset never reach the fact; those after it do."""
    delivery, stamp = ENTITIES["delivery"], F.lit(str(NEXT_DAY)).cast("timestamp")
    warehouse = _warehouse_without(spark, folder, "", "")
    warehouse.append_stage(delivery, _next_day(spark, folder, "delivery"), "continue")
    warehouse.reset_feed(delivery)
    done = retail.stage_rows(spark, folder, delivery).filter("deliverystatus = 'Delivered' AND orderid % 3 = 1")
    warehouse.append_stage(delivery, done.withColumns({"estimatedtime": F.lit("late"), "_copy_data_ts": stamp}), "continue")
    warehouse.run_all(NEXT_DAY)
    return warehouse.fact().read()


SPRING, BEFORE_ALL = datetime(1998, 3, 1), datetime(1990, 1, 1)


def _dimension_with_history(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Open since long ago; in spring 1998 some customers moved, some menu prices rose, some restaurants opened elsewhere."""
    entity, rows = ENTITIES[name], clean_rows(spark, folder, name)
    dim = scd2.open_dimension(rows, entity.keys, entity.tracked, BEFORE_ALL)
    moves = {
        "customer": ("customer_id % 3 = 0", {"mobile": F.lit("1")}),
        "menu": ("category = 'ECONOMY'", {"price": (F.col("price") + 1).cast("decimal(10,2)")}),
        "restaurant": ("restaurant_id % 2 = 0", {"location_id_fk": F.lit(0).cast("long")}),
    }
    if name not in moves:
        return dim
    condition, new = moves[name]
    return scd2.scd2_apply(dim, rows.filter(condition).withColumns(new), entity.keys, entity.tracked, SPRING)


def star_fact_as_of_order(spark: SparkSession, folder: str) -> DataFrame:
    """Every item with the dimension versions valid when its order was placed."""
    return _star_by_parts(spark, folder, dimension=_dimension_with_history, as_of=ORDER_TIME)


# -- files and streams -----------------------------------------------------------------------------


def _land(rows: DataFrame, folder: str, files: int = 4) -> str:
    """Writes rows as CSV files the way a source system would deliver them."""
    options = {k: v for k, v in csv_options().items() if k in ("header", "sep", "quote", "escape", "nullValue")}
    rows.repartition(files).write.mode("append").options(**options).csv(folder)
    return folder


def _stage_text(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return retail.stage_rows(spark, folder, ENTITIES[name]).drop(*AUDIT)


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as CSV, read back and cleaned: quotes, commas and JSON survive."""
    landing = _land(_stage_text(spark, folder, "customer"), shared_dir(spark, "csv"))
    stage = read_stage(spark, ENTITIES["customer"], landing, LOADED)
    return clean(ENTITIES["customer"], stage, on_error="continue").drop(*AUDIT)


def csv_header_binding(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the files have one column more, in the middle."""
    rows = _stage_text(spark, folder, "delivery")
    landing = shared_dir(spark, "headers")
    done = F.col("deliverystatus") == "Delivered"
    names = ENTITIES["delivery"].headers
    _land(rows.filter(~done), landing, 2)
    _land(rows.filter(done).select(*names[:4], F.col("deliverystatus").alias("status"), *names[4:]), landing, 2)
    return clean(ENTITIES["delivery"], read_stage(spark, ENTITIES["delivery"], landing, LOADED)).drop(*AUDIT)


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Menus of which economy types come with junk for a number and promos without a name."""
    rows = _stage_text(spark, folder, "menu")
    kind = F.trim("category")
    broken = rows.withColumns(
        {
            "menuid": F.when(kind == "ECONOMY", F.concat(F.lit("junk"), "menuid")).otherwise(F.col("menuid")),
            "itemname": F.when(kind != "PROMO", F.col("itemname")),
        }
    )
    menu = ENTITIES["menu"]
    warehouse = Warehouse(spark, shared_dir(spark, "quarantine"), buckets=4)
    warehouse.load_stage(menu, _land(broken, shared_dir(spark, "menus")), LOADED, on_error="continue")
    warehouse.refresh_clean(menu)
    bad = warehouse.quarantine(menu).read().select(F.col("menuid").alias("menu"), F.concat_ws("; ", "_reasons").alias("reasons"))
    return bad.unionByName(
        warehouse.clean(menu).read().select(F.col("menu_id").cast("string").alias("menu"), F.lit("").alias("reasons"))
    )


def csv_unknown_header(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries in progress come in another order with one column renamed, fulfilled ones without their last column."""
    delivery, rows = ENTITIES["delivery"], _stage_text(spark, folder, "delivery")
    landing, names = shared_dir(spark, "unknown-headers"), ENTITIES["delivery"].headers
    state = F.col("deliverystatus")
    _land(rows.filter(state == "Pending"), landing, 1)
    _land(rows.filter(state == "Delivered").select(*names[1:-1], names[0]), landing, 1)
    _land(rows.filter(state == "Processing").select(names[1], names[0], *names[2:-1], F.lit("x").alias("more")), landing, 1)
    warehouse = Warehouse(spark, shared_dir(spark, "unknown-header-tables"), buckets=4)
    for _ in range(2):
        warehouse.load_stage(delivery, landing, LOADED, on_error="continue")
    warehouse.refresh_clean(delivery)
    held = warehouse.quarantine(delivery).read().select(F.col("deliveryid").alias("id"), F.concat_ws("; ", "_reasons").alias("reasons"))
    good = warehouse.clean(delivery).read()
    return held.unionByName(good.select(F.col("delivery_id").cast("string").alias("id"), F.col("delivery_status").alias("reasons")))


def csv_abort(spark: SparkSession, folder: str) -> DataFrame:
    """A load with unreadable ids leaves no row; the one before it stays."""
    menu, rows = ENTITIES["menu"], _stage_text(spark, folder, "menu")
    broken = rows.withColumn("menuid", F.when(F.trim("category") == "ECONOMY", F.lit("junk")).otherwise(F.col("menuid")))
    warehouse = Warehouse(spark, shared_dir(spark, "abort"), buckets=4)
    outcome = []
    for n, part in enumerate((rows.filter("trim(category) <> 'ECONOMY'"), broken)):
        try:
            warehouse.load_stage(menu, _land(part, shared_dir(spark, "abort-menus"), 2), LOADED)
        except ValueError as problem:
            outcome.append((n, str(problem).rsplit(": ", 1)[-1]))
    staged = warehouse.stage(menu).read().select("menuid", F.lit("").alias("problem"))
    problems = [F.struct(F.lit(str(n)).alias("menuid"), F.lit(p).alias("problem")) for n, p in outcome]
    return staged.unionByName(spark.range(1).select(F.inline(F.array(*problems)))) if problems else staged


def stage_delete(spark: SparkSession, folder: str) -> DataFrame:
    """Stage rows deleted by pattern; the clean table keeps them, and nothing is read twice."""
    menu = ENTITIES["menu"]
    warehouse = Warehouse(spark, shared_dir(spark, "stage-delete"), buckets=4)
    warehouse.append_stage(menu, retail.stage_rows(spark, folder, menu), "continue")
    warehouse.delete_stage(menu, F.col("category").like("%ECONOMY%"))
    warehouse.refresh_clean(menu)
    staged = warehouse.stage(menu).read().select(F.lit("stage").alias("layer"), F.col("menuid").try_cast("bigint").alias("menu_id"))
    return staged.unionByName(warehouse.clean(menu).read().select(F.lit("clean").alias("layer"), "menu_id"))


def load_once(spark: SparkSession, folder: str) -> DataFrame:
    """The same files loaded twice count once."""
    landing = _land(_stage_text(spark, folder, "orders"), shared_dir(spark, "once"))
    warehouse = Warehouse(spark, shared_dir(spark, "once-tables"), buckets=4)
    for _ in range(2):
        warehouse.load_stage(ENTITIES["orders"], landing, LOADED)
    loaded = warehouse.stage(ENTITIES["orders"]).read()
    return loaded.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    listed = list_stage(spark, _land(_stage_text(spark, folder, "orders"), shared_dir(spark, "listing")))
    written_files = listed.filter(F.col("path").endswith(".csv"))
    return written_files.agg(F.count("path").alias("files"), (F.min("length") > 0).alias("filled"))


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Orders arriving as files, two per micro-batch; a second run finds nothing new."""
    orders = ENTITIES["orders"]
    landing, tables = _land(_stage_text(spark, folder, "orders"), shared_dir(spark, "landing")), shared_dir(spark, "stream")
    warehouse = Warehouse(spark, tables, buckets=4)
    for _ in range(2):
        stream_stage(warehouse, orders, landing, f"{tables}/checkpoint", LOADED, max_files=2).awaitTermination()
    return clean(orders, warehouse.stage(orders).read()).drop(*AUDIT)


def stream_to_scd2(spark: SparkSession, folder: str) -> DataFrame:
    """Customers arriving as files, then those who changed their phone, through to the dimension."""
    customer = ENTITIES["customer"]
    landing, tables = shared_dir(spark, "customers"), shared_dir(spark, "stream-scd2")
    warehouse = Warehouse(spark, tables, buckets=4)
    first = _stage_text(spark, folder, "customer")
    changed = first.filter(F.col("preferences").contains("BUILDING")).withColumn("mobile", F.lit("1234567890"))
    for rows, at in ((first, LOADED), (changed, NEXT_DAY)):
        _land(rows, landing, 2)
        stream_entity(warehouse, customer, landing, f"{tables}/checkpoint", at, at).awaitTermination()
    return warehouse.dim(customer).read().select("customer_id", "mobile", "eff_start", "eff_end", "is_current")


def stream_two_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as files of one run, those with a new phone in the second batch. Each batch has its own time, also when the
    second one is replayed at another."""
    agent = ENTITIES["delivery_agent"]
    landing, tables = shared_dir(spark, "agents"), shared_dir(spark, "stream-times")
    first = _stage_text(spark, folder, "delivery_agent")
    _land(first, landing, 1)
    _land(first.filter("deliveryagentid % 3 = 0").withColumn("phone", F.lit("1")), landing, 1)
    days = [LOADED, NEXT_DAY]
    for replayed in (False, True):
        warehouse = Warehouse(spark, f"{tables}/{replayed}", buckets=4)
        times = (lambda batch: days[batch]) if not replayed else (lambda batch: AS_OF)
        checkpoint = f"{tables}/checkpoint-{replayed}"
        if replayed:  # the notes of a run that was lost after it had begun both batches
            for batch, day in enumerate(days):
                batch_time(spark, checkpoint, batch, day)
        stream_entity(warehouse, agent, landing, checkpoint, LOADED, times, max_files=1).awaitTermination()
    return warehouse.dim(agent).read().select("delivery_agent_id", "phone", "eff_start", "eff_end", "is_current")


def feed_reset(spark: SparkSession, folder: str) -> DataFrame:
    """What was unread when the feed was reset is never read; what comes later is."""
    customer = ENTITIES["customer"]
    warehouse = Warehouse(spark, shared_dir(spark, "reset"), buckets=4)
    rows = retail.stage_rows(spark, folder, customer)
    warehouse.append_stage(customer, rows, "continue")
    warehouse.reset_feed(customer)
    warehouse.append_stage(customer, rows.filter("gender = 'Male'"), "continue")
    warehouse.run_increment(customer, NEXT_DAY)
    return warehouse.dim(customer).read().select("customer_id", "first_name", "gender", "eff_start")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        date_dim, kpi_yearly, kpi_yearly_dedup, kpi_monthly, kpi_daily, kpi_dayname, kpi_monthly_by_supplier,
        kpi_by_nation_year, kpi_by_part_type, kpi_by_part_type_order_totals, delivered_rows,
        dash_yearly, dash_month_revenue, dash_months, dash_top10, dash_yoy, dash_totals, dash_latest_period,
        dash_month_labels,
        dedup_latest, upsert_orders, upsert_nulls, table_upsert, table_changes, delete_where_lines, truncate_table,
        snapshot_diff_orders, snapshot_diff_two, snapshot_diff_applied,
        scd2_log_events, scd2_log_hot_users, scd2_current, scd2_as_of, scd2_weekly_batches, scd2_close_deleted, scd2_late_batch,
        scd2_log_unplaced,
        clean_min_item_id, strict_casts, parse_dates, lenient_casts, json_props, split_names, month_names, hash_keys,
        quality_bad_rows, quality_good_rows, unique_check, fk_check, masked_customers, masked_restaurants,
        star_date_dim, star_fact, star_kpi_yearly, star_kpi_by_restaurant, star_kpi_by_city, star_kpi_by_category,
        star_views, star_fact_merge, star_fact_incremental, star_fact_late_customer, star_fact_late_menu, star_pending,
        star_fact_reassigned, star_fact_as_of_order,
        csv_roundtrip, csv_header_binding, csv_unknown_header, csv_abort, csv_quarantine, stage_delete, load_once, list_files, stream_ingest, stream_to_scd2,
        stream_two_batches,
        feed_reset, feed_reset_fact,
    ]
}
QUERIES |= {f"clean_{n}": _clean_query(n) for n in ENTITIES}
QUERIES |= {f"dim_{n}": _dimension_query(n) for n in DIMENSIONS}
QUERIES |= {f"update_{n}": _update_query(n) for n in ENTITIES}
QUERIES |= {f"update_dim_{n}": _update_dim_query(n) for n in DIMENSIONS}
