"""Plans and results where one key holds most of the rows."""

from __future__ import annotations

from helpers import rows
from pyspark.sql import functions as F

from layercake.operators.merge import latest_per_key
from layercake.operators.quality import check_foreign_keys, check_unique
from layercake.operators.scd2 import scd2_from_log
from layercake.operators.sequence import as_of_join, in_pieces
from layercake.plans import kpis

N = 200_000


def hot(spark):
    """Two rows in three belong to key 0."""
    key = F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id"))
    return spark.range(0, N, 1, 8).select(key.alias("k"), "id", (F.col("id") % 7).alias("v"))


def test_partial_work_happens_before_the_shuffle(spark):
    df = hot(spark)
    for plan in (
        latest_per_key(df, ["k"], ["id"]),
        check_unique(df, ["k"]),
        check_foreign_keys(df, {"k": (spark.range(10), "id")}),
        kpis.order_rollup(df.select(F.col("k").alias("order_id"), F.col("id").alias("order_item_id"), F.col("v").alias("subtotal")), ["order_id"]),
    ):
        text = plan._jdf.queryExecution().executedPlan().toString()
        below = [part.splitlines()[1] for part in text.split("Exchange hashpartitioning")[1:]]
        assert all("HashAggregate" in line or "WindowGroupLimit" in line for line in below), text


def test_hot_key_results(spark):
    df = hot(spark)
    assert rows(latest_per_key(df, ["k"], ["id"]).filter("k = 0").select("id")) == [(N - 2 if (N - 1) % 3 == 2 else N - 1,)]
    assert rows(check_unique(df, ["k"]).filter("k = 0"))[0][1] == df.filter("k = 0").count()


def test_orders_of_a_hot_group_are_counted_by_many_tasks(spark):
    fact = hot(spark).select(F.col("k").alias("city"), F.col("id").alias("order_id"), F.lit(1).alias("revenue"), F.lit(1).alias("items"), F.lit(1).alias("largest"))
    # Spread without order, as a range is known to be clustered by its number already.
    plan = kpis.kpis(fact.repartition(8), ["city"])._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Exchange hashpartitioning(")[-1].split(")")[0]
    assert "city" in first and "order_id" in first


def test_hot_log_key_is_cut_into_pieces(spark):
    log = hot(spark).select("k", "v", F.timestamp_seconds(F.col("id") * 60).alias("ts"), "id")
    plain = scd2_from_log(log, ["k"], ["v"], "ts", ["id"])
    cut = scd2_from_log(log, ["k"], ["v"], "ts", ["id"], hot_rows=1000)
    both = [df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("k", "v", "eff_start", "eff_end", "hk").cast("decimal(38,0)"))).first() for df in (plain, cut)]
    assert both[0] == both[1]


def test_one_hot_key_at_one_time_spreads_over_pieces(spark):
    """All rows of the key agree in everything that orders them."""
    log = spark.range(0, 40_000, 1, 4).select(F.lit(7).alias("k"), F.lit("2025-01-01").cast("timestamp").alias("ts"), F.lit("a").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join pieces as small as these
    try:
        cut = in_pieces(log, ["k"], ["ts", "v"], 1000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in cut.groupBy("_piece").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 20_000
    assert scd2_from_log(log, ["k"], ["v"], "ts", hot_rows=1000).count() == 1


def test_as_of_join_of_a_hot_key_makes_no_pairs(spark):
    facts = hot(spark).select("k", "id", F.timestamp_seconds(F.col("id") * 60).alias("t"))
    versions = spark.range(0, N, 500).select(F.lit(0).alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("s"), F.col("id").alias("v"))
    joined = as_of_join(facts, versions, "k", "t", "s", values=["v"], hot_rows=1000)
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString().replace("Join LeftOuter", "").replace("Join LeftSemi", "").replace("Join LeftAnti", "")
    wrong = joined.filter("k = 0 AND v != id - id % 500 OR k != 0 AND v IS NOT NULL OR k = 0 AND v IS NULL")
    assert (wrong.count(), joined.count()) == (0, N)
