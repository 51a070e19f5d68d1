from __future__ import annotations

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from layercake.operators.merge import apply_diff, delete_where, feed_of, latest_per_key, merge_images, rows_of, snapshot_diff, upsert

SCHEMA = "id long, a string, b int"
QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
table = st.dictionaries(
    st.integers(0, 8), st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None])), max_size=8
).map(lambda d: [(k, *v) for k, v in d.items()])


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_latest_per_key_takes_the_last_and_never_flips(spark):
    data = [(1, "x", 1), (1, "y", 1), (1, "y", None), (2, None, 5), (2, "a", None)]
    for order in (data, data[::-1]):
        df = frame(spark, order).repartition(3)
        assert rows(latest_per_key(df, ["id"], ["b"])) == [(1, "y", 1), (2, None, 5)]


def test_latest_per_key_reduces_before_the_shuffle(spark):
    plan = latest_per_key(frame(spark, [(1, "x", 1)]), ["id"], ["b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_upsert_sees_null_changes(spark):
    old = frame(spark, [(1, "x", 1), (2, None, 2), (3, "z", 3)])
    new = frame(spark, [(1, None, 1), (2, "y", 2), (4, "w", None)])
    assert rows(upsert(old, new, ["id"])) == [(1, None, 1), (2, "y", 2), (3, "z", 3), (4, "w", None)]


def test_upsert_column_rules(spark):
    old = frame(spark, [(1, "x", 1), (2, "x", 1)])
    new = frame(spark, [(1, None, 2), (2, "y", 1), (3, None, None)])
    kept = upsert(old, new, ["id"], keep_if_null=["a"])
    assert rows(kept) == [(1, "x", 2), (2, "y", 1), (3, None, None)]
    insert_only = upsert(old, new, ["id"], compare=["b"], update=["b"])
    assert rows(insert_only) == [(1, "x", 2), (2, "x", 1), (3, None, None)]


@given(old=table, new=table)
@QUICK
def test_upsert_is_idempotent(spark, old, new):
    once = upsert(frame(spark, old), frame(spark, new), ["id"])
    expected = {r[0]: r for r in old} | {r[0]: r for r in new}
    assert rows(once) == sorted(expected.values(), key=repr)
    assert rows(upsert(once, frame(spark, new), ["id"])) == rows(once)


@given(old=table, new=table)
@QUICK
def test_diff_and_apply_are_inverse(spark, old, new):
    a, b = frame(spark, old), frame(spark, new)
    feed = snapshot_diff(a, b, ["id"])
    assert rows(apply_diff(a, feed, ["id"])) == rows(b)
    assert snapshot_diff(a, a, ["id"]).count() == 0
    before, after = {r[0]: r for r in old}, {r[0]: r for r in new}
    expected = []
    for k in before.keys() | after.keys():
        if before.get(k) != after.get(k):
            both = k in before and k in after
            expected += [(*before[k], "DELETE", both)] if k in before else []
            expected += [(*after[k], "INSERT", both)] if k in after else []
    assert rows(feed) == sorted(expected, key=repr)


def test_delete_where_keeps_unknown(spark):
    df = frame(spark, [(1, "junk", 1), (2, None, 1), (3, "fine", 1)])
    assert [r[0] for r in rows(delete_where(df, F.col("a").like("%junk%")))] == [2, 3]


@pytest.mark.parametrize("wide", [40])
def test_wide_tables_plan_quickly(spark, wide):
    """Comparing column by column would derive 2^40 filters here."""
    cols = [F.col("id").alias(f"c{i}") for i in range(wide)]
    a = spark.range(5).select("id", *cols)
    b = a.withColumn("c0", F.lit(1).cast("long"))
    assert snapshot_diff(a.filter("false"), b, ["id"]).count() == 5
    assert snapshot_diff(a, b, ["id"]).count() == 8


def test_feed_out_of_the_merge_shuffles_each_side_once(spark, tmp_path):
    old = spark.range(100).selectExpr("id", "string(id % 7) AS v", "string(id) AS w")
    new = spark.range(50, 150).selectExpr("id", "if(id % 5 = 0, null, string(id % 3)) AS v", "'n' AS w")
    for name, df in (("old", old), ("new", new)):
        df.write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
    images = merge_images(old, new, ["id"], ["v"], ["v"], ["v"], delete=F.col("v") == "1")
    after = delete_where(upsert(old, new, ["id"], ["v"], ["v"], ["v"]), F.col("v") == "1")
    assert rows(rows_of(images, ["id"])) == rows(after)
    feed = feed_of(images, ["id"])
    assert rows(feed) == rows(snapshot_diff(old, after, ["id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feed._jdf.queryExecution().sparkPlan().toString()
        shuffled = feed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 2 and shuffled.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2
