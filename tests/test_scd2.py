from __future__ import annotations

from datetime import datetime, timedelta

from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from layercake.operators.merge import snapshot_diff
from layercake.operators.scd2 import as_of, current, open_dimension, scd2_apply, scd2_apply_late, scd2_from_log, unplaced_rows
from layercake.operators.sequence import as_of_join, carry_last
from layercake.operators.skew import hot_keys, split_hot

D = [datetime(2025, 1, d) for d in range(1, 10)]
SCHEMA = "id long, zip string"
LOG = "id long, v string, ts timestamp, n long"


def versions(dim):
    return rows(dim.select("id", "zip", F.dayofmonth("eff_start"), F.dayofmonth("eff_end"), "is_current"))


def stored(spark, tables):
    """Each batch starts from tables, not from the plan of all batches before it."""
    return tuple(spark.createDataFrame(t.collect(), t.schema) for t in tables)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_back_to_an_old_value_opens_a_third_version(spark):
    dim = open_dimension(frame(spark, (1, "A"), (2, "Z")), ["id"], ["zip"], D[0])
    dim = scd2_apply(dim, frame(spark, (1, "B"), (2, "Z")), ["id"], ["zip"], D[1])
    dim = scd2_apply(dim, frame(spark, (1, "A"), (3, None)), ["id"], ["zip"], D[2])
    assert versions(dim) == [
        (1, "A", 1, 2, False), (1, "A", 3, None, True), (1, "B", 2, 3, False), (2, "Z", 1, None, True), (3, None, 3, None, True),
    ]
    assert dim.select("hk").distinct().count() == 5


def test_batches_of_one_time_replace_the_open_version(spark):
    dim = open_dimension(frame(spark, (1, "A"), (2, "Z")), ["id"], ["zip"], D[2])
    for value in "BA":
        dim = scd2_apply(dim, frame(spark, (1, value)), ["id"], ["zip"], D[2])
        assert versions(dim) == [(1, value, 3, None, True), (2, "Z", 3, None, True)]
    # An earlier one changes nothing here: it needs the history.
    assert versions(scd2_apply(dim, frame(spark, (1, "C")), ["id"], ["zip"], D[0])) == versions(dim)
    dim = scd2_apply(dim, frame(spark, (1, "B"), (7, None)), ["id"], ["zip"], D[3])
    assert versions(dim)[:2] == [(1, "A", 3, 4, False), (1, "B", 4, None, True)]
    feed = snapshot_diff(frame(spark, (1, "B"), (2, "Z")), frame(spark), ["id"])
    gone = scd2_apply(dim, feed, ["id"], ["zip"], D[3], delete="close")
    assert versions(gone) == [(1, "A", 3, 4, False), (2, "Z", 3, 4, False), (7, None, 4, None, True)]


def test_late_batch_is_spliced_into_the_history(spark):
    dim, seen = open_dimension(frame(spark, (1, "A"), (2, "Z")), ["id"], ["zip"], D[2]), None
    for value, at in (("B", D[6]), ("C", D[4]), ("A", D[0]), ("B", D[7])):
        dim, seen = stored(spark, scd2_apply_late(dim, seen, frame(spark, (1, value)), ["id"], ["zip"], at))
    # A is known from day 1 on now, and was seen again on day 3; B was seen again on day 8.
    assert versions(dim) == [(1, "A", 1, 5, False), (1, "B", 7, None, True), (1, "C", 5, 7, False), (2, "Z", 3, None, True)]
    assert rows(seen.select("zip", F.dayofmonth("eff_start"))) == [("A", 3), ("B", 8)]
    dim, seen = stored(spark, scd2_apply_late(dim, seen, frame(spark, (1, "X")), ["id"], ["zip"], D[1]))
    assert versions(dim)[:3] == [(1, "A", 1, 2, False), (1, "A", 3, 5, False), (1, "B", 7, None, True)]
    feed = snapshot_diff(frame(spark, (1, "B")), frame(spark), ["id"])
    dim, seen = scd2_apply_late(dim, seen, feed, ["id"], ["zip"], D[5], delete="close")
    assert versions(dim) == [
        (1, "A", 1, 2, False), (1, "A", 3, 5, False), (1, "B", 7, None, True), (1, "C", 5, 6, False), (1, "X", 2, 3, False),
        (2, "Z", 3, None, True),
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.sampled_from([None, "A", "B"]), st.integers(0, 4)), min_size=1, max_size=6))
def test_batches_in_any_order_give_the_versions_of_their_log(spark, batches):
    """The last batch of a key and time counts, wherever the others stand."""
    dim = open_dimension(frame(spark), ["id"], ["zip"], D[0])
    seen = None
    for key, value, at in batches:
        dim, seen = stored(spark, scd2_apply_late(dim, seen, frame(spark, (key, value)), ["id"], ["zip"], D[at]))
    last = {(k, at): v for k, v, at in batches}
    log = spark.createDataFrame([(k, v, D[at], 0) for (k, at), v in last.items()], LOG)
    whole = scd2_from_log(log.withColumnRenamed("v", "zip"), ["id"], ["zip"], "ts", ["n"])
    assert rows(dim.select(*whole.columns)) == rows(whole)


def test_null_to_value_and_back(spark):
    dim = open_dimension(frame(spark, (1, None)), ["id"], ["zip"], D[0])
    dim = scd2_apply(dim, frame(spark, (1, "A")), ["id"], ["zip"], D[1])
    dim = scd2_apply(dim, frame(spark, (1, None)), ["id"], ["zip"], D[2])
    assert [(v[1], v[4]) for v in versions(dim)] == [("A", False), (None, False), (None, True)]


def test_real_deletes_close_only_on_request(spark):
    old, new = frame(spark, (1, "A"), (2, "B")), frame(spark, (1, "A2"))
    feed = snapshot_diff(old, new, ["id"])
    dim = open_dimension(old, ["id"], ["zip"], D[0])
    assert versions(scd2_apply(dim, feed, ["id"], ["zip"], D[1]))[-1] == (2, "B", 1, None, True)
    closed = versions(scd2_apply(dim, feed, ["id"], ["zip"], D[1], delete="close"))
    assert closed == [(1, "A", 1, 2, False), (1, "A2", 2, None, True), (2, "B", 1, 2, False)]


def test_as_of_and_current(spark):
    dim = open_dimension(frame(spark, (1, "A")), ["id"], ["zip"], D[0])
    dim = scd2_apply(dim, frame(spark, (1, "B")), ["id"], ["zip"], D[3])
    assert [r[1] for r in versions(as_of(dim, D[3] - timedelta(seconds=1)))] == ["A"]
    assert [r[1] for r in versions(as_of(dim, D[3]))] == ["B"]
    assert as_of(dim, D[0] - timedelta(seconds=1)).count() == 0
    assert [r[1] for r in versions(current(dim))] == ["B"]


def brute(log):
    """Versions of a log the slow way."""
    out = []
    for key in {r[0] for r in log}:
        mine = sorted((r for r in log if r[0] == key), key=lambda r: (r[2], r[3]))
        kept = [r for i, r in enumerate(mine) if i == 0 or r[1] != mine[i - 1][1]]
        for i, r in enumerate(kept):
            out.append((key, r[1], r[2], kept[i + 1][2] if i + 1 < len(kept) else None))
    return sorted(out, key=repr)


def found(dim):
    return rows(dim.select("id", "v", "eff_start", "eff_end"))


log_rows = st.lists(
    st.tuples(st.integers(1, 3), st.sampled_from(["a", "b", None]), st.integers(0, 60)), min_size=1, max_size=40
).map(lambda ls: [(k, v, datetime(2025, 1, 1) + timedelta(minutes=30 * m), i) for i, (k, v, m) in enumerate(ls)])


@given(log=log_rows)
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_hot_and_plain_paths_agree_with_brute_force(spark, log):
    df = spark.createDataFrame(log, LOG)
    plain = scd2_from_log(df, ["id"], ["v"], "ts", ["n"])
    hot = scd2_from_log(df, ["id"], ["v"], "ts", ["n"], hot_rows=1)
    mixed = scd2_from_log(df, ["id"], ["v"], "ts", ["n"], hot_rows=10)
    assert found(plain) == found(hot) == found(mixed) == brute(log)


def test_log_equals_daily_batches(spark):
    log = [(k, "abca"[(k + d) % 4] if (k * d) % 3 else "a", D[d], d) for k in range(1, 6) for d in range(6)]
    df = spark.createDataFrame(log, LOG)
    dim = open_dimension(df.filter(F.col("ts") == F.lit(str(D[0]))).select("id", "v"), ["id"], ["v"], D[0])
    for d in D[1:6]:
        day = df.filter(F.col("ts") == F.lit(str(d)).cast("timestamp")).select("id", "v")
        dim = scd2_apply(dim, day, ["id"], ["v"], d)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    whole = scd2_from_log(df, ["id"], ["v"], "ts", ["n"])
    assert found(dim) == found(whole)
    assert rows(dim.select("hk", "attr_hash")) == rows(whole.select("hk", "attr_hash"))


def test_one_current_row_and_no_overlap(spark):
    log = [(1, "ab"[i % 2], D[0] + timedelta(hours=i), i) for i in range(100)]
    dim = scd2_from_log(spark.createDataFrame(log, LOG), ["id"], ["v"], "ts", ["n"], hot_rows=5)
    spans = sorted((r["eff_start"], r["eff_end"]) for r in dim.select("eff_start", F.coalesce("eff_end", F.lit("9999-01-01").cast("timestamp")).alias("eff_end")).collect())
    assert len(spans) == 100 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert current(dim).count() == 1


def test_hot_keys_are_the_frequent_ones(spark):
    df = spark.range(90).select(F.when(F.col("id") < 30, 1).otherwise(F.col("id")).alias("k"))
    assert rows(hot_keys(df, ["k"], 10)) == [(1,)]
    assert split_hot(df, ["k"], 10**6)[0] is None
    hot, cold = split_hot(df, ["k"], 10)
    assert (hot.count(), cold.count()) == (30, 60)


def test_rows_without_key_or_time_have_no_version(spark):
    log = spark.createDataFrame([(None, "a", D[0], 1), (1, "a", None, 2), (1, "a", D[0], 3)], LOG)
    assert found(scd2_from_log(log, ["id"], ["v"], "ts", ["n"])) == [(1, "a", D[0], None)]
    assert rows(unplaced_rows(log, ["id"], "ts")) == [("key", 1), ("nothing", 1), ("time", 1)]


steps = st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 9), st.booleans(), st.sampled_from(["a", "b"])), max_size=30)


@given(steps=steps)
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_as_of_join_by_definition(spark, steps):
    def day(m):
        return datetime(2025, 1, 1) + timedelta(hours=m)

    facts = [(i, k, day(t) if t else None) for i, (k, t, is_fact, _) in enumerate(steps) if is_fact]
    held = {(k, t): v for k, t, is_fact, v in steps if not is_fact and k is not None}
    marks = [(k, day(t), day(t + 2) if v == "a" else None, v) for (k, t), v in held.items()]
    left = spark.createDataFrame(facts, "n long, k long, t timestamp")
    right = spark.createDataFrame(marks, "k long, s timestamp, e timestamp, v string")
    want = []
    for n, k, t in facts:
        known = [m for m in marks if t is not None and m[0] == k and m[1] <= t]
        best = max(known, key=lambda m: m[1], default=None)
        want.append((n, k, t, best[3] if best and (best[2] is None or t < best[2]) else None))
    for hot_rows in (1, 10**6):
        assert rows(as_of_join(left, right, "k", "t", "s", "e", ["v"], hot_rows)) == sorted(want, key=repr)


def test_carry_over_pieces_without_a_value(spark):
    data = [(1, i, "x" if i in (0, 70) else None) for i in range(100)]
    df = spark.createDataFrame(data, "k long, i long, v string").repartition(5)
    assert rows(carry_last(df, ["k"], ["i"], "v", hot_rows=10).groupBy("v").count()) == [("x", 100)]
