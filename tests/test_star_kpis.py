from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from layercake.plans import dashboard, kpis
from layercake.operators.merge import upsert
from layercake.plans.star import DIMENSION_KEYS, ORDER_TIME, build_date_dim, build_fact, date_key

FACT = "order_item_id long, order_id long, order_date date, delivery_status string, subtotal decimal(10,2)"


@pytest.fixture(scope="module")
def fact(spark):
    data = [
        (1, 10, date(2019, 12, 31), "Delivered", Decimal("10.00")),
        (2, 10, date(2019, 12, 31), "Delivered", Decimal("0.05")),
        (2, 10, date(2019, 12, 31), "Delivered", Decimal("0.04")),
        (3, 11, date(2021, 1, 1), "Delivered", Decimal("7.00")),
        (4, 12, date(2021, 2, 1), "Canceled", Decimal("99.00")),
        (None, 13, date(2021, 2, 1), "Delivered", Decimal("1.00")),
    ]
    return spark.createDataFrame(data, FACT)


@pytest.fixture(scope="module")
def days(fact):
    return build_date_dim(fact, "order_date")


def test_date_dim_includes_both_ends(spark, days):
    ends = days.agg(F.min("calendar_date"), F.max("calendar_date"), F.count(F.lit(1))).first()
    assert tuple(ends) == (date(2019, 12, 31), date(2021, 2, 1), 399)
    first = days.filter("calendar_date = DATE '2019-12-31'").drop("date_dim_hk").first()
    assert tuple(first) == (date(2019, 12, 31), 2019, 4, 12, 1, 365, 3, 31, "Tue")
    assert days.select("date_dim_hk").distinct().count() == 399


def test_date_dim_until_and_limits(spark):
    orders = spark.createDataFrame([(datetime(2024, 1, 1, 12),)], "t timestamp")
    assert build_date_dim(orders, "t", date(2024, 1, 3)).count() == 3
    assert build_date_dim(orders, "t", date(2023, 1, 3)).count() == 0
    assert build_date_dim(orders.filter("false"), "t").count() == 0
    wild = spark.createDataFrame([(datetime(1700, 1, 1),), (datetime(2900, 1, 1),)], "t timestamp")
    assert build_date_dim(wild, "t").count() == (date(2900, 1, 1) - date(1700, 1, 1)).days + 1


def test_yearly_kpis(fact, days):
    got = rows(kpis.kpi_yearly(fact, days))
    # An item without an id is revenue but not an item.
    assert got == [
        (2019, Decimal("10.09"), 1, Decimal("10.09"), Decimal("3.36"), Decimal("10.00")),
        (2021, Decimal("8.00"), 2, Decimal("4.00"), Decimal("8.00"), Decimal("7.00")),
    ]


def test_dedup_takes_the_largest_version_of_an_item(fact, days):
    got = rows(kpis.kpi_yearly_dedup(fact, days))
    assert got[0] == (2019, Decimal("10.05"), 1, Decimal("10.05"), Decimal("5.03"), Decimal("10.00"))


def test_rollup_gives_the_same_numbers(fact, days):
    rollup = kpis.order_rollup(fact, ["order_id", "order_date", "delivery_status"])
    for mart in (kpis.kpi_yearly, kpis.kpi_monthly, kpis.kpi_daily, kpis.kpi_dayname):
        assert rows(mart(rollup, days)) == rows(mart(fact, days))


def test_keyed_and_dated_facts_agree(fact, days):
    keyed = fact.withColumn("order_date_dim_key", date_key("order_date")).drop("order_date")
    assert rows(kpis.kpi_monthly(keyed, days)) == rows(kpis.kpi_monthly(fact, days))


def test_by_restaurant_keeps_statuses_apart(spark, fact, days):
    names = spark.createDataFrame([("r", "Spice")], "hk string, name string")
    placed = fact.withColumn("restaurant_dim_key", F.lit("r"))
    got = rows(kpis.kpi_monthly_by_restaurant(placed, days, names).select("year", "month", "delivery_status", "total_orders"))
    assert got == [(2019, 12, "Delivered", 1), (2021, 1, "Delivered", 1), (2021, 2, "Canceled", 1), (2021, 2, "Delivered", 1)]
    only = kpis.kpi_monthly_by_restaurant(placed, days, names, status="Canceled")
    assert rows(only.select("total_revenue")) == [(Decimal("99.00"),)]


def test_year_over_year_leaves_a_gap_empty(fact, days):
    got = {r["year"]: r["total_revenue_diff"] for r in dashboard.year_over_year(kpis.kpi_yearly(fact, days)).collect()}
    assert got == {2019: None, 2021: None}
    shifted = kpis.kpi_yearly(fact, days).withColumn("year", F.when(F.col("year") == 2021, 2020).otherwise(F.col("year")))
    got = {r["year"]: r["total_revenue_diff"] for r in dashboard.year_over_year(shifted).collect()}
    assert got == {2019: None, 2020: Decimal("-2.09")}


def test_top_restaurants_break_ties_by_name(spark):
    mart = spark.createDataFrame(
        [(2020, 1, "Delivered", n, Decimal("5.00"), 1, Decimal("5.00"), Decimal("5.00"), Decimal("5.00")) for n in "cab"],
        "year int, month int, delivery_status string, restaurant_name string, total_revenue decimal(10,2),"
        " total_orders long, avg_revenue_per_order decimal(10,2), avg_revenue_per_item decimal(10,2), max_order_value decimal(10,2)",
    )
    assert [r["restaurant_name"] for r in dashboard.top_restaurants(mart, 2020, 1, 2).collect()] == ["a", "b"]


def test_marts_scan_only_what_they_need(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    fact.withColumn("estimated_time", F.lit("x")).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = kpis.kpi_yearly(stored, build_date_dim(stored, "order_date"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(delivery_status,Delivered)" in plan
    assert "estimated_time" not in plan


def star(spark, orders):
    """Two items, an order as given, and one version of everything."""
    start = datetime(2000, 1, 1)

    def dim(key, *more):
        names = [key, *[n for n, _ in more], "hk", "eff_start", "eff_end", "is_current"]
        values = [(1, *[v for _, v in more], f"{key}-1", start, None, True)]
        types = ["long"] * (1 + len(more)) + ["string", "timestamp", "timestamp", "boolean"]
        return spark.createDataFrame(values, ", ".join(f"{n} {t}" for n, t in zip(names, types)))

    dims = {
        "customer": dim("customer_id"), "customer_address": dim("address_id"), "restaurant": dim("restaurant_id", ("location_id_fk", 1)),
        "location": dim("location_id"), "menu": dim("menu_id"), "delivery_agent": dim("delivery_agent_id"),
    }
    item = "order_item_id long, order_id_fk long, menu_id_fk long, quantity decimal(10,2), price decimal(10,2), subtotal decimal(10,2)"
    one = Decimal("1.00")
    items = spark.createDataFrame([(11, 1, 1, one, one, one), (12, 1, 1, one, one, one)], item)
    orders = spark.createDataFrame(
        [(1, 1, 1, at) for at in orders], "order_id long, customer_id_fk long, restaurant_id_fk long, order_date timestamp"
    )
    deliveries = spark.createDataFrame(
        [(1, 1, 1, "Delivered", "now")],
        "order_id_fk long, delivery_agent_id_fk long, customer_address_id_fk long, delivery_status string, estimated_time string",
    )
    return items, orders, deliveries, dims


def test_as_of_order_gives_an_item_per_row_of_its_order(spark):
    at, later = datetime(2020, 1, 1, 8), datetime(2020, 1, 1, 9)
    made = build_fact(*star(spark, [at, at, later, None]), as_of=ORDER_TIME)
    assert rows(made.groupBy("order_item_id").count()) == [(11, 3), (12, 3)]
    # Items carry their order's time to the menu, and nothing else that their order knows.
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    carried = [line for line in plan.splitlines() if "menu_id_fk" in line and "_row" in line]
    assert carried == [] or not any("customer_dim_key" in line for line in carried)


def test_fact_carries_no_key_that_is_not_selected(spark):
    made = build_fact(*star(spark, [datetime(2020, 1, 1)])).select("order_item_id", "menu_dim_key")
    assert rows(made) == [(11, "menu_id-1"), (12, "menu_id-1")]
    top = made._jdf.queryExecution().optimizedPlan()
    joins = [line for line in top.toString().splitlines() if "Project" in line and "order_id" in line]
    assert joins and not any(k in line for line in joins for k in DIMENSION_KEYS if k != "menu_dim_key")


def test_upsert_of_rows_that_lie_by_order_shuffles_nothing(spark):
    old = spark.createDataFrame([(i, i // 4, "a") for i in range(40)], "item long, order_no long, v string").repartition("order_no")
    new = old.withColumn("v", F.lit("b")).repartition("order_no")
    made = upsert(old, new, ["item", "order_no"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert rows(made) == sorted([(i, i // 4, "b") for i in range(40)], key=repr)


def test_a_day_of_changes_shuffles_an_old_row_of_the_fact_once(spark, tmp_path, monkeypatch):
    from __spark_entry__ import queries
    from layercake.sources.tables import VersionedTable

    plans, replace = {}, VersionedTable._replace

    def noted(self, op, rows, touched, batch_id, sources, rewritten=(), lying=None):
        if "_fact" in self.path:
            plans[self.version()] = [None if df is None else df._jdf.queryExecution().optimizedPlan().toString() for df in (rows, lying)]
        return replace(self, op, rows, touched, batch_id, sources, rewritten, lying)

    monkeypatch.setattr(VersionedTable, "_replace", noted)
    made = queries()["star_fact_reassigned"](spark, "/root/testdata/sf0.001")
    assert made.count() == made.select("order_item_id", "order_id").distinct().count() > 0
    (first, first_lying), (rest, lying) = plans[0], plans[1]
    assert first is None and "RepartitionByExpression" not in first_lying
    assert rest is None and lying.count("RepartitionByExpression") == 2
    assert "LeftAnti" not in lying and "LeftSemi" not in lying
