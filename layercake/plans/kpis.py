"""Revenue KPI marts over the fact.

Every mart takes the fact at item grain, or an ``order_rollup`` of it: both give the same numbers.
A rollup brings each order down to one row before any join, on the map side where its items lie
together, so a hot order costs one row per task. It pays where a mart groups by what an order
determines (dates, customer); by menu item or restaurant of an item, the fact itself is as small.

Facts carry ``order_date_dim_key`` (joined to ``date_dim_hk``) or a plain ``order_date`` (joined to
``calendar_date``). ``max_order_value`` is the largest item subtotal; that is its definition here.
Marts are unsorted: sort where they are shown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

DELIVERED = "Delivered"


def delivered(fact: DataFrame, done: str = DELIVERED) -> DataFrame:
    """Rows of delivered orders; ``done`` is the status that says so."""
    return fact.filter(F.col("delivery_status") == done)


def order_rollup(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Revenue, item count and largest subtotal per ``by``, which includes the order."""
    return items.groupBy(*by).agg(
        F.sum("subtotal").alias("revenue"),
        F.count("order_item_id").alias("items"),
        F.max("subtotal").alias("largest"),
    )


def dedup_items(fact: DataFrame) -> DataFrame:
    """One row per item: the largest subtotal among its versions."""
    return fact.groupBy("order_item_id", "order_id", _date_column(fact)).agg(F.max("subtotal").alias("subtotal"))


def kpi_aggs() -> list[Column]:
    """The five KPIs over rows with revenue, items, largest and order_id."""
    revenue, orders, items = F.sum("revenue"), F.count_distinct("order_id"), F.sum("items")
    return [
        revenue.alias("total_revenue"),
        orders.alias("total_orders"),
        F.round(F.try_divide(revenue, orders), 2).alias("avg_revenue_per_order"),
        F.round(F.try_divide(revenue, items), 2).alias("avg_revenue_per_item"),
        F.max("largest").alias("max_order_value"),
    ]


def kpis(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    """KPIs per group. Orders are counted exactly: Spark first shuffles by group and order, so a group
    that holds a third of all rows is counted by many tasks."""
    return _measures(fact).groupBy(*by).agg(*kpi_aggs())


def with_date(fact: DataFrame, date_dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The fact with calendar columns. Spark broadcasts the date dimension by its size."""
    key = _date_column(fact)
    other = "date_dim_hk" if key == "order_date_dim_key" else "calendar_date"
    days = date_dim.select(F.col(other).alias(key), *columns)
    return fact.join(days, key)


def kpi_yearly(fact: DataFrame, date_dim: DataFrame, done: str = DELIVERED) -> DataFrame:
    return kpis(with_date(delivered(fact, done), date_dim, ["year"]), ["year"])


def kpi_yearly_dedup(fact: DataFrame, date_dim: DataFrame, done: str = DELIVERED) -> DataFrame:
    """Yearly KPIs counting every item once. Needs the fact at item grain."""
    items = dedup_items(delivered(fact, done))
    # Here every row counts as an item, with or without an id.
    measured = items.select("*", F.col("subtotal").alias("revenue"), F.lit(1).alias("items"), F.col("subtotal").alias("largest"))
    return kpis(with_date(measured, date_dim, ["year"]), ["year"])


def kpi_monthly(fact: DataFrame, date_dim: DataFrame, done: str = DELIVERED) -> DataFrame:
    by = ["year", "month"]
    return kpis(with_date(delivered(fact, done), date_dim, by), by)


def kpi_daily(fact: DataFrame, date_dim: DataFrame, done: str = DELIVERED) -> DataFrame:
    found = kpis(
        with_date(delivered(fact, done), date_dim, ["year", "month", "day_of_the_month"]),
        ["year", "month", "day_of_the_month"],
    )
    return found.withColumnRenamed("day_of_the_month", "day")


def kpi_dayname(fact: DataFrame, date_dim: DataFrame) -> DataFrame:
    """By name of the weekday within each month, whatever the delivery status."""
    by = ["year", "month", "day_name"]
    return kpis(with_date(fact, date_dim, by), by)


def kpi_monthly_by_restaurant(
    fact: DataFrame, date_dim: DataFrame, restaurants: DataFrame, status: str | None = None
) -> DataFrame:
    """By month, delivery status and restaurant name. ``restaurants`` has ``hk`` and ``name``."""
    if status is not None:
        fact = fact.filter(F.col("delivery_status") == status)
    named = restaurants.select(F.col("hk").alias("restaurant_dim_key"), F.col("name").alias("restaurant_name"))
    dated = with_date(fact, date_dim, ["year", "month"]).join(named, "restaurant_dim_key")
    return kpis(dated, ["year", "month", "delivery_status", "restaurant_name"])


def kpi_by_city(fact: DataFrame, date_dim: DataFrame, addresses: DataFrame) -> DataFrame:
    """By city of the delivery address and year. ``addresses`` has ``hk`` and ``city``."""
    placed = addresses.select(F.col("hk").alias("customer_address_dim_key"), "city")
    return kpis(with_date(fact, date_dim, ["year"]).join(placed, "customer_address_dim_key"), ["city", "year"])


def kpi_by_category(fact: DataFrame, menus: DataFrame, done: str = DELIVERED) -> DataFrame:
    """Delivered orders and revenue by menu category. ``menus`` has ``hk`` and ``category``."""
    categories = menus.select(F.col("hk").alias("menu_dim_key"), "category")
    return (
        _measures(delivered(fact, done))
        .join(categories, "menu_dim_key")
        .groupBy("category")
        .agg(F.count_distinct("order_id").alias("order_count"), F.sum("revenue").alias("total_revenue"))
    )


def kpi_by_category_order_totals(fact: DataFrame, menus: DataFrame, done: str = DELIVERED) -> DataFrame:
    """The same by way of totals per order and menu item."""
    totals = _measures(delivered(fact, done)).groupBy("order_id", "menu_dim_key").agg(F.sum("revenue").alias("order_total"))
    categories = menus.select(F.col("hk").alias("menu_dim_key"), "category")
    return (
        totals.join(categories, "menu_dim_key")
        .groupBy("category")
        .agg(F.count_distinct("order_id").alias("order_count"), F.sum("order_total").alias("total_revenue"))
    )


def _measures(fact: DataFrame) -> DataFrame:
    if "revenue" in fact.columns:
        return fact
    return fact.select(
        "*",
        F.col("subtotal").alias("revenue"),
        F.col("order_item_id").isNotNull().cast("int").alias("items"),
        F.col("subtotal").alias("largest"),
    )


def _date_column(fact: DataFrame) -> str:
    return "order_date_dim_key" if "order_date_dim_key" in fact.columns else "order_date"
