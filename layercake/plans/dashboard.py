"""The questions a revenue dashboard asks of the KPI marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layercake.functions.parse import month_label

KPIS = ["total_revenue", "total_orders", "avg_revenue_per_order", "avg_revenue_per_item", "max_order_value"]


def yearly(kpi_yearly: DataFrame) -> DataFrame:
    return kpi_yearly.select("year", *KPIS).orderBy("year")


def monthly_revenue(kpi_monthly: DataFrame, year: int) -> DataFrame:
    """Whole-number revenue per month of a year."""
    found = kpi_monthly.filter(F.col("year") == F.lit(year))
    return found.select("month", F.col("total_revenue").cast("decimal(20,0)").alias("total_revenue")).orderBy("month")


def months(by_restaurant: DataFrame, year: int) -> DataFrame:
    """Months of a year that have data."""
    return by_restaurant.filter(F.col("year") == F.lit(year)).select("month").distinct().orderBy("month")


def top_restaurants(by_restaurant: DataFrame, year: int, month: int, n: int = 10) -> DataFrame:
    """Largest revenues of a month. A restaurant counts once per delivery status."""
    found = by_restaurant.filter((F.col("year") == F.lit(year)) & (F.col("month") == F.lit(month)))
    order = [F.desc("total_revenue"), "restaurant_name", "delivery_status"]
    return found.select("restaurant_name", "delivery_status", *KPIS).orderBy(*order).limit(n)


def year_over_year(kpi_yearly: DataFrame) -> DataFrame:
    """Every KPI with its difference to the year before; NULL if that year has no data.

    Each year is sent to itself and to the next one, so the mart is computed once and not joined to
    itself.
    """
    both = kpi_yearly.select(
        F.explode(F.array(F.lit(0), F.lit(1))).alias("later"), "year", *KPIS
    ).withColumn("year", F.col("year") + F.col("later"))
    own, before = F.col("later") == 0, F.col("later") == 1
    paired = both.groupBy("year").agg(
        F.max(F.when(own, F.lit(1))).alias("has_own"),
        *[F.max(F.when(own, F.col(k))).alias(k) for k in KPIS],
        *[F.max(F.when(before, F.col(k))).alias(f"{k}_before") for k in KPIS],
    )
    return paired.filter("has_own = 1").select(
        "year", *KPIS, *[(F.col(k) - F.col(f"{k}_before")).alias(f"{k}_diff") for k in KPIS]
    )


def totals(kpi_yearly: DataFrame) -> DataFrame:
    return kpi_yearly.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.max("max_order_value").alias("max_order_value"),
    )


def latest_period(kpi_monthly: DataFrame) -> DataFrame:
    """The last year with data and its last month."""
    last = F.max(F.struct("year", "month")).alias("last")
    return kpi_monthly.agg(last).select("last.year", "last.month")


def month_labels(kpi_monthly: DataFrame, year: int) -> DataFrame:
    """Short month names in calendar order."""
    found = kpi_monthly.filter(F.col("year") == F.lit(year)).select("month").distinct()
    return found.select("month", month_label("month").alias("label")).orderBy("month")
