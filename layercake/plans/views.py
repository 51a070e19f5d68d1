"""The consumption layer under the names its SQL users know."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from layercake.plans import kpis

# Names of the dimension views that differ from "<entity>_dim".
DIM_VIEWS = {"location": "restaurant_location_dim"}


def register(fact: DataFrame, date_dim: DataFrame, dims: Mapping[str, DataFrame]) -> list[str]:
    """Temporary views of the fact, the dimensions and the KPI marts. Returns their names.

    A view is a plan, not a result: SQL over it is optimized together with it.
    """
    views = {"order_item_fact": fact, "date_dim": date_dim}
    views |= {DIM_VIEWS.get(n, f"{n}_dim"): dim for n, dim in dims.items()}
    views |= {
        "vw_yearly_revenue_kpis": kpis.kpi_yearly(fact, date_dim),
        "vw_yearly_revenue_kpis2": kpis.kpi_yearly_dedup(fact, date_dim),
        "vw_monthly_revenue_kpis": kpis.kpi_monthly(fact, date_dim),
        "vw_daily_revenue_kpis": kpis.kpi_daily(fact, date_dim),
        "vw_day_revenue_kpis": kpis.kpi_dayname(fact, date_dim),
        "vw_monthly_revenue_by_restaurant": kpis.kpi_monthly_by_restaurant(fact, date_dim, dims["restaurant"]),
        "vv_revenue_by_state": kpis.kpi_by_city(fact, date_dim, dims["customer_address"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
