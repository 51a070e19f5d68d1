"""Date dimension and the order item fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from layercake.functions.hashing import packed, row_hash, unpacked
from layercake.operators.merge import latest_per_key
from layercake.operators.scd2 import as_of as dim_as_of
from layercake.operators.scd2 import current
from layercake.operators.sequence import as_of_join
from layercake.registry import ENTITIES
from layercake.session import written
from layercake.sources.tables import PLACE

# What was loaded last counts, where a source keeps several rows of one order or item.
LOAD_ORDER = ["_copy_data_ts", "_stg_file_load_ts", "_stg_file_name"]

FACT_KEYS = ["order_item_id", "order_id"]
FACT_COLUMNS = [
    "order_item_id",
    "order_id",
    "customer_dim_key",
    "customer_address_dim_key",
    "restaurant_dim_key",
    "restaurant_location_dim_key",
    "menu_dim_key",
    "delivery_agent_dim_key",
    "order_date_dim_key",
    "quantity",
    "price",
    "subtotal",
    "delivery_status",
    "estimated_time",
]
# What an item may lack; an order's date has its key by itself.
DIMENSION_KEYS = [c for c in FACT_COLUMNS if c.endswith("_dim_key")]
ORDER_TIME = "order time"
FACT_SCHEMA = (
    "order_item_id long, order_id long, customer_dim_key string, customer_address_dim_key string,"
    " restaurant_dim_key string, restaurant_location_dim_key string, menu_dim_key string,"
    " delivery_agent_dim_key string, order_date_dim_key string, quantity decimal(10,2), price decimal(10,2),"
    " subtotal decimal(10,2), delivery_status string, estimated_time string"
)


DATE_SCHEMA = (
    "date_dim_hk string, calendar_date date, year int, quarter int, month int, week int, day_of_year int,"
    " day_of_week int, day_of_the_month int, day_name string"
)


def build_date_dim(orders: DataFrame, order_date: str, until: date | Column | None = None) -> DataFrame:
    """One row per day from the first order to ``until`` (default: the last order), both included."""
    end = F.max(F.to_date(order_date)) if until is None else _date(until)
    bounds = orders.agg(F.min(F.to_date(order_date)).alias("start"), end.alias("end"))
    forward = F.col("start") <= F.col("end")
    day = F.col("calendar_date")
    return (
        bounds.filter(forward)
        .select(F.explode(F.sequence("start", "end")).alias("calendar_date"))
        .select(
            date_key("calendar_date").alias("date_dim_hk"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.weekofyear(day).alias("week"),
            F.dayofyear(day).alias("day_of_year"),
            F.dayofweek(day).alias("day_of_week"),
            F.dayofmonth(day).alias("day_of_the_month"),
            F.dayname(day).alias("day_name"),
        )
    )


def date_key(day: str) -> Column:
    return row_hash([day])


def build_fact(
    items: DataFrame,
    orders: DataFrame,
    deliveries: DataFrame,
    dims: Mapping[str, DataFrame],
    date_dim: DataFrame | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Order items with the keys of their dimension versions; items that lack one of them are left out.

    ``dims`` holds the six dimensions by entity name. Without ``as_of`` the open versions are taken,
    with it those open at that time, or, for ``ORDER_TIME``, those valid when their order was placed. The address is
    the one delivered to. Of several deliveries of an order,
    or several rows of an item in an order, the one loaded last counts, so an item is one row of the fact.

    Everything known per order is joined per order first, so the item table, the largest by far, is
    shuffled once for its order and once for its menu. Spark broadcasts dimensions by their size, and
    splits hot keys of the others at run time.
    """
    # Spark makes these left joins inner ones, as no key may be missing. Asked for one by one, keys that are not
    # selected later are not carried along.
    whole = F.expr(" AND ".join(f"{c} IS NOT NULL" for c in DIMENSION_KEYS))
    return unpack_keys(_resolved(items, orders, deliveries, dims, date_dim, as_of).filter(whole).select(*FACT_COLUMNS))


def resolve(
    items: DataFrame,
    orders: DataFrame,
    deliveries: DataFrame,
    dims: Mapping[str, DataFrame],
    date_dim: DataFrame | None = None,
    as_of: str | None = None,
    near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """As ``build_fact``, with every item of a delivered order; ``_missing`` lists the dimension rows (dimension, key) that
    it waits for. An item without an order, a delivery or a date waits for no dimension: these change with its order.

    ``near`` lays items and orders out before they meet; see ``VersionedTable.near``. Dimensions that are stored may come
    with ``packed_keys``, which are half as large to shuffle; the fact has keys as text again.
    """
    return unpack_keys(_resolved(items, orders, deliveries, dims, date_dim, as_of, near))


def _resolved(
    items: DataFrame,
    orders: DataFrame,
    deliveries: DataFrame,
    dims: Mapping[str, DataFrame],
    date_dim: DataFrame | None = None,
    as_of: str | None = None,
    near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    pick = _AsOfOrder(dims) if as_of == ORDER_TIME else _Open(dims, as_of, near)

    def newest(rows: DataFrame, *keys: str) -> DataFrame:
        return latest_per_key(rows, keys, [c for c in LOAD_ORDER if c in rows.columns])

    header = orders.select(
        "order_id", "customer_id_fk", "restaurant_id_fk", "order_date", F.to_date("order_date").alias("calendar_date")
    )
    if date_dim is None:  # one that covers all orders has every day of theirs
        day = date_key("calendar_date") if dims["customer"].schema["hk"].dataType == T.StringType() else F.unhex(date_key("calendar_date"))
        header = header.withColumn("order_date_dim_key", F.when(F.col("calendar_date").isNotNull(), day))
    else:
        days = date_dim.select("calendar_date", F.col("date_dim_hk").alias("order_date_dim_key"))
        header = header.join(days, "calendar_date")
    header = header.join(
        newest(deliveries, "order_id_fk").select(
            F.col("order_id_fk").alias("order_id"),
            "delivery_agent_id_fk",
            "customer_address_id_fk",
            "delivery_status",
            "estimated_time",
        ),
        "order_id",
    )
    header = pick.add(header, "customer", "customer_id", "customer_id_fk", "customer_dim_key")
    header = pick.add(header, "customer_address", "address_id", "customer_address_id_fk", "customer_address_dim_key")
    header = pick.place(header)
    header = pick.add(header, "delivery_agent", "delivery_agent_id", "delivery_agent_id_fk", "delivery_agent_dim_key")
    lines = newest(items, "order_item_id", "order_id_fk").select(
        "order_item_id", F.col("order_id_fk").alias("order_id"), "menu_id_fk", "quantity", "price", "subtotal"
    )
    found = pick.menu(lines, header).withColumn("_missing", _missing())
    return found.select(*FACT_COLUMNS, "_missing")


def pack_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with keys of dimensions as bytes, to be shuffled."""
    return _keys_as(rows, packed, "string")


def unpack_keys(rows: DataFrame) -> DataFrame:
    return _keys_as(rows, unpacked, "binary")


def _keys_as(rows: DataFrame, form: Callable[[str], str], kind: str) -> DataFrame:
    return rows.selectExpr(*[f"{form(c)} AS {c}" if c in DIMENSION_KEYS and t == kind else f"`{c}`" for c, t in rows.dtypes])


class _Open:
    """Joins with the versions of one moment, or the open ones."""

    def __init__(self, dims: Mapping[str, DataFrame], as_of: str | None, near: Callable[[DataFrame], DataFrame] | None = None):
        self.dims, self.as_of, self.near = dims, as_of, near

    def rows(self, name: str) -> DataFrame:
        return current(self.dims[name]) if self.as_of is None else dim_as_of(self.dims[name], F.lit(self.as_of))

    def add(self, rows: DataFrame, name: str, key: str, fk: str, hk: str) -> DataFrame:
        return rows.join(_keyed(self.rows(name), key, fk, hk), fk, "left")

    def place(self, header: DataFrame) -> DataFrame:
        shops = _keyed(self.rows("restaurant"), "restaurant_id", "restaurant_id_fk", "restaurant_dim_key", "location_id_fk")
        place = _keyed(self.rows("location"), "location_id", "location_id_fk", "restaurant_location_dim_key")
        return header.join(shops.join(place, "location_id_fk", "left"), "restaurant_id_fk", "left")

    def menu(self, lines: DataFrame, header: DataFrame) -> DataFrame:
        found = self.add(lines, "menu", "menu_id", "menu_id_fk", "menu_dim_key")
        if self.near is None:
            return found.join(header, "order_id")
        return self.near(found).join(self.near(header), ["order_id", PLACE])


class _AsOfOrder:
    """Joins with the versions valid at each order's time."""

    def __init__(self, dims: Mapping[str, DataFrame]):
        self.dims = dims

    def add(self, rows: DataFrame, name: str, key: str, fk: str, hk: str, *more: str) -> DataFrame:
        versions = _keyed(self.dims[name], key, fk, hk, *more, "eff_start", "eff_end")
        # Each join looks for hot keys first: written, so that it does not run the joins before it again.
        return written(as_of_join(rows, versions, fk, "order_date", "eff_start", "eff_end", [hk, *more]), f"as-of-{name}")

    def place(self, header: DataFrame) -> DataFrame:
        header = self.add(header, "restaurant", "restaurant_id", "restaurant_id_fk", "restaurant_dim_key", "location_id_fk")
        return self.add(header, "location", "location_id", "location_id_fk", "restaurant_location_dim_key")

    def menu(self, lines: DataFrame, header: DataFrame) -> DataFrame:
        # Items only take their time along; what else an order knows comes last. An order of several times has an item
        # for each.
        times = header.select("order_id", "order_date").distinct()
        timed = written(lines.join(times, "order_id"), "as-of-lines")
        found = self.add(timed, "menu", "menu_id", "menu_id_fk", "menu_dim_key").withColumnRenamed("order_date", "_at")
        return found.join(header, (found["order_id"] == header["order_id"]) & found["_at"].eqNullSafe(header["order_date"])).drop(
            found["order_id"], "_at"
        )


def key_columns(name: str, dim: DataFrame) -> DataFrame:
    """Those columns of a dimension that the fact looks at."""
    more = ["location_id_fk"] if name == "restaurant" else []
    return dim.select(*ENTITIES[name].keys, *more, "hk", "eff_start", "eff_end", "is_current")


def packed_keys(stored: DataFrame, key: str = "hk") -> DataFrame:
    """A dimension with its key as bytes. Only for rows read from files: Catalyst would take the making of the hash apart
    once for each time that it is named here, which fills the driver's memory."""
    return stored.withColumn(key, F.expr(packed(key)))


def _missing() -> Column:
    """A restaurant without a location waits for the restaurant to change."""
    waits = {
        "customer": "customer_dim_key IS NULL THEN customer_id_fk",
        "customer_address": "customer_address_dim_key IS NULL THEN customer_address_id_fk",
        "restaurant": "restaurant_dim_key IS NULL OR location_id_fk IS NULL THEN restaurant_id_fk",
        "location": "restaurant_location_dim_key IS NULL THEN location_id_fk",
        "delivery_agent": "delivery_agent_dim_key IS NULL THEN delivery_agent_id_fk",
        "menu": "menu_dim_key IS NULL THEN menu_id_fk",
    }
    each = ", ".join(f"struct('{n}' AS dimension, CASE WHEN {w} END AS key)" for n, w in waits.items())
    return F.expr(f"filter(array({each}), m -> m.key IS NOT NULL)")


def _keyed(dim: DataFrame, key: str, fk: str, name: str, *more: str) -> DataFrame:
    return dim.select(F.col(key).alias(fk), F.col("hk").alias(name), *more)


def _date(value: date | Column) -> Column:
    """``until`` is the same for all rows, so any aggregate of it is that date."""
    return F.max(value if isinstance(value, Column) else F.lit(str(value)).cast("date"))
