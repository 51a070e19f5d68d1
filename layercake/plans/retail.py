"""Retail order tables (orders, lineitem, customer, supplier, part) in the terms of this library.

``order_item_fact`` presents them as the fact directly. ``stage_rows`` writes them out as the text rows
that files of each entity would deliver, faults included, so the whole chain can run on them.
Supplier stands for restaurant, its location and delivery agent; part for menu item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layercake.plans.kpis import order_rollup
from layercake.registry import ENTITIES, Entity

# Order status -> delivery status, and the order status that means delivered.
DONE = "F"
STATUSES = {"F": "Delivered", "O": "Pending", "P": "Processing"}

# Places the derived rows are spread over.
CITIES = ["Mumbai", "Delhi", "Jaipur", "Chennai", "Kochi", "Shimla", "Patna", "Imphal"]
STATES = [
    "Maharashtra", "Delhi", "Rajasthan", "Tamil Nadu", "Kerala", "Himachal Pradesh", "Bihar", "Manipur",
]

LOADED_AT = "2025-01-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(value: str | Column) -> Column:
    """Exact before any sum, so that sums do not depend on the order of the rows."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        item_id().alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("menu_dim_key"),
        F.col("l_suppkey").alias("restaurant_dim_key"),
        money("l_extendedprice").alias("subtotal"),
    )


def order_headers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        # As stored, so that a filter on it reaches the scan.
        F.col("o_orderstatus").alias("delivery_status"),
        F.col("o_custkey").alias("customer_address_dim_key"),
    )


def order_item_fact(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item."""
    return items(spark, folder).join(order_headers(spark, folder), "order_id")


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The fact rolled up to orders before the join: one row per order meets one order header, and line
    items are shuffled once, combined."""
    return order_rollup(items(spark, folder), ["order_id"]).join(order_headers(spark, folder), "order_id")


def item_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def delivery_status() -> Column:
    status = F.col("o_orderstatus")
    value = F.lit(None).cast("string")
    for code, name in STATUSES.items():
        value = F.when(status == code, name).otherwise(value)
    return value


def stage_rows(spark: SparkSession, folder: str, entity: Entity) -> DataFrame:
    """All-text stage rows of an entity with audit columns."""
    source, columns = _SOURCES[entity.name]
    text = columns()
    rows = table(spark, folder, source)
    if entity.name in ("menu", "orders", "delivery"):
        # Spread over all restaurants and agents, numbered from 0.
        suppliers = table(spark, folder, "supplier").agg(F.count(F.lit(1)))
        rows = rows.withColumn("_outlets", suppliers.scalar())
    return rows.select(
        *[text[h].cast("string").alias(h) for h in entity.headers],
        F.lit(f"{entity.name}.csv").alias("_stg_file_name"),
        F.lit(LOADED_AT).cast("timestamp").alias("_stg_file_load_ts"),
        F.lit("0").alias("_stg_file_md5"),
        F.lit(LOADED_AT).cast("timestamp").alias("_copy_data_ts"),
    )


def stage_rows_of(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: stage_rows(spark, folder, e) for n, e in ENTITIES.items()}


def _pick(values: list[str], key: str) -> Column:
    names = F.array(*[F.lit(v) for v in values])
    return F.element_at(names, (F.pmod(F.col(key), F.lit(len(values))) + 1).cast("int"))


def _minutes_after(start: str, key: str, step: int) -> Column:
    """A moment that depends on the key, within about two years."""
    offset = F.pmod(F.col(key) * step, F.lit(1_000_000))
    return F.timestamp_add("MINUTE", offset.cast("int"), F.lit(start).cast("timestamp"))


def _us_minute(moment: Column) -> Column:
    return F.date_format(moment, "M/d/yyyy H:mm")


def _us_date(moment: Column) -> Column:
    return F.date_format(moment, "M/d/yyyy")


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def _location() -> dict[str, Column]:
    key = "s_suppkey"
    return {
        "locationid": F.col(key),
        "city": _pick(CITIES, key),
        "state": _pick(STATES, key),
        "zipcode": F.lpad(F.col(key).cast("string"), 6, "1"),
        "activeflag": F.when(F.col(key) % 3 == 0, "No").otherwise("Yes"),
        "createddate": _us_minute(_minutes_after("2021-05-09 04:44:00", key, 997)),
        "modifieddate": F.when(F.col(key) % 5 != 0, _iso(_minutes_after("2023-01-01 00:00:00", key, 31))),
    }


def _restaurant() -> dict[str, Column]:
    key = "s_suppkey"
    return {
        "restaurantid": F.col(key),
        "name": F.col("s_name"),
        "cuisinetype": F.lit("Indian, Thai"),
        "pricing_for_2": money("s_acctbal"),
        "restaurant_phone": F.concat(F.lit("9"), F.lpad(F.col(key).cast("string"), 9, "0")),
        "operatinghours": F.lit("09:00 AM - 22:00 PM"),
        "locationid": F.col(key),
        "activeflag": F.lit("Yes"),
        "openstatus": F.when(F.col(key) % 4 == 0, "Closed").otherwise("Open"),
        "locality": F.concat(F.lit("Quarter "), F.col("s_nationkey").cast("string")),
        "restaurant_address": F.concat_ws(", ", F.col(key).cast("string"), _pick(CITIES, key)),
        # Seven decimals, so that reading rounds; every eleventh is out of range.
        "latitude": F.when(F.col(key) % 11 == 10, "123456.5").otherwise(
            F.concat((F.col(key) % 80).cast("string"), F.lit(".1234567"))
        ),
        "longitude": F.concat((F.col(key) % 170).cast("string"), F.lit(".7654321")),
        "createddate": _us_date(_minutes_after("2019-03-15 00:00:00", key, 1440)),
        "modifieddate": _us_minute(_minutes_after("2020-06-20 10:30:00", key, 61)),
    }


def _customer() -> dict[str, Column]:
    key = "c_custkey"
    born = F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(F.col(key) * 37, F.lit(15000)).cast("int"))
    preferences = F.concat(
        F.lit('{"FoodPreference": "'), F.col("c_mktsegment"), F.lit('", "CuisineTypes": ["Thai", "Nation '),
        F.col("c_nationkey").cast("string"), F.lit('"]}'),
    )
    return {
        "customerid": F.col(key),
        "name": F.translate("c_name", "#", " "),
        "mobile": F.concat(F.lit("8"), F.lpad(F.col(key).cast("string"), 9, "0")),
        "email": F.concat(F.lit("c"), F.col(key).cast("string"), F.lit("@example.com")),
        "loginbyusing": F.lit("GMail_Account"),
        "gender": F.when(F.col(key) % 2 == 0, "Female").otherwise("Male"),
        "dob": F.when(F.col(key) % 2 == 0, born.cast("string")).otherwise(F.date_format(born, "M/d/yyyy")),
        "anniversary": F.when(F.col(key) % 7 == 0, "unknown").otherwise(F.lit("6/18/2015")),
        "preferences": F.when(F.col(key) % 10 == 3, "not json").otherwise(preferences),
        "createddate": _iso(_minutes_after("2019-01-15 10:12:00", key, 13)),
        "modifieddate": F.date_format(_minutes_after("2020-02-20 12:15:00", key, 17), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    }


def _customer_address() -> dict[str, Column]:
    key = "c_custkey"
    return {
        "addressid": F.col(key),
        "customerid": F.col(key),
        "flatno": F.col(key) % 100,
        "houseno": F.col(key) % 50,
        "floor": F.col(key) % 9,
        "building": F.lit("Mehta Towers"),
        "landmark": F.when(F.col(key) % 6 != 0, "Near Market"),
        "locality": F.concat(F.lit("Quarter "), F.col("c_nationkey").cast("string")),
        "city": _pick(CITIES, key),
        "state": _pick(STATES, key),
        "pincode": F.lpad(F.col(key).cast("string"), 6, "1"),
        "coordinates": F.lit("28.56789,77.2"),
        "primaryflag": F.when(F.col(key) % 8 == 0, "No").otherwise("Yes"),
        "addresstype": F.lit("Home"),
        "createddate": _iso(_minutes_after("2019-01-15 10:15:00", key, 11)),
        "modifieddate": _iso(_minutes_after("2020-02-20 12:20:00", key, 19)),
    }


def _menu() -> dict[str, Column]:
    key = "p_partkey"
    return {
        "menuid": F.col(key),
        "restaurantid": F.col(key) % F.col("_outlets"),
        "itemname": F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")),
        "description": F.concat_ws(" ", "p_brand", "p_name"),
        "price": money("p_retailprice"),
        "category": F.concat(F.col("p_type"), F.lit(" ")),
        "availability": _pick(["TRUE", "True", "false", "sometimes"], key),
        "itemtype": F.lit("Veg"),
        "createddate": _iso(_minutes_after("2019-03-15 10:00:00", key, 7)),
        "modifieddate": F.lit("12:00:00"),
    }


def _delivery_agent() -> dict[str, Column]:
    key = "s_suppkey"
    rating = F.concat((F.col(key) % 5).cast("string"), F.lit(".25"))
    return {
        "deliveryagentid": F.col(key),
        "name": F.concat(F.lit("Agent "), F.col(key).cast("string")),
        "phone": F.concat(F.lit("7"), F.lpad(F.col(key).cast("string"), 9, "0")),
        "vehicletype": F.when(F.col(key) % 2 == 0, "Bicycle").otherwise("Motorbike"),
        "locationid": F.when(F.col(key) % 9 == 8, "4.2").otherwise(F.col(key).cast("string")),
        "status": F.lit("Active"),
        "gender": F.when(F.col(key) % 2 == 0, "Female").otherwise("Male"),
        "rating": F.when(F.col(key) % 6 == 5, "n/a").otherwise(rating),
        "createddate": _iso(_minutes_after("2019-03-15 10:00:00", key, 23)),
        "modifieddate": _iso(_minutes_after("2020-06-20 12:00:00", key, 29)),
    }


def _orders() -> dict[str, Column]:
    key = "o_orderkey"
    return {
        "orderid": F.col(key),
        "customerid": F.col("o_custkey"),
        "restaurantid": F.col(key) % F.col("_outlets"),
        "orderdate": F.when(F.col(key) % 2 == 0, _us_date(F.col("o_orderdate"))).otherwise(_iso(F.col("o_orderdate"))),
        "totalamount": money("o_totalprice"),
        "status": delivery_status(),
        "paymentmethod": F.when(F.col(key) % 3 == 0, "Cash").otherwise("UPI"),
        "createddate": F.lit("10:00:00"),
        "modifieddate": _iso(F.col("o_orderdate")),
    }


def _order_item() -> dict[str, Column]:
    return {
        "orderitemid": item_id(),
        "orderid": F.col("l_orderkey"),
        "menuid": F.col("l_partkey"),
        "quantity": F.col("l_quantity").cast("decimal(10,1)"),
        "price": money("l_extendedprice"),
        "subtotal": money("l_extendedprice"),
        "createddate": F.lit("10:00:00"),
        "modifieddate": _iso(F.col("l_shipdate")),
    }


def _delivery() -> dict[str, Column]:
    key = "o_orderkey"
    return {
        "deliveryid": F.col(key),
        "orderid": F.col(key),
        "deliveryagentid": F.col(key) % F.col("_outlets"),
        "deliverystatus": delivery_status(),
        "estimatedtime": F.concat((F.col(key) % 60).cast("string"), F.lit(" minutes")),
        "addressid": F.col("o_custkey"),
        "deliverydate": _us_date(F.col("o_orderdate")),
        "createddate": F.lit("10:00:00"),
        "modifieddate": F.lit("12:00:00"),
    }


_SOURCES = {
    "location": ("supplier", _location),
    "restaurant": ("supplier", _restaurant),
    "customer": ("customer", _customer),
    "customer_address": ("customer", _customer_address),
    "menu": ("part", _menu),
    "delivery_agent": ("supplier", _delivery_agent),
    "orders": ("orders", _orders),
    "order_item": ("lineitem", _order_item),
    "delivery": ("orders", _delivery),
}
