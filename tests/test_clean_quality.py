from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from layercake.operators.clean import clean, clean_schema, dimension_schema, stage_schema
from layercake.operators.quality import (
    castable, check_foreign_keys, check_unique, mask, max_length, not_null, split_stage, split_valid,
)
from layercake.registry import AUDIT, DIMENSIONS, ENTITIES


def stage(spark, name, *data):
    """Stage rows from raw texts; missing ones at the end are NULL."""
    entity = ENTITIES[name]
    audit = ("f.csv", datetime(2025, 1, 1), "0", datetime(2025, 1, 1))
    full = [(*r, *[None] * (len(entity.headers) - len(r)), *audit) for r in data]
    return spark.createDataFrame(full, stage_schema(entity))


def cleaned(spark, name, *data):
    return clean(ENTITIES[name], stage(spark, name, *data)).drop(*AUDIT)


def test_location_codes_flags_and_tiers(spark):
    got = cleaned(
        spark, "location",
        ("1", "Delhi", "Delhi", "110001", "Yes", "1/5/2023 4:44"),
        ("2", "Mumbai", "Maharashtra", "400001", "No", "2024-11-02 22:06:18", "2024-11-05 22:06:18"),
        ("3", "Delhi", "New Delhi", "1", "Yes", "1/5/2023"),
        ("4", "Nowhere", "Atlantis", "1", "Yes", "10:00:00"),
        ("5", "Jaipur", "Rajasthan", "1", "Yes", "1/5/2023"),
    )
    shown = rows(got.select("location_id", "state", "state_code", "is_union_territory", "capital_city_flag", "city_tier"))
    assert shown == [
        (1, "New Delhi", "DL", True, True, "Tier-1"),
        (2, "Maharashtra", "MH", False, True, "Tier-1"),
        (3, "New Delhi", None, False, True, "Tier-1"),
        (4, "Atlantis", None, False, False, "Tier-3"),
        (5, "Rajasthan", "RJ", False, False, "Tier-1"),
    ]
    times = rows(got.select("location_id", "created_ts", "modified_ts"))
    assert times[0] == (1, datetime(2023, 1, 5, 4, 44), None)
    assert times[1] == (2, datetime(2024, 11, 2, 22, 6, 18), datetime(2024, 11, 5, 22, 6, 18))
    assert times[3] == (4, None, None)


def test_own_lookup_tables(spark):
    rows_in = stage(spark, "location", ("1", "Jaipur", "Rajasthan", "1", "Yes", "1/5/2023"))
    got = clean(ENTITIES["location"], rows_in, state_codes={"Rajasthan": "R"}, city_tiers={"Jaipur": "Tier-2"})
    assert rows(got.select("state_code", "city_tier")) == [("R", "Tier-2")]


def test_customer_json_names_and_dates(spark):
    got = cleaned(
        spark, "customer",
        ("1", "Ada King", "9", "a@b", "x", "F", "3/12/1985", "2015-06-18", '{"FoodPreference": "Veg", "CuisineTypes": ["Thai","Indian"]}', "2019-01-15T10:12:03", None),
        ("2", "Ada", "9", "a@b", "x", "F", "bad", None, "not json"),
        ("3", "A B C", "9", "a@b", "x", "F", None, None, '{"FoodPreference": "Veg"}'),
    )
    assert rows(got.select("customer_id", "first_name", "last_name", "dob", "anniversary", "preferences", "cuisine_types")) == [
        (1, "Ada", "King", date(1985, 3, 12), date(2015, 6, 18), "Veg", "Thai, Indian"),
        (2, "Ada", "", None, None, None, None),
        (3, "A", "B", None, None, "Veg", None),
    ]


def test_restaurant_numbers_round_and_overflow_to_null(spark):
    got = cleaned(spark, "restaurant", ("1", "R", "c", "99.999", "9", "h", "4.2", "Yes", "Open", "l", "a", "28.45797541", "1234.5"))
    assert rows(got.select(F.col("pricing_for_two").cast("string"), "location_id_fk", F.col("latitude").cast("string"), "longitude")) == [
        ("100.00", None, "28.457975", None)
    ]


def test_modified_time_falls_back_to_nothing(spark):
    got = cleaned(spark, "restaurant", ("1", "R", *[None] * 11, "3/15/2019", "6/20/2020 10:30"), ("2", "R", *[None] * 11, "3/15/2019", None))
    assert rows(got.select("restaurant_id", "modified_dt")) == [(1, datetime(2020, 6, 20, 10, 30)), (2, None)]


def test_address_state_and_pincode_are_not_swapped(spark):
    got = cleaned(spark, "customer_address", ("1", "1", "2", "3", "4", "b", "l", "lo", "City", "State", "110024"))
    assert rows(got.select("city", "state", "pincode")) == [("City", "State", "110024")]


def test_small_item_ids_stay_unless_asked(spark):
    data = stage(spark, "order_item", ("1", "1", "1"), ("40", "1", "1"), ("x", "1", "1"))
    assert clean(ENTITIES["order_item"], data).count() == 2
    assert rows(clean(ENTITIES["order_item"], data, min_id=40).select("order_item_id")) == [(40,)]


def test_abort_names_the_bad_text(spark):
    data = stage(spark, "menu", ("1", "2", "n", "d", "cheap"))
    with pytest.raises(Exception, match="cheap"):
        clean(ENTITIES["menu"], data, on_error="abort").collect()


def test_quarantine_by_entity_rules(spark):
    data = stage(
        spark, "location",
        ("1", "Patna", "Bihar", "1", "Yes", "1/5/2023"),
        ("junk", "2", "Mumbai", "Maharashtra", "400001", "Yes"),
        ("11|Pune|Maharashtra",),
        (None, None, None),
        ("12", "Patna", "Bihar", "12345678901", "Yes", "1/5/2023"),
    )
    good, bad = split_stage(ENTITIES["location"], data)
    assert rows(good.select("locationid")) == [("1",)]
    reasons = {r["locationid"]: r["_reasons"] for r in bad.collect()}
    assert "location_id missing or unreadable" in reasons["junk"]
    assert "location_id missing or unreadable" in reasons["11|Pune|Maharashtra"]
    assert reasons["12"] == ["zip_code longer than 10"]
    assert len(reasons) == 3


def test_split_valid_rules(spark):
    df = spark.createDataFrame([("1", "abc"), (None, "abcd"), ("x", None)], "a string, b string")
    good, bad = split_valid(df, [not_null("a"), max_length("b", 3), castable("a", "bigint")])
    assert rows(good) == [("1", "abc")]
    assert rows(bad.select("_reasons")) == [(["a missing", "b longer than 3"],), (["a not bigint"],)]


def test_unique_and_foreign_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a")], "k long, s string")
    assert rows(check_unique(fact, ["k"])) == [(1, 2)]
    dims = {
        "k": (spark.createDataFrame([(1,)], "id long"), "id"),
        "s": (spark.createDataFrame([("a",), ("b",)], "id string"), "id"),
    }
    assert rows(check_foreign_keys(fact, dims)) == [("k", 4, 2), ("s", 4, 1)]


def test_foreign_keys_read_the_fact_once(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b")).write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    dims = {c: (spark.range(5), "id") for c in ("a", "b")}
    plan = check_foreign_keys(fact, dims)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_mask_hides_values_not_nulls(spark):
    df = spark.createDataFrame([(1, "9", date(2000, 1, 1)), (2, None, None)], "id int, mobile string, dob date")
    got = mask(df, {"mobile": "SENSITIVE", "dob": "PII", "email": "EMAIL"})
    assert rows(got) == [(1, "**Phone**", "**PII**"), (2, None, None)]


def test_schemas_match_the_rows(spark):
    for name, entity in ENTITIES.items():
        got = clean(entity, stage(spark, name))
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in clean_schema(entity)]
        assert set(entity.keys) <= set(entity.columns) and set(entity.bucket_by) <= set(entity.keys)
    for name in DIMENSIONS:
        assert dimension_schema(ENTITIES[name]).names[-5:] == ["hk", "attr_hash", "eff_start", "eff_end", "is_current"]


def test_mask_refuses_a_tag_it_does_not_know(spark):
    df = spark.createDataFrame([("1",)], "price string")
    with pytest.raises(ValueError, match="PRICE"):
        mask(df, {"price": "PRICE"})
