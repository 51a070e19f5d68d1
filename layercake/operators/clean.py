"""Stage rows (all text) to typed rows."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from layercake.functions.parse import json_field, name_part, spark_type, strict, typed
from layercake.registry import (
    AUDIT,
    CITY_TIERS,
    DEFAULT_TIER,
    PREFERENCES_JSON,
    STATE_CODES,
    UNION_TERRITORIES,
    Col,
    Entity,
)


def clean(
    entity: Entity,
    stage: DataFrame,
    on_error: str = "continue",
    min_id: int | None = None,
    state_codes: Mapping[str, str] = STATE_CODES,
    city_tiers: Mapping[str, str] = CITY_TIERS,
) -> DataFrame:
    """Clean columns plus the file audit columns, for rows whose key can be read.

    ``on_error='abort'`` fails on the first text that cannot be read; ``'continue'`` makes it NULL.
    ``min_id`` keeps rows whose first key column is at least that.
    """
    values = clean_values(entity, on_error, state_codes, city_tiers)
    out = stage.select(*[values[c.name].alias(c.name) for c in entity.cols], *AUDIT).dropna(subset=entity.keys)
    return out if min_id is None else out.filter(F.col(entity.keys[0]) >= min_id)


def clean_values(
    entity: Entity,
    on_error: str = "continue",
    state_codes: Mapping[str, str] = STATE_CODES,
    city_tiers: Mapping[str, str] = CITY_TIERS,
) -> dict[str, Column]:
    """Expression over the stage columns for every clean column."""
    if on_error not in ("continue", "abort"):
        raise ValueError(f"on_error must be 'continue' or 'abort', not {on_error!r}")
    read = strict if on_error == "abort" else typed
    values = {c.name: read(c.source, c.kind) for c in entity.cols if c.source}
    if entity.name == "location":
        values |= _location_values(state_codes, city_tiers)
    if entity.name == "customer":
        values |= {
            "first_name": name_part("name", 1),
            "last_name": name_part("name", 2),
            "preferences": json_field("preferences", PREFERENCES_JSON, "FoodPreference"),
            "cuisine_types": F.array_join(json_field("preferences", PREFERENCES_JSON, "CuisineTypes"), ", "),
        }
    return values


def lookup(value: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Value of ``mapping``, a small table known to the driver, as part of the projection."""
    table = F.from_json(F.lit(json.dumps(dict(mapping))), "map<string,string>")
    return F.coalesce(table[value], F.lit(default).cast("string"))


def stage_schema(entity: Entity) -> T.StructType:
    fields = [T.StructField(h, T.StringType()) for h in entity.headers]
    return T.StructType(fields + list(_audit_schema()))


def clean_schema(entity: Entity) -> T.StructType:
    fields = [T.StructField(c.name, T.DataType.fromDDL(spark_type(c.kind))) for c in entity.cols]
    return T.StructType(fields + list(_audit_schema()))


def dimension_schema(entity: Entity) -> T.StructType:
    fields = [f for f in clean_schema(entity) if f.name not in AUDIT]
    meta = T.StructType.fromDDL(
        "hk string, attr_hash string, eff_start timestamp, eff_end timestamp, is_current boolean"
    )
    return T.StructType(fields + list(meta))


def required_columns(entity: Entity) -> list[Col]:
    return [c for c in entity.cols if c.required]


def _audit_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "_stg_file_name string, _stg_file_load_ts timestamp, _stg_file_md5 string, _copy_data_ts timestamp"
    )


def _location_values(state_codes: Mapping[str, str], city_tiers: Mapping[str, str]) -> dict[str, Column]:
    """Codes and flags go by the state as delivered; only the state shown is renamed."""
    state, city = F.col("state"), F.col("city")
    capital = (state == "Delhi") | ((state == "New Delhi") & (city == "Delhi"))
    capital = capital | ((state == "Maharashtra") & (city == "Mumbai"))
    return {
        "state": F.when(state == "Delhi", "New Delhi").otherwise(state),
        "state_code": lookup(state, state_codes),
        "is_union_territory": F.coalesce(state.isin(UNION_TERRITORIES), F.lit(False)),
        "capital_city_flag": F.coalesce(capital, F.lit(False)),
        "city_tier": lookup(city, city_tiers, DEFAULT_TIER),
    }
