from __future__ import annotations

from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from layercake.functions.hashing import NULL_MARK, SEPARATOR, compact_key, row_hash
from layercake.functions.parse import month_label, name_part, parse_bool, parse_ts, strict, typed
from layercake.session import TABLE_SETTINGS, tune


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-05T10:20:30", datetime(2024, 1, 5, 10, 20, 30)),
        ("2024-01-05 10:20:30.123456", datetime(2024, 1, 5, 10, 20, 30, 123456)),
        (" 2024-01-05 ", datetime(2024, 1, 5)),
        ("1/5/2024 4:44", datetime(2024, 1, 5, 4, 44)),
        ("01/05/2024", datetime(2024, 1, 5)),
        ("10:00:00", None),
        ("13/45/2024", None),
        ("2024-02-30", None),
        ("2024", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_ts("t")).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "kind", "expected"),
    [
        (" 12 ", "bigint", "12"),
        ("4.2", "bigint", None),
        ("99999999999999999999", "bigint", None),
        ("junk", "bigint", None),
        ("28.45797541", "decimal(9,6)", "28.457975"),
        ("123456.5", "decimal(9,6)", None),
        (".5", "decimal(4,2)", "0.50"),
        ("1e2", "decimal(10,2)", "100.00"),
        ("n/a", "decimal(4,2)", None),
        ("3/12/1985", "date", "1985-03-12"),
        ("  x ", "text", "x"),
        ("  x ", "string", "  x "),
        ("TRUE", "boolean", "true"),
        ("yes", "boolean", None),
    ],
)
def test_typed(spark, text, kind, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(typed("t", kind).cast("string")).first()[0] == expected


def test_strict_fails_on_bad_text_only(spark):
    df = spark.createDataFrame([("1",), (None,)], "t string")
    assert rows(df.select(strict("t", "bigint"))) == [(1,), (None,)]
    with pytest.raises(Exception, match="not a bigint: x"):
        spark.createDataFrame([("x",)], "t string").select(strict("t", "bigint")).collect()


def test_names_flags_and_months(spark):
    df = spark.createDataFrame([("Ada King Love", 3), ("Ada", 12)], "n string, m int")
    found = df.select(name_part("n", 1), name_part("n", 2), month_label("m"), parse_bool("n"))
    assert rows(found) == [("Ada", "", "Dec", None), ("Ada", "King", "Mar", None)]


def test_row_hash_tells_nulls_and_borders_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c"), ("", "c"), ("a", None)], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 5
    assert SEPARATOR != NULL_MARK


def test_compact_key_is_the_first_sixty_bits(spark):
    got = spark.range(1).select(compact_key(F.lit("0fffffffffffffff" + "0" * 24))).first()[0]
    assert got == 0x0FFFFFFFFFFFFFF


def test_table_settings_fill_what_a_session_leaves_open(spark):
    session, codec, split = spark.newSession(), "spark.sql.parquet.compression.codec", "spark.sql.files.maxPartitionBytes"
    for key in TABLE_SETTINGS:
        session.conf.unset(key)
    session.conf.set(split, "5m")
    default = session.conf.get(codec)
    assert tune(session).conf.get(codec) == TABLE_SETTINGS[codec] != default and session.conf.get(split) == "5m"
    assert tune(session, tables=False).conf.get(codec) == default and session.conf.get(split) == "5m"
