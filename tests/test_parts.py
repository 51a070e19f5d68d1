"""Large tables are taken part by part, so that shuffle files of all of them never lie on disk at once. The result does not
depend on it."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import duckdb
import pytest
from compare import differences
from helpers import rows
from pyspark.sql import DataFrameWriter, functions as F
from test_star_kpis import star

from __spark_entry__ import oracle_sql, queries
from layercake.functions.hashing import packed, unpacked
from layercake.operators.merge import upsert
from layercake.plans.star import build_fact, packed_keys
from layercake.sources.tables import VersionedTable

TABLES = {
    "region": "SELECT 0 AS r_regionkey, 'ASIA' AS r_name",
    "nation": "SELECT i::INT AS n_nationkey, 'N' || i AS n_name, 0 AS n_regionkey FROM range(3) t(i)",
    "customer": "SELECT i AS c_custkey, 'Customer#' || i AS c_name, (i % 3)::INT AS c_nationkey, i * 1.5 AS c_acctbal,"
    " 'BUILDING' AS c_mktsegment FROM range(15) t(i)",
    "supplier": "SELECT i AS s_suppkey, 'Supplier#' || i AS s_name, (i % 3)::INT AS s_nationkey, i * 2.5 AS s_acctbal FROM range(7) t(i)",
    "part": "SELECT i AS p_partkey, 'hot bolt' AS p_name, 'Brand#1' AS p_brand, ['PROMO', 'ECONOMY', 'LARGE'][1 + i % 3] AS p_type,"
    " 1 AS p_size, 900.0 + i AS p_retailprice FROM range(20) t(i)",
    # One customer and one part that do not exist.
    "orders": "SELECT i AS o_orderkey, i * 7 % 16 AS o_custkey, ['F', 'O', 'P'][1 + i % 3] AS o_orderstatus, 10.25 * i AS o_totalprice,"
    " TIMESTAMP '1998-01-20 00:00:00' + to_days((i * 3 % 90)::INT) AS o_orderdate, '5-LOW' AS o_orderpriority FROM range(60) t(i)",
    # Items of an order come twice or thrice under one number.
    "lineitem": "SELECT i * 11 % 62 AS l_orderkey, i * 13 % 21 AS l_partkey, i % 7 AS l_suppkey, (1 + i % 4)::INT AS l_linenumber,"
    " 1.0 + i % 9 AS l_quantity, 3.25 * i AS l_extendedprice, 0.0 AS l_discount, 0.0 AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus,"
    " TIMESTAMP '1998-02-01 00:00:00' + to_days((i % 50)::INT) AS l_shipdate FROM range(400) t(i)",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    for name, sql in TABLES.items():
        duckdb.connect().execute(f"COPY ({sql}) TO '{path}/{name}.parquet' (FORMAT parquet)")
    return path


@pytest.fixture
def in_parts(spark):
    spark.conf.set("spark.layercake.roundBytes", "1")
    yield
    spark.conf.unset("spark.layercake.roundBytes")


def wrong(spark, folder, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return differences(queries()[name](spark, folder), oracle_sql()[name], con)


@pytest.mark.parametrize("name", ["star_fact", "star_fact_merge", "star_fact_as_of_order", "star_views"])
def test_the_fact_is_made_of_some_orders_after_the_others(spark, folder, in_parts, monkeypatch, name):
    wrote, write = Counter(), DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        wrote[path.rsplit("/", 1)[-1].rsplit("-", 1)[0]] += 1
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    assert wrong(spark, folder, name) == []
    assert wrote["star-fact"] > 1


@pytest.mark.parametrize("name", ["star_fact_reassigned"])
def test_a_version_of_the_fact_is_made_of_some_buckets_after_the_others(spark, folder, monkeypatch, name):
    puts, put, groups = Counter(), VersionedTable._put, VersionedTable.groups

    def noted(self, rows, lying, onto=False):
        puts[self.path.rsplit("/", 1)[-1], self.version()] += 1
        return put(self, rows, lying, onto)

    def halves(self, touched, *sources):
        large = self.path.endswith("_fact") and len(touched) > 1
        return [touched[::2], touched[1::2]] if large else groups(self, touched, *sources)

    monkeypatch.setattr(VersionedTable, "_put", noted)
    monkeypatch.setattr(VersionedTable, "groups", halves)
    assert wrong(spark, folder, name) == []
    assert puts["order_item_fact", 0] > 1 and puts["order_item_fact", 1] > 1


def test_a_merge_in_parts_counts_once_it_is_whole(spark, tmp_path, in_parts, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), spark.range(0).selectExpr("id AS k", "'' AS v").schema, ["k"], buckets=4)

    def batch(low, high, value):
        return spark.range(low, high).selectExpr("id AS k", f"'{value}' AS v")

    def merge(new):
        return table.merge(new, lambda old, more: upsert(old, more, ["k"]), table.buckets_of(new))

    merge(batch(0, 40, "a"))
    put, calls = VersionedTable._put, []

    def stopped(self, rows, lying, onto=False):
        calls.append(onto)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return put(self, rows, lying, onto)

    monkeypatch.setattr(VersionedTable, "_put", stopped)
    with pytest.raises(RuntimeError):
        merge(batch(30, 60, "b"))
    assert calls == [False, True, True]
    table.refresh()
    assert rows(table.read()) == rows(batch(0, 40, "a"))
    assert merge(batch(30, 60, "c")) == 2
    table.refresh()
    assert rows(table.read()) == rows(batch(0, 30, "a").unionByName(batch(30, 60, "c")))
    assert len(rows(table.changes(1))) == 10 * 2 + 20


def test_packed_text_comes_back(spark):
    texts = ["ab" * 20, "AB" * 20, "0" * 40, "x" * 40, "0" * 39, "ab" * 10, "", "\x00" * 20, "grüße", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", F.expr(packed("t")))
    assert [r["back"] for r in df.selectExpr(f"{unpacked('p')} AS back").collect()] == texts
    assert df.filter("length(p) = 20").count() == 2
    assert df.select("p").distinct().count() == len(texts)


def test_keys_may_come_as_bytes(spark):
    items, orders, deliveries, dims = star(spark, [datetime(2020, 1, 1)])
    as_text, as_bytes = (build_fact(items, orders, deliveries, d) for d in (dims, {n: packed_keys(d) for n, d in dims.items()}))
    assert as_bytes.dtypes == as_text.dtypes
    assert rows(as_bytes) == rows(as_text) and as_text.count() == 2


def test_the_plan_of_small_tables_stays_small(spark, folder):
    plan = queries()["star_fact"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" not in plan
