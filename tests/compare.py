"""Runs catalogue queries against their SQL: python tests/compare.py [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def normal(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs between a query and its SQL; empty if nothing does."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = normal(cur.fetchall(), names)
    ours = normal([tuple(r) for r in spark_df.collect()], spark_df.columns)
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} != {sorted(names)}")
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows != {len(theirs)}")
    mine = set(map(repr, ours)) - set(map(repr, theirs))
    other = set(map(repr, theirs)) - set(map(repr, ours))
    if mine or other:
        found.append(f"only in Spark {sorted(mine)[:3]}; only in SQL {sorted(other)[:3]}")
    return found


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from layercake.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problems = differences(df, sql[name], con) if name in sql else [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:32s} {time.time() - start:6.2f}s", *problems, flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
