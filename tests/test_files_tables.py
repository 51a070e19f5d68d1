from __future__ import annotations

import gzip
from datetime import datetime
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F, types as T

from layercake.registry import ENTITIES
from layercake.session import shared_dir, written
from layercake.sources.files import file_profiles, list_stage, new_files, read_files, read_stage
from layercake.sources.tables import VersionedTable

NOW = datetime(2025, 1, 1)
LOCATION = "LocationID,City,State,ZipCode,ActiveFlag,CreatedDate,ModifiedDate"


def put(folder, name, *lines, end="\r\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((end.join(lines) + end).encode())


def test_ragged_blank_quoted_and_null(spark, tmp_path):
    put(
        tmp_path / "in", "a file.csv", LOCATION,
        "1,Patna,Bihar,1,Yes,1/5/2023",
        "",
        '2,"Pune, East","a ""b""",2,\\N,x,y,extra',
        ",,,,,,",
    )
    got = read_stage(spark, ENTITIES["location"], str(tmp_path / "in"), NOW)
    assert rows(got.select("locationid", "city", "state", "activeflag", "modifieddate")) == [
        ("1", "Patna", "Bihar", "Yes", None),
        ("2", "Pune, East", 'a "b"', None, "y"),
        (None, None, None, None, None),
    ]
    audit = got.select("_stg_file_name", "_stg_file_md5", "_copy_data_ts", "_stg_file_load_ts").distinct().collect()
    assert len(audit) == 1 and audit[0][0].endswith("a%20file.csv") and audit[0][2] == NOW and audit[0][3] is not None
    assert len(audit[0][1]) == 32


def test_columns_bind_by_header_or_position(spark, tmp_path):
    put(tmp_path / "in", "plain.csv", LOCATION, "1,Patna,Bihar,1,Yes,c,m")
    put(tmp_path / "in", "more.csv", "LocationID,City,Note,State,ZipCode,ActiveFlag,CreatedDate,ModifiedDate", "2,Pune,note,Maharashtra,2,No,c,m", end="\n")
    put(tmp_path / "in", "other.csv", "LocationID,a,b,c,d,e,f", "3,Agra,Uttar Pradesh,3,No,c,m")
    put(tmp_path / "in", "pipes.csv", LOCATION.replace(",", "|"), "4|Agra|Uttar Pradesh")
    columns = ["locationid", "city", "state", "zipcode"]
    got = read_stage(spark, ENTITIES["location"], str(tmp_path / "in"), NOW).select(columns)
    assert rows(got) == [
        ("1", "Patna", "Bihar", "1"), ("2", "Pune", "Maharashtra", "2"), ("3", "Agra", "Uttar Pradesh", "3"),
        ("4|Agra|Uttar Pradesh", None, None, None),
    ]
    blind = read_stage(spark, ENTITIES["location"], str(tmp_path / "in"), NOW, by="position").select(columns)
    assert ("2", "Pune", "note", "Maharashtra") in rows(blind)


def test_compressed_files_and_listing(spark, tmp_path):
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(f"{LOCATION}\n1,Patna,Bihar,1,Yes,c,m\n".encode()))
    (tmp_path / "ignored.txt").write_text("1,2,3")
    got = read_stage(spark, ENTITIES["location"], str(tmp_path), NOW)
    assert rows(got.select("locationid", "city")) == [("1", "Patna")]
    assert list_stage(spark, str(tmp_path)).count() == 2


def test_content_hash_depends_on_lines_and_their_order_only(spark, tmp_path):
    lines = [f"line {i}," + "x" * (i % 50) for i in range(3000)]
    swapped = lines[:100] + [lines[2000]] + lines[101:2000] + [lines[100]] + lines[2001:]
    for name, content in (("a", lines), ("b", swapped), ("c", lines), ("d", lines[1:] + lines[:1])):
        (tmp_path / f"{name}.csv").write_text("\n".join(content) + "\n")
    found = []
    for size in ("1g", "20k", "3k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found.append({r[0][-5:]: r[1] for r in file_profiles(spark, str(tmp_path)).collect()})
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == found[2]
    assert found[0]["a.csv"] == found[0]["c.csv"] and len(set(found[0].values())) == 3


def test_headers_that_name_columns_in_other_places_are_refused(spark, tmp_path):
    put(tmp_path / "in", "part.csv", "LocationID,State,City,ZipCode,ActiveFlag,CreatedDate", "1,Bihar,Patna,1,Yes,c")
    put(tmp_path / "in", "other.csv", "LocationID,State,City,ZipCode,Flag,CreatedDate,ModifiedDate", "2,Bihar,Patna,1,Yes,c,m")
    good, refused = read_files(spark, ENTITIES["location"], str(tmp_path / "in"), NOW)
    columns = ["locationid", "city", "state", "createddate", "modifieddate"]
    assert rows(good.select(columns)) == [("1", "Patna", "Bihar", "c", None)]
    assert rows(refused.select(columns)) == [("2", "Bihar", "Patna", "c", "m")]
    blind, none = read_files(spark, ENTITIES["location"], str(tmp_path / "in"), NOW, by="position")
    assert none is None and blind.count() == 2


def test_known_files_are_not_read_again(spark, tmp_path):
    put(tmp_path / "in", "a [1]*.csv", LOCATION, "1,Patna,Bihar,1,Yes,c,m")
    loaded = spark.createDataFrame([], "_stg_file_name string, _stg_file_load_ts timestamp")
    (path,) = new_files(spark, str(tmp_path / "in"), loaded)
    first = read_stage(spark, ENTITIES["location"], [path], NOW)
    assert first.count() == 1
    assert new_files(spark, str(tmp_path / "in"), first) == []
    put(tmp_path / "in", "b.csv", LOCATION, "2,Patna,Bihar,1,Yes,c,m")
    (other,) = new_files(spark, str(tmp_path / "in"), first)
    assert other.endswith("/b.csv")


def test_headers_in_any_order_and_as_wide_as_they_are(spark, tmp_path):
    names = LOCATION.split(",")
    cells = dict(zip(names, ["1", "Patna", "Bihar", "1", "Yes", "c", "m"]))
    junk = [f"x{i}" for i in range(40)]
    for i, order in enumerate([names[::-1], names[1:] + names[:1], [*junk, *names], [names[0], *junk, *names[1:]]]):
        put(tmp_path / "in", f"{i}.csv", ",".join(order), ",".join(cells.get(n, "j") for n in order))
    got = read_stage(spark, ENTITIES["location"], str(tmp_path / "in"), NOW)
    assert rows(got.select(*ENTITIES["location"].headers)) == [tuple(cells.values())] * 4


def test_more_layouts_than_a_hundred(spark, tmp_path):
    for i in range(105):
        put(tmp_path / "in", f"{i}.csv", ",".join(["x"] * i) + "," * (i > 0) + LOCATION, "j," * i + f"{i},Patna,Bihar,1,Yes,c,m")
    got = read_stage(spark, ENTITIES["location"], str(tmp_path / "in"), NOW)
    assert rows(got.select(got.locationid.cast("int"), "city")) == sorted([(i, "Patna") for i in range(105)], key=repr)


# -- tables ----------------------------------------------------------------------------------------


def table(spark, path, buckets=4):
    schema = spark.range(0).select("id", F.lit("").alias("v")).schema
    return VersionedTable(spark, str(path), schema, ["id"], buckets=buckets)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "id long, v string")


def replace(old, new):
    return old.join(new.select("id"), "id", "left_anti").unionByName(new)


def merge(t, new, **kw):
    return t.merge(new, replace, t.buckets_of(new), **kw)


def test_versions_stay_readable(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert (t.version(), t.read().count()) == (0, 0)
    merge(t, frame(spark, *[(i, "a") for i in range(20)]))
    merge(t, frame(spark, (3, "b"), (99, "n")))
    t.truncate()
    merge(t, frame(spark, (5, "c")))
    assert [t.read(v).count() for v in range(5)] == [0, 20, 21, 0, 1]
    assert rows(t.read(2).filter("id in (3, 4, 99)")) == [(3, "b"), (4, "a"), (99, "n")]
    again = table(spark, tmp_path / "t")
    assert (again.version(), rows(again.read())) == (4, [(5, "c")])


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=8)
    merge(t, frame(spark, *[(i, "a") for i in range(100)]))
    before = {b: v for b, (v, _) in t._state().buckets.items()}
    one = frame(spark, (1, "b"))
    merge(t, one)
    after = {b: v for b, (v, _) in t._state().buckets.items()}
    assert [b for b in after if after[b] != before[b]] == t.buckets_of(one) == t.touched_since(1)
    assert rows(t.changes(1)) == [(1, "a", "DELETE", True), (1, "b", "INSERT", True)]
    assert t.changes(2).count() == 0
    assert t.changes(0).count() == 100


def test_emptied_bucket(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    merge(t, frame(spark, (1, "a")))
    gone = frame(spark, (1, "a"))
    t.merge(gone, lambda old, new: old.join(new, "id", "left_anti").select("id", "v"), t.buckets_of(gone))
    assert t.read().count() == 0
    assert rows(t.changes(1)) == [(1, "a", "DELETE", False)]
    assert table(spark, tmp_path / "t").read().count() == 0


def test_append_and_feed(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.append(frame(spark, (1, "a")), batch_id="x")
    t.append(frame(spark, (1, "b"), (2, "b")), sources={"up": 7})
    t.append(frame(spark))
    assert t.read().count() == 3
    assert rows(t.appended_since(1)) == [(1, "b"), (2, "b")]
    assert t.has_batch("x") and not t.has_batch("y")
    assert t.consumed("up") == 7 and table(spark, tmp_path / "t").consumed("up") == 7
    t.mark_consumed({"up": 9})
    assert (t.consumed("up"), t.consumed("other"), t.read().count()) == (9, 0, 3)
    t.truncate()
    assert t.read().count() == 0
    t.append(frame(spark, (9, "z")))
    assert rows(t.read()) == [(9, "z")] == rows(table(spark, tmp_path / "t").read())


def test_uncommitted_write_is_invisible_and_repaired(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    merge(t, frame(spark, (1, "a")))
    # A writer that died after its data and before its commit.
    frame(spark, (1, "lost")).selectExpr("*", "0 AS _append", "0 AS _bucket").write.partitionBy("_append", "_bucket").parquet(
        str(tmp_path / "t" / "data" / "v=2")
    )
    again = table(spark, tmp_path / "t")
    assert rows(again.read()) == [(1, "a")]
    merge(again, frame(spark, (2, "b")))
    assert rows(again.read()) == [(1, "a"), (2, "b")]


def test_another_session_sees_commits_after_refresh(spark, tmp_path):
    writer, reader = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    assert reader.version() == 0
    merge(writer, frame(spark, (1, "a")))
    reader.refresh()
    assert rows(reader.read()) == [(1, "a")]


def test_shared_dir_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{base}/layercake/x-")
    assert rows(written(frame(spark, (1, "a")), "w")) == [(1, "a")]
    assert list((Path(base) / "layercake").glob("w-*"))


def test_a_table_keeps_its_number_of_buckets(spark, tmp_path):
    schema = T.StructType.fromDDL("k long, v string")
    made = VersionedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=4)
    batch = spark.createDataFrame([(i, "a") for i in range(20)], schema)
    made.merge(batch, lambda old, new: old.unionByName(new), made.buckets_of(batch))
    other = VersionedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=8)
    with pytest.raises(ValueError, match="cut into 4 buckets, not 8"):
        other.buckets_of(batch)
    assert VersionedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=4).read().count() == 20


def test_overwriting_a_table_without_keys_moves_no_rows(spark, tmp_path):
    schema = T.StructType.fromDDL("k long")
    table = VersionedTable(spark, str(tmp_path / "t"), schema)
    table.append(spark.range(1000).toDF("k").repartition(4))
    table.overwrite(table.read().filter("k % 2 = 0").withColumn("_append", F.lit(1)))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    assert files.load(f"{tmp_path}/t/data/v=2").count() == 4
    assert table.read().count() == 500


def test_part_that_lies_by_bucket_is_written_without_a_shuffle(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL("k long, v long"), ["k"], buckets=2)
    data = spark.range(400).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
    assert not table.filled([0, 1])
    lying = table.near(data, [0, 1])
    tasks = lying.select(table._bucket().alias("b"), "_place", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({(r["b"], r["_place"]) for r in tasks}) == len(tasks) == 4
    table.merge(data, lambda old, new: (old, lying.drop("_place")), [0, 1])
    assert table.filled([1]) and rows(table.read()) == [(k, 1) for k in sorted(range(400), key=lambda k: repr((k, 1)))]
    more = spark.createDataFrame([(7, 2), (401, 2)], "k long, v long")
    table.merge(more, lambda old, new: (old.filter("k <> 7"), new), [0, 1])
    assert table.read().count() == 401 and rows(table.read().filter("v = 2")) == [(401, 2), (7, 2)]


def test_parts_that_lie_may_be_all_there_is(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), frame(spark, (1, "a")).schema, ["id"], buckets=2)
    merge(t, frame(spark, (1, "a"), (2, "a"), (3, "a")))
    more = frame(spark, (3, "b"), (4, "b"))

    def combine(old, new):
        return None, t.near(old, [0, 1]).filter("id <> 3").drop("_place").unionByName(new)

    t.merge(more, combine, [0, 1])
    assert rows(t.read()) == [(1, "a"), (2, "a"), (3, "b"), (4, "b")]
