"""CSV files to stage rows: all text, bound by header, with file audit columns."""

from __future__ import annotations

import re
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from layercake.operators.clean import stage_schema
from layercake.registry import AUDIT, Entity
from layercake.session import written

_FILE = "_stg_file_name"


# All files below a folder whose names end so; half-written ones (x.csv.tmp) do not.
CSV_FILES = {"pathGlobFilter": "*.{csv,csv.gz,csv.bz2}", "recursiveFileLookup": "true"}


def csv_options() -> dict[str, str]:
    """Comma separated, one header line, optional double quotes, ``\\N`` for NULL, blank lines skipped.

    Line ends are found by Spark (LF or CRLF), compression by file extension.
    """
    return {
        "header": "true",
        "sep": ",",
        "quote": '"',
        "escape": '"',
        "nullValue": "\\N",
        "mode": "PERMISSIVE",
        **CSV_FILES,
    }


def positional_schema(entity: Entity, width: int = 0) -> T.StructType:
    """Text columns by position, ``width`` of them or as many as the entity has."""
    return T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(max(width, len(entity.headers)))])


def read_stage(spark: SparkSession, entity: Entity, path: str | list[str], load_ts: datetime | Column, by: str = "header") -> DataFrame:
    """Stage rows of the files at ``path``. ``by='position'`` ignores the headers."""
    return read_files(spark, entity, path, load_ts, by)[0]


def read_files(
    spark: SparkSession,
    entity: Entity,
    path: str | list[str],
    load_ts: datetime | Column,
    by: str = "header",
    loaded: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """(stage rows, rows of files whose header cannot be bound or None if there are no such files).

    Files whose name and content are in ``loaded`` are left out. A first scan gives each file's content hash and header,
    one row per file; the second one reads the rows.
    """
    if by not in ("header", "position"):
        raise ValueError(f"by must be 'header' or 'position', not {by!r}")
    profiles = bindings(entity, file_profiles(spark, path), by)
    if loaded is not None:
        profiles = only_new_files(profiles, loaded)
    profiles = written(profiles, "file-profiles")
    kinds = profiles.groupBy("binds").agg(F.max(F.size("names")).alias("width"), F.bool_and("straight").alias("straight")).collect()
    width = max((r["width"] for r in kinds if r["binds"] == "name"), default=0)
    raw = with_file_columns(spark.read.schema(positional_schema(entity, width)).options(**csv_options()).csv(path))
    plain = _named(entity, list(range(len(entity.headers))))
    stamp = (load_ts if isinstance(load_ts, Column) else F.lit(str(load_ts))).cast("timestamp")

    def finished(files: DataFrame, columns: list[Column]) -> DataFrame:
        joined = raw.join(files, _FILE).select(*columns, *[c for c in AUDIT if c != "_copy_data_ts"], stamp.alias("_copy_data_ts"))
        return joined.to(stage_schema(entity))

    fine = profiles.filter("binds <> 'refused'").select(_FILE, "_stg_file_md5", "places")
    if all(r["straight"] for r in kinds if r["binds"] != "refused"):
        rows = finished(fine, plain)
    else:
        cells = F.array(*[F.col(c) for c in raw.columns if c not in (_FILE, "_stg_file_load_ts")])
        rows = finished(fine, [F.get(cells, F.get("places", F.lit(i))).alias(h) for i, h in enumerate(entity.headers)])
    refused = profiles.filter("binds = 'refused'").select(_FILE, "_stg_file_md5")
    return rows, finished(refused, plain) if any(r["binds"] == "refused" for r in kinds) else None


def bindings(entity: Entity, profiles: DataFrame, by: str = "header") -> DataFrame:
    """Per file how its columns bind: ``binds`` (name, position or refused), the ``places`` of the entity's columns (-1: not
    there), and whether these are the first ones in order.

    By name: a header with all columns, in any order and among any others, or with none but such columns, of which those not
    there are NULL. By position: a header whose known columns stand where they belong, if there are any. Others name
    some columns in other places, and cannot be bound either way.
    """
    known = F.array(*[F.lit(h) for h in entity.headers])
    places = F.array(*[F.array_position("names", h).cast("int") - 1 for h in entity.headers])
    in_place = F.forall(F.arrays_zip("places", "own"), lambda x: (x["places"] == -1) | (x["places"] == x["own"]))
    own = F.sequence(F.lit(0), F.lit(len(entity.headers) - 1))
    found = profiles.withColumns({"places": places, "own": own})
    whole = ~F.array_contains("places", -1) | ((F.size(F.array_except("names", known)) == 0) & (F.array_max("places") >= 0))
    kind = F.when(F.lit(by == "position"), "position").when(whole, "name").when(in_place, "position").otherwise("refused")
    bound = found.withColumn("binds", kind).withColumn("places", F.when(F.col("binds") == "name", F.col("places")).otherwise(F.col("own")))
    return bound.withColumn("straight", F.col("places") == F.col("own")).drop("own")


def with_file_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        "*",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_modification_time").alias("_stg_file_load_ts"),
    )


def file_profiles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file name, content hash, column names of the first line in small letters), in one scan.

    The hash is the md5 of size, line count and two sums over the lines: of their hashes, and of these times the line's
    number. Both sums add up over the pieces that a file is read in, once the lines before each piece are counted, so the hash
    depends on the lines and their order, never on the pieces. A file without lines has no row.
    """
    mark = (1 << 30) - 1  # small enough for exact products with a line's number
    lines = spark.read.options(**CSV_FILES).text(path).select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("begin"),
        "value",
        F.monotonically_increasing_id().alias("id"),
        *[F.expr(f"(xxhash64({x}) & {mark}L)").alias(n) for n, x in (("h", "value"), ("g", "value, 1"))],
    )
    number = F.col("id").bitwiseAND((1 << 33) - 1)  # within its task, which may read several pieces
    sums = {
        f"{n}{power}": F.sum((F.col(n) * number if power else F.col(n)).cast("decimal(20,0)")) for n in "hg" for power in (0, 1)
    }
    pieces = lines.groupBy(_FILE, "size", "begin").agg(
        F.count("value").alias("n"), F.min(number).alias("first"), F.min_by("value", "id").alias("line"),
        *[total.alias(n) for n, total in sums.items()],
    )
    earlier = Window.partitionBy(_FILE).orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    whole = placed.groupBy(_FILE, "size").agg(
        F.sum("n").alias("n"), F.min_by("line", "begin").alias("line"),
        *[F.sum(f"{n}0").alias(f"{n}0") for n in "hg"],
        *[F.sum(F.col(f"{n}1") + F.col(f"{n}0") * F.col("shift").cast("decimal(12,0)")).alias(f"{n}1") for n in "hg"],
    )
    plain = F.lower(F.regexp_replace("line", "[\ufeff\"\r]", ""))
    return whole.select(
        _FILE,
        F.md5(F.concat_ws(":", "size", "n", "h0", "h1", "g0", "g1")).alias("_stg_file_md5"),
        F.transform(F.split(plain, ","), F.trim).alias("names"),
    )


def new_files(spark: SparkSession, path: str | list[str], loaded: DataFrame) -> list[str]:
    """Paths of the files at ``path`` that are not in ``loaded`` with their time of change. No content is read; the driver,
    which lists files anyway, gets the names of new ones."""
    files = spark.read.format("binaryFile").options(**CSV_FILES).load(path)
    named = files.select(F.col("_metadata.file_path").alias(_FILE), F.col("modificationTime").alias("_stg_file_load_ts"))
    found = named.join(loaded.select(_FILE, "_stg_file_load_ts"), [_FILE, "_stg_file_load_ts"], "left_anti")
    return [as_path(r[0]) for r in found.select(_FILE).collect()]


def as_path(name: str) -> str:
    """A file name, which comes URL-encoded, as a path that stands for this file only."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(name))


def list_stage(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files at ``path`` with size and time; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modification_time"))


def only_new_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files (name and content hash) not in ``loaded`` yet."""
    return files.join(loaded.select(_FILE, "_stg_file_md5"), [_FILE, "_stg_file_md5"], "left_anti")


def _named(entity: Entity, positions: list[int]) -> list[Column]:
    return [F.col(f"_{p}").alias(h) for h, p in zip(entity.headers, positions)]
