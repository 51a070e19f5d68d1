"""Session settings and the shared folder for written state."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

# What the operators rely on; a session may change all of these while it runs.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where the split costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
# For tables of many short rows, where the session says nothing else. Not for the operators on text.
TABLE_SETTINGS = {
    # Hashes as hex text take half the room.
    "spark.sql.parquet.compression.codec": "zstd",
    # Few bytes of a table of numbers are many rows: bounds what a task holds that groups as it reads.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A table that Spark broadcasts by its size takes several times its file's size in memory.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Items that lie by order meet by (item, order) without another shuffle; skewed joins are still split.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
# Building a plan asks the JVM several things per column; noting each call's origin doubles that.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
# A job on large tables is done part by part, so that the shuffle files of one part are gone before the next begins. A part
# reads this many bytes, as Spark sizes tables; more parts than ``MOST_ROUNDS`` would read the tables too often.
ROUND_SETTING, ROUND_BYTES, MOST_ROUNDS = "spark.layercake.roundBytes", "1g", 8
_free: dict[str, list[str]] = {}
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def tune(spark: SparkSession, tables: bool = True) -> SparkSession:
    """Applies the runtime settings to a session that somebody else has started, and the table settings that it has no
    value of its own for; without ``tables``, these go again."""
    session = spark._jsparkSession
    conf, free = session.sessionState().conf(), _free.get(session.sessionUUID())
    if free is None:
        free = _free[session.sessionUUID()] = [key for key in TABLE_SETTINGS if not conf.contains(key)]
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key in free:
        if tables:
            spark.conf.set(key, TABLE_SETTINGS[key])
        else:
            spark.conf.unset(key)
    return spark


def build_session(
    app: str = "layercake", cores: int | str = "*", shuffle_partitions: int = 8, settings: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass the settings to spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in (RUNTIME_SETTINGS | TABLE_SETTINGS | START_SETTINGS | (settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: no shared folder to write to")
        base = tempfile.mkdtemp(prefix="layercake-")
    return f"{base.rstrip('/')}/layercake/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from the shared folder, so that no later step computes them again. Within ``scratch`` they go
    when that ends."""
    base = _scratch.get()
    path = shared_dir(df.sparkSession, name) if base is None else f"{base}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files go once nothing refers to their step; without this, when the driver's memory is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes rows to the shared folder and reads them back; the folder goes when the block ends."""
    base, made = shared_dir(spark, name), iter(range(1 << 30))

    def put(df: DataFrame) -> DataFrame:
        path = f"{base}/{next(made)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    before = _scratch.set(base)
    try:
        yield put
    finally:
        _scratch.reset(before)
        delete_folder(spark, base)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def rounds(spark: SparkSession, most: int, *sources: DataFrame) -> int:
    """In how many parts to do a job that reads the files behind ``sources``; 1 for small ones."""
    size = 0
    for df in sources:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        files = [leaf for leaf in map(leaves.apply, range(leaves.size())) if leaf.getClass().getSimpleName() == "LogicalRelation"]
        size += sum(int(str(leaf.stats().sizeInBytes())) for leaf in files)
    text = spark.conf.get(ROUND_SETTING, ROUND_BYTES)
    part = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)
    return max(1, min(most, MOST_ROUNDS, -(-size // max(1, part))))


def by_parts(
    name: str, make: Callable[[dict[str, DataFrame]], DataFrame], tables: dict[str, tuple[DataFrame, str]], store: bool = False
) -> DataFrame:
    """What ``make`` makes of ``tables``, each of which has a key column; rows of one key have to meet no others.

    Large tables are written cut by key, and the result is made and written part by part, so that only one part's shuffle
    files are on disk at once. Of small ones it is one plan, which is written if ``store`` says so.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    count = rounds(spark, MOST_ROUNDS, *[rows for rows, _ in tables.values()])
    if count == 1:
        whole = make({n: rows for n, (rows, _) in tables.items()})
        return written(whole, name) if store else whole
    path, cut = shared_dir(spark, name), shared_dir(spark, f"{name}-cut")
    for n, (rows, key) in tables.items():
        part = F.pmod(F.xxhash64(key), F.lit(count)).cast("int")
        rows.withColumn("_part", part).write.partitionBy("_part").parquet(f"{cut}/{n}")

    def of(n: str, part: int) -> DataFrame:
        rows = spark.read.schema(tables[n][0].withColumn("_part", F.lit(0)).schema).parquet(f"{cut}/{n}")
        return rows.filter(F.col("_part") == part).drop("_part")

    for part in range(count):
        with scratch(spark, f"{name}-part"):
            made = make({n: of(n, part) for n in tables})
            made.write.mode("append").parquet(path)
            schema = made.schema
            del made  # else its shuffle files stay
        for n in tables:
            delete_folder(spark, f"{cut}/{n}/_part={part}")
        free_shuffles(spark)
    delete_folder(spark, cut)
    return spark.read.schema(schema).parquet(path)
