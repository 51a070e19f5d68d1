"""Files landing in a folder, as a stream through the layers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from layercake.plans.pipeline import Warehouse
from layercake.registry import Entity
from layercake.sources.files import CSV_FILES, as_path

# Files per micro-batch. Their names, and nothing else of them, come to the driver.
MAX_FILES = 1000


def stream_stage(
    warehouse: Warehouse,
    entity: Entity,
    landing: str,
    checkpoint: str,
    load_ts: datetime,
    then: Callable[[int], None] | None = None,
    by: str = "header",
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """Appends each new CSV file in ``landing`` to the stage table once, then calls ``then`` with the batch's number.

    Runs until all files present are loaded. Rows that cannot be loaded do not stop the stream. The
    checkpoint knows the files read, the table knows the batches written, so a batch that is replayed
    after a failure adds nothing twice.
    """
    spark = warehouse.spark
    # The stream finds the files and reads nothing of them; they are read as in a batch.
    source = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .options(**CSV_FILES)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select(F.col("_metadata.file_path").alias("name"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        key = f"{checkpoint}#{batch_id}"
        if not warehouse.stage(entity).has_batch(key):
            paths = [as_path(r[0]) for r in batch.collect()]
            warehouse.load_files(entity, paths, load_ts, "continue", by, once=False, batch_id=key)
        if then is not None:
            then(batch_id)

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_entity(
    warehouse: Warehouse,
    entity: Entity,
    landing: str,
    checkpoint: str,
    load_ts: datetime,
    effective_ts: datetime | Callable[[int], datetime],
    by: str = "header",
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """As ``stream_stage``, taking each batch on through clean table and dimension.

    ``effective_ts`` is the time of all batches of this run, or gives each batch its own from its number, such as the
    time of day. The time is written down before the batch starts, so a batch that is replayed keeps it.
    """

    def onward(batch_id: int) -> None:
        warehouse.run_increment(entity, batch_time(warehouse.spark, checkpoint, batch_id, effective_ts))

    return stream_stage(warehouse, entity, landing, checkpoint, load_ts, onward, by, max_files)


def batch_time(spark: SparkSession, checkpoint: str, batch_id: int, effective_ts: datetime | Callable[[int], datetime]) -> datetime:
    """The effective time of a batch: the one noted beside the checkpoint, else a new one, noted now."""
    place = f"{checkpoint.rstrip('/')}-times/{batch_id}"
    notes = spark.read.schema("effective_ts string")
    try:
        noted = notes.json(place).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        noted = None
    if noted is None:  # none, or a note whose writing was cut off
        given = effective_ts(batch_id) if callable(effective_ts) else effective_ts
        spark.range(1).select(F.lit(given.isoformat(" ")).alias("effective_ts")).coalesce(1).write.mode("overwrite").json(place)
        return given
    return datetime.fromisoformat(noted[0])
