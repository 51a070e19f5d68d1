"""Intermediate tables of an operator, in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layercake.session import free_shuffles, shared_dir


class Scratch:
    """Tables written for one run. They cut lineage: a lost executor costs no earlier step.

    A table that no later step reads can be dropped. The others stay, as the result reads them lazily.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.paths, self.made = spark, shared_dir(spark, name), {}, 0
        self.uses: dict[str, list[str]] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """The same rows, read back. A name may be used again; each use is a table of its own."""
        self.made += 1
        path = self.paths[name] = f"{self.base}/{self.made}-{name}"
        df.write.parquet(path)
        self.uses.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put_all(self, df: DataFrame, name: str) -> DataFrame:
        """As ``put``, with the rows of all earlier uses of the name: one scan, however many there were."""
        self.put(df, name)
        return self.spark.read.schema(df.schema).parquet(*self.uses[name])

    def drop(self, *names: str) -> None:
        """Deletes the folders of tables, and lets Spark's cleaner free the shuffle files of finished steps."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            self.uses[name].remove(self.paths[name])
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.tidy()

    def tidy(self) -> None:
        """Frees the shuffle files of finished steps."""
        free_shuffles(self.spark)
