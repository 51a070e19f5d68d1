"""Python workers: this package made importable in them, wherever they run, and their memory kept small."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the library's code to Spark, which sends it to every executor, also to ones started later."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    made = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="layercake-code-")), "layercake_code.zip")
    with zipfile.ZipFile(made, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(made)
    _shipped.add(app)


def give_back() -> None:
    """Returns freed memory to the machine. Workers live on after a task, and Arrow and the C library keep what
    it has freed, so that an executor would hold the largest batch of every worker and every step."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
