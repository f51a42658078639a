"""Shared storage between steps, and code for the executors' Python workers."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's folder among what all executors share (spark.checkpoint.dir); a folder of this machine only where that
    is unset and all tasks run here, as in tests. It is deleted when the driver's Python ends, or by clear."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.amplicore.dir", None)
    sc = spark.sparkContext
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="amplicore-")
        spark.conf.set("spark.amplicore.dir", found)
    own = f"{found.rstrip('/')}/amplicore-{sc.applicationId}"
    if own not in _OWN:
        _OWN.add(own)
        atexit.register(_delete, spark, own)
    return own


#: Folders that this process has used.
_OWN: set[str] = set()


def _delete(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete all stored steps of this application; DataFrames made from them can't be read any more."""
    _delete(spark, shared_dir(spark))


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read back: its lineage ends there, whatever executors are lost later."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each Spark context; Spark hands the file out itself."""
    sc = spark.sparkContext
    if getattr(sc, "_amplicore_shipped", False):
        return
    top = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="amplicore-code-")) / "amplicore.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, Path(top.name) / p.relative_to(top))
    sc.addPyFile(str(to))
    sc._amplicore_shipped = True
