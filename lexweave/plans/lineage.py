"""Cutting lineage: tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files go at the end of a statement that has written its table: nothing reads them again.
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a new temporary one, but only if the executors are threads
    of this process: on a cluster they would write to their own disks, so that raises."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="lexweave-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: survives lost executors and ends the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexweave-{uuid.uuid4().hex}"
    before = spark.conf.get(_FREES)
    spark.conf.set(_FREES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREES, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table written by ``cut`` that no later plan reads."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


class Scratch:
    """The tables that one operator cuts on its way: ``result`` writes what it returns and deletes all others."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame) -> DataFrame:
        out, path = cut(df)
        self.paths.append(path)
        return out

    def result(self, df: DataFrame) -> DataFrame:
        out, _ = cut(df)
        self.clear()
        return out

    def clear(self) -> None:
        for path in self.paths:
            drop(self.spark, path)
        self.paths.clear()
