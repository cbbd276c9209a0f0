"""Intermediate tables of jobs with many steps, and letting go of them."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from packetloom.session import shared_folder


class Scratch:
    """Tables in one folder below the shared one, each dropped when the steps after it are done."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder = spark, shared_folder(spark, purpose)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; this cuts its lineage."""
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more, and let Spark's cleaner remove the shuffle files of finished jobs."""
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        context._jvm.System.gc()
