"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on, on any cluster. The JVM never compiles a method
# beyond 8000 bytes of bytecode, which a stage over dozens of text columns
# exceeds; with this limit Spark splits such a stage's code instead.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings; sizes of memory and shuffles are left to the cluster."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


@functools.cache
def _local_folder(application: str) -> str:
    """One folder for an application in local mode; the caller's settings stay as they are."""
    return tempfile.mkdtemp(prefix="packetloom-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for ``purpose`` under the one the cluster names in spark.checkpoint.dir.

    Every executor must reach it, so a machine-local folder is only used in
    local mode, where driver and executors are the same process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df, purpose: str):
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives executor loss, and gives the
    next stages exact statistics to plan with.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
