"""Result tables: overwrite, append, keyed upsert, documents, run folders."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.contract import WINDOW_SUMMARY_FIELDS
from packetloom.operators.shape import metadata_columns
from packetloom.operators.summary import LABEL, PROBABILITY, blank_where_null
from packetloom.sinks.compaction import (
    BATCH,
    COMPACT_EVERY,
    KEEP_OPEN,
    Manifest,
    batch_path,
    compact,
    manifest,
    read_base,
    read_open,
    require_open,
)
from packetloom.session import materialise

KEY = "_id"
DOCUMENTS_PER_TASK = 1_000


def write_table(df: DataFrame, path: str, *, file_format: str = "csv", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if file_format == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.format(file_format).save(path)


def append_summary(df: DataFrame, path: str, fields: Sequence[str] = WINDOW_SUMMARY_FIELDS) -> None:
    """Append rows in the fixed field order; fields the frame lacks and nulls are blank."""
    ordered = df.select(*[F.col(f) if f in df.columns else F.lit("").alias(f) for f in fields])
    write_table(blank_where_null(ordered), path, mode="append")


def record_predictions(scored: DataFrame, keys: Sequence[str], metadata: Sequence[str]) -> DataFrame:
    """Keys, probability, label and the metadata columns the frame has."""
    return scored.select(*keys, PROBABILITY, LABEL, *metadata_columns(scored, metadata))


def append_predictions(df: DataFrame, path: str, *, file_format: str = "csv") -> None:
    write_table(df, path, file_format=file_format, mode="append")


# --------------------------------------------------------------- keyed tables


def require_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Fail the write if a row has no key."""
    message = F.lit(f"a row of a keyed table has no {key}")
    return df.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(message)).otherwise(F.col(key)))


def last_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The last row of each key. Spark cuts each key to one row before the shuffle."""
    newest = W.partitionBy(key).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def upsert_batch(df: DataFrame, path: str, batch_id: int, key: str = KEY) -> None:
    """Write one batch of a keyed table. Writing the same batch again replaces it, also by no rows.

    Rows are replaced as a whole: readers take the newest batch of each key.
    """
    require_open(df.sparkSession, path, batch_id)
    writer = require_key(df, key).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.parquet(batch_path(path, batch_id))


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The rows of one batch, without listing the others."""
    return spark.read.parquet(batch_path(path, batch_id))


def upserted(df: DataFrame, key: str = KEY, batch: str = BATCH, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key of a table that keeps all its batches."""
    return last_per_key(df, key, [batch, *tie_breakers])


def read_upserted(spark: SparkSession, path: str, key: str = KEY) -> DataFrame:
    """The newest row of each key. Beside a base only the open batches are shuffled.

    Open batches are newer than the base, so rows of the base stand unless
    their key is in an open one.
    """
    known = manifest(spark, path)
    if not known.generation:
        return upserted(spark.read.option("basePath", path).parquet(path), key).drop(BATCH)
    base = read_base(spark, path, known)
    fresh = read_open(spark, path, known.upto, like=base)
    if fresh is None:
        return base.drop(BATCH)
    newest = upserted(fresh, key)
    standing = base.join(fresh.select(key).distinct(), key, "left_anti")
    return standing.unionByName(newest).drop(BATCH)


def compact_upserted(spark: SparkSession, path: str, key: str = KEY, keep_open: int = KEEP_OPEN) -> Manifest:
    """Fold old batches of a keyed table into one row per key, sorted and cut by key."""
    return compact(spark, path, lambda rows: upserted(rows, key), key=[key], keep_open=keep_open)


def compaction_is_due(batch_id: int, every: int = COMPACT_EVERY) -> bool:
    return batch_id > 0 and batch_id % every == 0


# ------------------------------------------------------------------ documents


def write_documents(documents: DataFrame, folder: str, documents_per_file: int = 1) -> None:
    """One JSON document per file. Spark's commit makes each file appear whole.

    The number of files, not of bytes, decides how long a task takes, so the
    tasks follow the number of documents, DOCUMENTS_PER_TASK each. Where small
    documents are many, up to ``documents_per_file`` of them share a file, one
    per line, and a task writes one such file; readers need
    ``multi_line=False`` then.
    """
    documents = materialise(documents, "documents")
    per_task = DOCUMENTS_PER_TASK if documents_per_file == 1 else documents_per_file
    tasks = max(documents.sparkSession.sparkContext.defaultParallelism, math.ceil(documents.count() / per_task))
    spread = documents.repartition(tasks, "stream_file")
    writer = spread.write.mode("append").option("maxRecordsPerFile", documents_per_file)
    writer.option("ignoreNullFields", "false").json(folder)


# ---------------------------------------------------------------- run folders


@dataclass(frozen=True)
class RunFolders:
    """Output tables and streaming checkpoint of one run."""

    root: str

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"


def run_folders(root: str, *, fresh: bool = False, run: str = "current") -> RunFolders:
    """Folders to go on with, or new ones: a fresh run starts empty and deletes nothing."""
    return RunFolders(f"{root.rstrip('/')}/{uuid.uuid4().hex if fresh else run}")
