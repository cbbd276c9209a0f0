"""Folding old batches of a table into a base, so that readers open few folders however long a run gets.

A table is a folder with one folder per batch. A compaction merges the base so
far and all batches but the newest few into a new base, then names it in the
manifest, and only then deletes what the base before had already replaced:

* the base is written whole before an empty file in the manifest's folder, whose
  name holds the base's generation and the last batch in it, makes it count; a
  job that dies in between leaves a base that nobody reads, and the next one
  writes it anew,
* a reader that planned with the manifest before still finds its base and its
  batches; they go with the compaction after.

Streams repeat their last batch at most, and the newest KEEP_OPEN ones stay
open, so writing a batch that is in the base is an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"
BASE, MANIFEST = "_base", "_manifest"  # hidden from readers of the plain folder
KEEP_OPEN = 10
COMPACT_EVERY = 100


@dataclass(frozen=True)
class Manifest:
    """Which base counts, and the last batch that is in it."""

    generation: int = 0
    upto: int = -1


def batch_path(path: str, batch_id: int) -> str:
    """The folder of one batch of a table; Spark reads it as a partition of ``path``."""
    return f"{path}/{BATCH}={batch_id}"


def base_path(path: str, generation: int) -> str:
    return f"{path}/{BASE}/g{generation}"


def _file(spark: SparkSession, path: str):
    """A path and its file system, whichever Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place, files = _file(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    place, files = _file(spark, path)
    files.delete(place, True)


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest; a table that was never compacted has the empty one."""
    found = [re.fullmatch(r"(\d+)-(\d+)", n) for n in names(spark, f"{path}/{MANIFEST}")]
    return max((Manifest(int(m[1]), int(m[2])) for m in found if m), key=lambda m: m.generation, default=Manifest())


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders that are there, also of those that the base has replaced."""
    found = [re.fullmatch(rf"{BATCH}=(\d+)", n) for n in names(spark, path)]
    return sorted(int(m[1]) for m in found if m)


def require_open(spark: SparkSession, path: str, batch_id: int) -> None:
    """Fail before a batch is written that readers would not see."""
    upto = manifest(spark, path).upto
    if batch_id <= upto:
        raise ValueError(f"batch {batch_id} of {path} is in the base, which holds all batches up to {upto}")


def read_base(spark: SparkSession, path: str, known: Manifest) -> DataFrame | None:
    return spark.read.parquet(base_path(path, known.generation)) if known.generation else None


def read_open(
    spark: SparkSession, path: str, after: int, upto: int | None = None, like: DataFrame | None = None
) -> DataFrame | None:
    """Rows of the batches after ``after``, with their number; only their folders are listed.

    ``like`` gives the columns, which a batch without a single file cannot.
    """
    wanted = [i for i in batches(spark, path) if i > after and (upto is None or i <= upto)]
    if not wanted:
        return None
    reader = spark.read.schema(like.schema) if like is not None else spark.read
    return reader.option("basePath", path).parquet(*[batch_path(path, i) for i in wanted])


def read_table(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """All rows of a table, base and open batches, with the number of the batch that each came with."""
    known = manifest(spark, path)
    base = read_base(spark, path, known)
    fresh = read_open(spark, path, known.upto, upto, base)
    if base is None or fresh is None:
        found = fresh if base is None else base
        return found if found is not None else spark.read.option("basePath", path).parquet(path)
    return base.unionByName(fresh)


def commit(spark: SparkSession, path: str, new: Manifest) -> None:
    """From here on readers take the new base."""
    place, files = _file(spark, f"{path}/{MANIFEST}/{new.generation}-{new.upto}")
    files.create(place, False).close()


def compact(
    spark: SparkSession,
    path: str,
    merge: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    *,
    key: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    keep_open: int = KEEP_OPEN,
) -> Manifest:
    """Fold all batches but the newest ``keep_open`` into a new base; ``merge`` makes its rows of the old ones.

    The base is cut and sorted by ``key``, so equal keys lie together, or into
    folders by ``partition_by``.
    """
    known = manifest(spark, path)
    there = batches(spark, path)
    upto = there[-1] - keep_open if there else known.upto
    base = read_base(spark, path, known)
    folded = read_open(spark, path, known.upto, upto, base)
    if folded is None:
        return known
    upto = max(i for i in there if i <= upto)
    rows = merge(folded if base is None else base.unionByName(folded))
    if key:
        rows = rows.repartition(*[F.col(k) for k in key]).sortWithinPartitions(*key)
    elif partition_by:
        rows = rows.repartition(*[F.col(p) for p in partition_by])
    new = Manifest(known.generation + 1, upto)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(
        base_path(path, new.generation)
    )
    commit(spark, path, new)
    # What the base before had replaced is needed by no reader that began since then.
    for i in there:
        if i <= known.upto:
            delete(spark, batch_path(path, i))
    for name in names(spark, f"{path}/{BASE}"):
        if re.fullmatch(r"g\d+", name) and int(name[1:]) < known.generation:
            delete(spark, f"{path}/{BASE}/{name}")
    return new
