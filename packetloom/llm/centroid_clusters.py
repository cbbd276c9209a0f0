"""Clusters of vectors around centroids, with a vector-approximation file.

Every vector is kept beside its approximation, BITS bits of each dimension that
name one of 2^BITS cells. Per round, a lookup table gives the least and the
greatest squared distance between a centroid's component and each cell, two
dimensions a byte; summed over the dimensions they bound the distance to every
centroid. A centroid whose least distance is beyond another one's greatest is
out. Where one centroid is left, the full vector is not fetched from its
column; where intervals overlap it is, and exact distances to all decide.

A centroid's sums follow by difference: a vector that stays in its cluster
changes nothing, so only those that move are fetched for them. What cluster a
vector was in is derived from the centroids before, so rounds write nothing,
any lost task can run again, and nothing is shuffled but one sum per task,
cluster and dimension. Vectors and approximations are read in one scan, since
Spark has no fetch by row; the file saves decoding and distances, not the scan.

Vectors must have exactly DIMENSIONS components, none null or non-finite; all
others are left out. A component x becomes floor(64 * x). Beyond LIMIT no
squared distance would fit 64 bits, and the job fails. Cell bounds come from
SAMPLE vectors; the outer ones from the least and greatest component of all, so
intervals are right for every vector and the result does not depend on them.

Repeated rows and ids are rows of their own; equal digests are ordered by
components. Fewer vectors than centroids: as many centroids as vectors. Without
vectors there is no result. A null id counts as the empty text in its digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, fields, plain_names
from packetloom.llm.storage import Scratch

DIMENSIONS, CENTROIDS, ROUNDS = 64, 16, 3
SCALE = 64
BITS = 4
SAMPLE = 4096
LIMIT = 1 << 26
BLOCK_ROWS = 4096


@dataclass(frozen=True)
class Cells:
    """Per dimension the least integer of each cell but the first, and the least and greatest of all."""

    inner: np.ndarray
    least: np.ndarray
    greatest: np.ndarray

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Two cells a byte, the even dimension in the low half."""
        cell = np.stack([np.searchsorted(self.inner[d], vectors[:, d], "right") for d in range(vectors.shape[1])], 1)
        return (cell[:, 0::2] | (cell[:, 1::2] << BITS)).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance by (pair of dimensions, byte, centroid)."""
        low = np.concatenate([self.least[:, None], self.inner], 1)
        high = np.concatenate([self.inner - 1, self.greatest[:, None]], 1)
        high = np.maximum(high, low)
        at = centroids.T[:, None, :]
        below, above = low[:, :, None] - at, at - high[:, :, None]
        near = np.maximum(0, np.maximum(below, above)) ** 2
        far = np.maximum(np.abs(below), np.abs(above)) ** 2
        both = lambda t: (t[0::2, None, :, :] + t[1::2, :, None, :]).reshape(t.shape[0] // 2, -1, t.shape[2])
        return both(near), both(far)


class Assignment:
    """Nearest centroids by intervals, and by full vectors where these overlap."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        self.centroids = centroids
        self.near, self.far = cells.tables(centroids)

    def decided(self, codes: np.ndarray) -> np.ndarray:
        """The only centroid that is possible for each row, or -1."""
        least = np.zeros((len(codes), len(self.centroids)), np.int64)
        greatest = np.zeros_like(least)
        for i in range(codes.shape[1]):
            least += self.near[i][codes[:, i]]
            greatest += self.far[i][codes[:, i]]
        possible = least <= greatest.min(axis=1, keepdims=True)
        return np.where(possible.sum(axis=1) == 1, possible.argmax(axis=1), -1)

    def nearest(self, codes: np.ndarray, fetch) -> np.ndarray:
        """The nearest centroid of each row, the smaller number among equals; ``fetch`` gives full vectors of rows."""
        found = self.decided(codes)
        open_rows = np.flatnonzero(found < 0)
        if len(open_rows):
            found[open_rows] = distances(fetch(open_rows), self.centroids).argmin(axis=1)
        return found


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for i, c in enumerate(centroids):
        out[:, i] = ((vectors - c) ** 2).sum(axis=1)
    return out


# -------------------------------------------------------------------- the file


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether a vector has the right number of components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(vector) == dimensions) & F.forall(vector, finite), F.lit(False))


def integer_vectors(rows: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """The usable rows with their components as integers."""
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    kept = rows.where(usable(F.col(vector), dimensions)).select(key, whole.alias("_v"))
    fits = F.forall("_v", lambda x: F.abs(x) <= LIMIT)
    too_large = F.raise_error(F.lit(f"a component is beyond {LIMIT}: its squared distance fits no 64 bits"))
    return kept.select(key, F.when(fits, F.col("_v")).otherwise(too_large.cast("array<bigint>")).alias("_v"))


def first_vectors(vectors: DataFrame, key: str, n: int) -> np.ndarray:
    """The ``n`` vectors with the smallest digests, in their order; a bounded number of rows reaches the driver."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    found = vectors.select(digest.alias("_digest"), "_v").orderBy("_digest", "_v").limit(n).collect()
    return np.array([r["_v"] for r in found], np.int64) if found else np.zeros((0, 0), np.int64)


def cell_bounds(vectors: DataFrame, sample: np.ndarray) -> Cells:
    """Cells of about equal shares of the sample, and the range of all vectors."""
    dimensions = sample.shape[1]
    ends = vectors.agg(
        *[F.min(F.col("_v")[d]).alias(f"l{d}") for d in range(dimensions)],
        *[F.max(F.col("_v")[d]).alias(f"h{d}") for d in range(dimensions)],
    ).first()
    at = [len(sample) * i // (1 << BITS) for i in range(1, 1 << BITS)]
    inner = np.sort(sample, axis=0)[at].T.copy()
    return Cells(inner, np.array(ends[:dimensions], np.int64), np.array(ends[dimensions:], np.int64))


def _full(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), -1).astype(np.int64)


def approximated(vectors: DataFrame, key: str, cells: Cells) -> DataFrame:
    """Key, ``_codes`` and the full vector as 32-bit numbers in bytes."""
    schema = T.StructType([*fields(vectors, key), T.StructField("_codes", T.BinaryType()), T.StructField("_full", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def code_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            codes = [c.tobytes() for c in cells.codes(whole)]
            yield batch(arrow, [b.column(0), codes, [v.tobytes() for v in whole.astype("<i4")]])

    return vectors.select(key, "_v").mapInArrow(code_batches, schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with their approximations."""
    for b in batches:
        for first in range(0, b.num_rows, BLOCK_ROWS):
            own = b.slice(first, BLOCK_ROWS)
            codes = np.frombuffer(b"".join(own.column("_codes").to_pylist()), np.uint8).reshape(own.num_rows, -1)
            yield own, codes


# ---------------------------------------------------------------------- rounds


def moved_sums(file: DataFrame, cells: Cells, before: np.ndarray | None, now: np.ndarray) -> tuple[list[list[int]], list[int]]:
    """What the vectors that change their cluster add to the sums and sizes of the clusters.

    ``before`` are the centroids of the round before, None in the first round,
    when all vectors are new. Sums of all tasks meet as one row per cluster and dimension.
    """
    k, dimensions = now.shape
    schema = "cluster int, dimension int, total long"

    def sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new = Assignment(cells, before) if before is not None else None, Assignment(cells, now)
        # The last column holds the number of vectors.
        total = np.zeros((k, dimensions + 1), np.int64)
        for own, codes in _blocks(batches):
            fetch = lambda rows: _full(own.column("_full").take(pa.array(rows)))  # noqa: B023, E731
            after = new.nearest(codes, fetch)
            earlier = old.nearest(codes, fetch) if old else np.full(len(after), -1)
            moved = np.flatnonzero(after != earlier)
            if len(moved):
                vectors = np.concatenate([fetch(moved), np.ones((len(moved), 1), np.int64)], 1)
                np.add.at(total, after[moved], vectors)
                left = earlier[moved] >= 0
                np.subtract.at(total, earlier[moved][left], vectors[left])
        cluster, dimension = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster.astype(np.int32)), pa.array(dimension.astype(np.int32)), pa.array(total[cluster, dimension])],
            names=["cluster", "dimension", "total"],
        )

    found = file.select("_codes", "_full").mapInArrow(sum_batches, schema)
    # At most CENTROIDS * (DIMENSIONS + 1) rows.
    rows = found.groupBy("cluster", "dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = [[0] * (dimensions + 1) for _ in range(k)]
    for r in rows:
        sums[r["cluster"]][r["dimension"]] = int(r["total"])
    return [s[:-1] for s in sums], [s[-1] for s in sums]


def assigned(file: DataFrame, key: str, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """Key, cluster and squared distance to its centroid."""
    schema = T.StructType([*fields(file, key), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    arrow = to_arrow_schema(schema)

    def assign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Assignment(cells, centroids)
        for own, codes in _blocks(batches):
            fetch = lambda rows: _full(own.column("_full").take(pa.array(rows)))  # noqa: B023, E731
            cluster = near.nearest(codes, fetch)
            # Distances are asked for, so this last pass fetches every vector once for its own centroid.
            distance = ((_full(own.column("_full")) - centroids[cluster]) ** 2).sum(axis=1)
            yield batch(arrow, [own.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)])

    return file.select(key, "_codes", "_full").mapInArrow(assign_batches, schema)


def centroid_clusters(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    dimensions: int = DIMENSIONS,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Each usable vector's cluster and squared distance, with the sums over its cluster and over all, and its centroid's digest."""
    if dimensions % 2:
        raise ValueError("an approximation holds two dimensions a byte, so their number must be even")
    spark = rows.sparkSession
    rows, (own_key, own_vector) = plain_names(rows, key, vector)
    scratch = Scratch(spark, "centroid-clusters")
    vectors = integer_vectors(rows, own_key, own_vector, dimensions)
    sample = first_vectors(vectors, own_key, max(SAMPLE, centroids))
    kind = rows.schema[own_key].dataType.simpleString()
    if not len(sample):
        return spark.createDataFrame(
            [], f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    cells = cell_bounds(vectors, sample)
    file = scratch.keep(approximated(vectors, own_key, cells), "file")
    now, before = sample[:centroids], None
    sums, sizes = [[0] * dimensions for _ in now], [0] * len(now)
    for _ in range(rounds):
        more, more_rows = moved_sums(file, cells, before, now)
        sums = [[a + b for a, b in zip(x, y)] for x, y in zip(sums, more)]
        sizes = [a + b for a, b in zip(sizes, more_rows)]
        means = [[s // n for s in total] if n else list(c) for total, n, c in zip(sums, sizes, now.tolist())]
        before, now = now, np.array(means, np.int64)
    found = scratch.keep(assigned(file, own_key, cells, now), "assigned")
    scratch.drop("file")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_sum")).collect()
    total = sum(int(r["_sum"]) for r in inertia)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    # One row per centroid.
    about = spark.createDataFrame(
        [(r["cluster"], int(r["_sum"]), total, digests[r["cluster"]]) for r in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    joined = found.join(F.broadcast(about), "cluster")
    return joined.select(F.col(own_key).alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
