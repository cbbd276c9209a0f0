import hashlib
import math
import random

import numpy as np
import pytest

from packetloom.llm import centroid_clusters
from packetloom.llm.centroid_clusters import Assignment, Cells


def brute(rows, k=16, rounds=3, dimensions=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * x) for x in v]))
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            members = [v for (_, v), o in zip(kept, own) if o == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    total = sum(d for _, _, d in found)
    inertia = {n: sum(d for _, c, d in found if c == n) for n in range(k)}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, inertia[c], total, digests[c]) for i, c, d in found)


def vectors(n, seed, dimensions=64):
    pick = random.Random(seed)
    middles = [[pick.uniform(-1, 1) for _ in range(dimensions)] for _ in range(5)]
    rows = [(i, [float(np.float32(x + pick.gauss(0, 0.2))) for x in pick.choice(middles)]) for i in range(n)]
    rows += [(i, [-0.015625 * (j % 3) for j in range(dimensions)]) for i in range(n, n + 40)]  # a hot vector
    odd = [None, [], [0.5] * (dimensions - 1), [0.5] * (dimensions + 1), [None] + [0.5] * (dimensions - 1)]
    odd += [[bad] + [0.5] * (dimensions - 1) for bad in (float("nan"), float("inf"), float("-inf"))]
    far = [(900, [500.0] * dimensions), (901, [-3e4] + [0.0] * (dimensions - 1))]
    return rows + rows[:3] + [(None, rows[0][1])] * 2 + [(1000 + i, v) for i, v in enumerate(odd)] + far


def result(found):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found.collect())


@pytest.mark.parametrize("n", [0, 7, 300])
def test_equals_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(centroid_clusters, "SAMPLE", 50)
    monkeypatch.setattr(centroid_clusters, "BLOCK_ROWS", 64)
    rows = vectors(n, 3)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, `_v` string").repartition(4)
    assert result(centroid_clusters.centroid_clusters(table)) == brute(rows)


def test_doubles_and_few_dimensions(spark):
    rows = vectors(40, 5, dimensions=6)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = centroid_clusters.centroid_clusters(table, dimensions=6, centroids=4, rounds=2)
    assert result(found) == brute(rows, 4, 2, 6)


def test_intervals_hold_the_distances():
    """Least and greatest distances enclose the exact ones, and what is decided by them is the nearest centroid."""
    pick = np.random.default_rng(2)
    middles = pick.integers(-60, 60, (8, 64))
    data = middles[pick.integers(0, 8, 2000)] + pick.integers(-12, 12, (2000, 64))
    cells = Cells(np.sort(data[:200], axis=0)[[200 * i // 16 for i in range(1, 16)]].T.copy(), data.min(0), data.max(0))
    near = Assignment(cells, middles)
    codes = cells.codes(data)
    least, greatest = (sum(t[i][codes[:, i]] for i in range(32)) for t in (near.near, near.far))
    exact = centroid_clusters.distances(data, middles)
    assert (least <= exact).all() and (exact <= greatest).all()
    decided = near.decided(codes)
    assert (decided >= 0).mean() > 0.9 and (decided == exact.argmin(1))[decided >= 0].all()
    fetched = []
    own = near.nearest(codes, lambda rows: fetched.append(len(rows)) or data[rows])
    assert (own == exact.argmin(1)).all() and sum(fetched) == (decided < 0).sum()


def test_ties_go_to_the_smaller_number():
    cells = Cells(np.zeros((2, 15), np.int64), np.array([-9, -9]), np.array([9, 9]))
    near = Assignment(cells, np.array([[5, 0], [-5, 0], [5, 0]]))
    data = np.array([[0, 3], [1, 0], [-1, 0]])
    assert near.nearest(cells.codes(data), lambda rows: data[rows]).tolist() == [0, 0, 1]


def test_components_beyond_64_bits_fail(spark):
    table = spark.createDataFrame([(1, [1e30] + [0.0] * 63)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        centroid_clusters.centroid_clusters(table).collect()


def test_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroid_clusters.centroid_clusters(table).count() == 0
