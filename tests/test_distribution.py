"""Large-input plans against brute force, with one key that holds most of the rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.operators.distribution import (
    distinct_rank,
    exact_percentiles,
    RANGES_PER_CORE,
    range_bounds,
    range_count,
    running_totals,
    with_range,
    with_record_index,
)
from packetloom.operators.summary import PROBABILITY, probability_summary


@pytest.fixture(scope="module")
def skewed(spark):
    r = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 50}", round(r.random() ** 4, 3 if i % 2 else 12)) for i in range(6000)]
    rows += [("constant", 0.75)] * 400 + [("single", 0.1), ("empty", None)]
    return rows


def expected(rows):
    groups = {}
    for k, p in rows:
        groups.setdefault(k, []).extend([p] if p is not None else [])
    result = {}
    for k, values in groups.items():
        a = np.array(values)
        if len(a) == 0:
            result[k] = (0, 0, 0.0, 0.0, 0.0, 0.0, 0.0)
        else:
            hits = int((a >= 0.5).sum())
            result[k] = (len(a), hits, hits / len(a), a.mean(), np.median(a), np.quantile(a, 0.95), a.max())
    return result


@pytest.mark.parametrize("options", [{}, {"split": False}, {"split": True, "limit": 200}, {"limit": 500}])
def test_probability_summary(spark, skewed, options):
    df = spark.createDataFrame(skewed, f"k string, {PROBABILITY} double")
    found = {r[0]: tuple(r)[1:] for r in probability_summary(df, ["k"], 0.5, **options).collect()}
    want = expected(skewed)
    assert found.keys() == want.keys()
    for k, values in want.items():
        assert found[k] == pytest.approx(values, abs=1e-12), k


@pytest.mark.parametrize("options", [{"split": False}, {"split": True, "limit": 200}])
def test_weighted_summary(spark, skewed, options):
    df = spark.createDataFrame(skewed, f"k string, {PROBABILITY} double").groupBy("k", PROBABILITY).agg(F.count("*").alias("n"))
    found = {r[0]: tuple(r)[1:] for r in probability_summary(df, ["k"], 0.5, weight="n", **options).collect()}
    for k, values in expected(skewed).items():
        assert found[k] == pytest.approx(values, abs=1e-12), k


@pytest.mark.parametrize("limit", [10, 100, 10**6])
def test_exact_percentiles(spark, limit):
    r = random.Random(3)
    a = [r.choice([0.0, 0.0, 1.0, r.gauss(0, 1)]) for _ in range(3000)]
    b = [float(i % 7) if i % 5 else None for i in range(3000)]
    df = spark.createDataFrame([*zip(a, b, [None] * 3000)], "a double, b double, c double")
    wanted = {f"{c}{q}": (c, q) for c in "abc" for q in (0.0, 0.31, 0.5, 0.95, 1.0)}
    found = exact_percentiles(df, wanted, limit=limit)
    for name, (c, q) in wanted.items():
        values = {"a": a, "b": [x for x in b if x is not None], "c": []}[c]
        if values:
            assert found[name] == pytest.approx(np.quantile(values, q), abs=1e-12), name
        else:
            assert found[name] is None


def test_ranges_are_balanced_and_ordered(spark):
    cells = spark.range(20_000).select((F.col("id") * 0.5).alias("v"))
    bounds = range_bounds(cells, "v", 1000)
    assert len(bounds) == 19 and bounds == sorted(bounds)
    ranged = with_range(cells, "v", bounds, "r")
    rows = ranged.groupBy("r").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("r").collect()
    assert sum(r.n for r in rows) == 20_000 and max(r.n for r in rows) < 3000
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
    edge = with_range(spark.createDataFrame([(bounds[0],), (-1.0,), (float("inf"),)], "v double"), "v", bounds, "r")
    assert [r.r for r in edge.collect()] == [1, 0, 19]
    text = with_range(spark.createDataFrame([("a",), ("b",), ("bb",), ("z",)], "v string"), "v", ["b", "c"], "r")
    assert [r.r for r in text.collect()] == [0, 1, 1, 2]


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(spark, descending):
    cells = spark.range(5000).select((F.col("id") / 7).alias("v"), (F.col("id") % 3).alias("a"), F.lit(1).alias("b"))
    small = running_totals(cells, "v", ["a", "b"], descending=descending)
    large = running_totals(cells, "v", ["a", "b"], descending=descending, limit=300)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


@pytest.mark.parametrize("options", [{}, {"limit": 100}, {"block": ["blk"]}])
def test_record_index(spark, options):
    rows = [(("hot" if i % 3 else f"k{i % 9}"), (i * 37) % 2003, (i * 37) % 2003 // 100) for i in range(2003)]
    df = spark.createDataFrame(rows, "k string, pos int, blk int").repartition(7)
    found = with_record_index(df, ["k"], ["pos"], **options).collect()
    per_key = {}
    for r in found:
        per_key.setdefault(r.k, []).append((r.pos, r.record_index))
    for pairs in per_key.values():
        assert [i for _, i in sorted(pairs)] == list(range(len(pairs)))
    assert len(found) == len(rows)


def test_a_small_limit_makes_no_more_tasks_than_the_cores_need(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"))
    found = with_record_index(df, ["k"], ["pos"], total="n", limit=50)
    assert len(found.inputFiles()) <= RANGES_PER_CORE * spark.sparkContext.defaultParallelism + 1
    assert found.where("record_index != pos div 3 OR n != IF(k = 2, 6666, 6667)").count() == 0
    assert range_count(spark.range(5_000_000), 1_000_000) == 6
    assert range_count(spark.range(50_000_000), 10) == 51


def test_distinct_rank(spark):
    df = spark.createDataFrame([(f"u{i % 321:05d}",) for i in range(2000)], "u string")
    small = {tuple(r) for r in distinct_rank(df, "u", "i").collect()}
    assert small == {tuple(r) for r in distinct_rank(df, "u", "i", limit=20).collect()}
    assert small == {(f"u{i:05d}", i + 1) for i in range(321)}


def test_nan_free(spark):
    df = spark.createDataFrame([("a", 0.2), ("a", None)], f"k string, {PROBABILITY} double")
    row = probability_summary(df, ["k"], 0.5).first()
    assert row.records == 1 and not any(isinstance(v, float) and math.isnan(v) for v in row)
