"""Exact order statistics and running totals that no single task has to hold.

Spark's own ``percentile`` keeps every distinct value of a group in one buffer
and a window without PARTITION BY runs in one task. Both are the right plan
while the whole input is small, which is checked by counting it. Beyond
ROWS_PER_TASK rows the functions here switch to plans whose groups are bounded
however the rows are spread over the keys:

* rows collapse to cells (key, value, count) before the shuffle,
* values are cut into ranges of about equal numbers of cells, so one range of
  one key is never larger than its share of the whole input,
* per range totals give the rank at which each range starts, and only the
  ranges that hold a wanted rank are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.session import materialise

ROWS_PER_TASK = 1_000_000
MAX_RANGES = 16_384
RANGES_PER_CORE = 4  # a limit below ROWS_PER_TASK cuts no finer than this
SAMPLES_PER_RANGE = 20
SKETCH_ACCURACY = 10_000
NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def fits_one_task(df: DataFrame, limit: int = ROWS_PER_TASK) -> bool:
    """True if the whole input is small enough for a single group. Counting prunes all columns."""
    return df.count() <= limit


# ---------------------------------------------------------------- value ranges


def range_bounds(cells: DataFrame, value: str, limit: int = ROWS_PER_TASK) -> list:
    """Sorted split values that cut the cells into ranges of about ``limit`` cells.

    The split values come from a hash sample of the cells; they only decide
    how work is spread. At most MAX_RANGES - 1 values reach the driver.
    """
    total = cells.count()
    ranges = min(MAX_RANGES, math.ceil(total / limit))
    if ranges <= 1:
        return []
    wanted = ranges * SAMPLES_PER_RANGE
    scale = 1 << 30
    threshold = min(scale, math.ceil(scale * wanted / total))
    sample = cells.where(F.pmod(F.xxhash64(*cells.columns), F.lit(scale)) < threshold).select(value)
    values = sorted(r[0] for r in sample.where(F.col(value).isNotNull()).collect())
    picked = [values[i * len(values) // ranges] for i in range(1, ranges)] if values else []
    return sorted(set(picked))


def with_range(df: DataFrame, value: str, bounds: Sequence, name: str = "_range") -> DataFrame:
    """Add the number of the range a value falls in: how many split values are <= value. Nulls have their own, -1."""
    if not bounds:
        return df.withColumn(name, F.when(F.col(value).isNull(), -1).otherwise(0))
    if dict(df.dtypes)[value].startswith(NUMBER_TYPES):
        splits = [float("-inf"), *sorted({float(b) for b in bounds}), float("inf")]
        cut = Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(df)
        return cut.withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(-1)))
    # Text and times: a binary search over the split values with array functions.
    splits, size = F.lit(list(bounds)), len(bounds)
    steps = [1 << i for i in reversed(range(size.bit_length()))]
    place = F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda found, step: F.when(
            (found + step <= size) & (F.get(splits, found + step - 1) <= F.col(value)), found + step
        ).otherwise(found),
    )
    return df.withColumn(name, F.when(F.col(value).isNull(), -1).otherwise(place))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def range_count(df: DataFrame, limit: int = ROWS_PER_TASK) -> int:
    """How many tasks a large input is cut into, each a range of its order.

    A range holds about ``limit`` rows. A small limit asks for this plan, not
    for tasks without end: beyond RANGES_PER_CORE ranges a core, they are only
    cut further where they hold more than ROWS_PER_TASK rows.
    """
    rows = df.count()
    enough = max(RANGES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))
    return min(MAX_RANGES, min(enough, math.ceil(rows / limit)) + 1)


# -------------------------------------------------------------- running totals


def running_totals(
    cells: DataFrame,
    value: str,
    measures: Sequence[str],
    *,
    descending: bool = False,
    rows: int | None = None,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add cum_<measure>, the total of each measure up to and including each value.

    ``cells`` has one row per value; null sorts below all values. ``rows`` is
    an upper bound of its size, if known.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    if (rows if rows is not None else cells.count()) <= limit:
        w = W.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return cells.select("*", *[F.sum(m).over(w).alias(f"cum_{m}") for m in measures])

    cells = materialise(cells, "cells")
    bounds = range_bounds(cells, value, limit)
    ranged = with_range(cells, value, bounds)
    totals = ranged.groupBy("_range").agg(*[F.sum(m).alias(f"_in_{m}") for m in measures])
    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    before = W.orderBy(range_order).rowsBetween(W.unboundedPreceding, -1)
    # One row per range, at most MAX_RANGES of them.
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_in_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures]
    )
    within = W.partitionBy("_range").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return ranged.join(F.broadcast(offsets), "_range").select(
        *cells.columns,
        *[(F.col(f"_before_{m}") + F.sum(m).over(within)).alias(f"cum_{m}") for m in measures],
    )


# ------------------------------------------------------------- group quantiles


def cell_quantiles(
    cells: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    *,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact interpolated quantiles per key, with bounded groups.

    ``cells`` is a stored table with one row per key and distinct value and the
    number of rows as ``n``. ``quantiles`` maps output names to fractions.
    """
    keys = list(keys)
    bounds = range_bounds(cells, value, limit)
    ranged = with_range(cells.where(F.col(value).isNotNull()), value, bounds)
    totals = ranged.groupBy(*keys, "_range").agg(F.sum("n").alias("_in"))
    # Per key at most MAX_RANGES rows.
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_range",
        "_in",
        F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
        F.sum("_in").over(W.partitionBy(*keys)).alias("_total"),
    )
    wanted = F.array(
        *[
            F.struct(F.lit(f"{name}.{side}").alias("target"), rank((F.col("_total") - 1) * F.lit(q)).alias("rank"))
            for name, q in quantiles.items()
            for side, rank in (("low", F.floor), ("high", F.ceil))
        ]
    )
    held = F.filter(
        wanted, lambda t: (t["rank"] >= F.col("_before")) & (t["rank"] < F.col("_before") + F.col("_in"))
    )
    targets = (
        offsets.select(*keys, "_range", "_before", "_total", held.alias("_targets"))
        .where(F.size("_targets") > 0)
        .alias("t")
    )
    within = W.partitionBy(*keys, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    picked = (
        ranged.join(targets, [*keys, "_range"])
        .select(
            *keys,
            "_total",
            value,
            "n",
            "_targets",
            (F.col("_before") + F.sum("n").over(within)).alias("_upto"),
        )
        .select(*keys, "_total", value, "n", "_upto", F.explode("_targets").alias("_t"))
        .where((F.col("_t.rank") < F.col("_upto")) & (F.col("_t.rank") >= F.col("_upto") - F.col("n")))
    )
    sides = picked.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[
            F.max(F.when(F.col("_t.target") == f"{name}.{side}", F.col(value))).alias(f"_{name}_{side}")
            for name in quantiles
            for side in ("low", "high")
        ],
    )
    return sides.select(*keys, *[_between(name, q).alias(name) for name, q in quantiles.items()])


def _between(name: str, q: float) -> Column:
    position = (F.col("_total") - 1) * F.lit(q)
    part = position - F.floor(position)
    return F.col(f"_{name}_low") * (1 - part) + F.col(f"_{name}_high") * part


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], aggregates: Sequence[Column]
) -> DataFrame:
    """Exact interpolated quantiles per key beside other aggregates, one group per key.

    For inputs that fit one task as a whole: a group's values are sorted as one
    array, which is several times faster than the value-count map of ``percentile``.
    """
    listed = df.groupBy(*keys).agg(*aggregates, F.sort_array(F.collect_list(value)).alias("_sorted"))
    kept = [c for c in listed.columns if c != "_sorted"]

    def quantile(q: float) -> Column:
        position = (F.size("_sorted") - 1) * F.lit(q)
        low, part = F.floor(position), position - F.floor(position)
        low_value, high_value = F.get("_sorted", low.cast("int")), F.get("_sorted", F.ceil(position).cast("int"))
        return low_value * (1 - part) + high_value * part

    return listed.select(*kept, *[quantile(q).alias(name) for name, q in quantiles.items()])


# ------------------------------------------------------------ column quantiles


def exact_percentiles(
    df: DataFrame,
    wanted: Mapping[str, tuple[str, float]],
    *,
    counts: Mapping[str, int] | None = None,
    limit: int = ROWS_PER_TASK,
) -> dict[str, float | None]:
    """Exact interpolated percentiles of whole columns: name -> (column, fraction).

    None where a column has no value. Only these numbers reach the driver.
    ``counts`` are the columns' non-null rows, if they are known.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    if counts is None:
        counts = df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()

    def position(c: str, q: float) -> float:
        return (counts[c] - 1) * q

    ranks = {
        (c, edge(position(c, q))) for c, q in wanted.values() if counts[c] for edge in (math.floor, math.ceil)
    }
    found = order_statistics(df, ranks, counts, limit=limit)

    def value(c: str, q: float) -> float | None:
        if not counts[c]:
            return None
        at = position(c, q)
        low, high, part = found[c, math.floor(at)], found[c, math.ceil(at)], at - math.floor(at)
        return low if low == high else low * (1 - part) + high * part

    return {name: value(c, q) for name, (c, q) in wanted.items()}


@dataclass(frozen=True)
class Span:
    """An open interval of a column that holds wanted ranks; None means unbounded."""

    column: str
    low: float | None
    high: float | None
    below: int
    rows: int

    def holds(self) -> Column:
        c = F.col(self.column)
        kept = c.isNotNull()
        if self.low is not None:
            kept = kept & (c > F.lit(self.low))
        if self.high is not None:
            kept = kept & (c < F.lit(self.high))
        return kept


def order_statistics(
    df: DataFrame, ranks: set[tuple[str, int]], counts: Mapping[str, int], *, limit: int = ROWS_PER_TASK
) -> dict[tuple[str, int], float]:
    """Value at each 0-based (column, rank), by narrowing an open interval around it.

    Every pass is one aggregate over the scan: a mergeable sketch proposes two
    values around the rank, exact counts tell where the rank lies. No row is
    shuffled, and a pass keeps about 4 / SKETCH_ACCURACY of the rows. What is
    left of all intervals together, at most ``limit`` values, is sorted at the end.
    """
    found: dict[tuple[str, int], float] = {}
    spans = {t: Span(t[0], None, None, 0, counts[t[0]]) for t in ranks}

    def largest() -> list[Span]:
        """Intervals to narrow, so that the others together stay within the limit."""
        open_spans = sorted({s for t, s in spans.items() if t not in found}, key=lambda s: s.rows)
        total, kept = 0, 0
        for s in open_spans:
            total += s.rows
            if total > limit:
                break
            kept += 1
        return open_spans[kept:]

    while to_narrow := largest():
        targets = {s: [t for t in spans if t not in found and spans[t] == s] for s in to_narrow}
        margin = 2 / SKETCH_ACCURACY

        def fractions(s: Span) -> list[float]:
            shares = [(t[1] - s.below) / s.rows for t in targets[s]]
            return [f for share in shares for f in (max(0.0, share - margin), min(1.0, share + margin))]

        proposals = df.agg(
            *[
                F.percentile_approx(F.when(s.holds(), F.col(s.column)), fractions(s), SKETCH_ACCURACY)
                for s in to_narrow
            ]
        ).first()
        pairs = {t: proposals[i][2 * j : 2 * j + 2] for i, s in enumerate(to_narrow) for j, t in enumerate(targets[s])}
        edges = {(s, a, b): None for s in to_narrow for t in targets[s] for a, b in [pairs[t]]}
        counted = df.agg(
            *[
                count
                for s, a, b in edges
                for c in [F.col(s.column)]
                for count in (
                    F.count_if(s.holds() & (c < F.lit(a))),
                    F.count_if(c == F.lit(a)),
                    F.count_if((c > F.lit(a)) & (c < F.lit(b))),
                    F.count_if((c == F.lit(b)) & (c != F.lit(a))),
                )
            ]
        ).first()
        sizes = {edge: counted[4 * i : 4 * i + 4] for i, edge in enumerate(edges)}
        for s in to_narrow:
            for t in targets[s]:
                a, b = pairs[t]
                below, at_low, between, at_high = sizes[s, a, b]
                at = t[1] - s.below
                if at < below:
                    spans[t] = Span(s.column, s.low, a, s.below, below)
                elif at < below + at_low:
                    found[t] = a
                elif at < below + at_low + between:
                    spans[t] = Span(s.column, a, b, s.below + below + at_low, between)
                elif at < below + at_low + between + at_high:
                    found[t] = b
                else:
                    passed = below + at_low + between + at_high
                    spans[t] = Span(s.column, b, s.high, s.below + passed, s.rows - passed)

    last = list(dict.fromkeys(s for t, s in spans.items() if t not in found))
    if last:
        lists = df.agg(
            *[F.sort_array(F.collect_list(F.when(s.holds(), F.col(s.column)))).alias(f"l{i}") for i, s in enumerate(last)]
        )
        targets = [t for t in spans if t not in found]
        row = lists.select(*[F.get(f"l{last.index(spans[t])}", F.lit(t[1] - spans[t].below)) for t in targets]).first()
        found.update(zip(targets, row))
    return found


# ------------------------------------------------------------------- positions


def with_record_index(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    block: Sequence[str] | None = None,
    name: str = "record_index",
    total: str | None = None,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Number the rows of each key from 0 in the given order; ``total`` names a column for the number of its rows.

    ``block`` names columns that cut a key into bounded pieces in that order,
    such as the block of the file a row was read from. Without it, a large
    input is cut into ranges of all order columns together, and of the rest of
    the row where these are equal, so a value that most rows have is cut, too.
    Null keys are one key, and null comes first in the order. Only counts per
    piece are summed over a whole key.
    """
    keys, order_by = list(keys), list(order_by)
    if block is None and fits_one_task(df, limit):
        numbered = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)) - 1)
        return numbered.withColumn(total, F.count(F.lit(1)).over(W.partitionBy(*keys))) if total else numbered
    if block is None:
        # Spark samples a bounded number of rows for the bounds of the ranges.
        ranges = range_count(df, limit)
        rest = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)]
        df = df.withColumn("_rest", F.xxhash64(*rest)).repartitionByRange(ranges, *order_by, "_rest")
        df, block, order_by = df.withColumn("_range", F.spark_partition_id()), ["_range"], [*order_by, "_rest"]
    df = materialise(df, "numbered")
    block = list(block)
    before = W.partitionBy(*keys).orderBy(*block).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys, *block)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            *block,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
            *([F.sum("_n").over(W.partitionBy(*keys)).alias(total)] if total else []),
        )
    )
    place = F.row_number().over(W.partitionBy(*keys, *block).orderBy(*order_by)) - 1
    numbered = join_null_safe(df.withColumn("_place", place), starts, [*keys, *block])
    return numbered.withColumn(name, F.col("_start") + F.col("_place")).drop("_start", "_place", "_range", "_rest")


def distinct_rank(df: DataFrame, column: str, name: str, *, limit: int = ROWS_PER_TASK) -> DataFrame:
    """The distinct values of a column, numbered from 1 in sorted order."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_one", F.lit(1))
    return running_totals(distinct, column, ["_one"], limit=limit).select(column, F.col("cum__one").alias(name))
