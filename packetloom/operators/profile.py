"""Typing, column profiles and the comparison of two datasets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.contract import SOURCE_FILE, FeatureContract
from packetloom.functions.text import (
    MISSING_CATEGORY,
    is_attack_word,
    literal,
    missing_sql,
    parse_numeric,
    quoted,
    strip_sql,
    text_of,
)
from packetloom.operators.distribution import ROWS_PER_TASK, exact_percentiles
from packetloom.operators.typing import category_of, holds_numbers, parsed_parts, type_columns
from packetloom.session import materialise

NUMERIC_THRESHOLD = 0.95
SAMPLE_VALUES = 5


# ------------------------------------------------------------------- typing


def ratio_sql(parsed: str, non_empty: str) -> str:
    """Parsed share of the non-empty values, 1.0 if there are none."""
    return f"if({non_empty} > 0, {parsed} / {non_empty}, 1D)"


def one_row_per_column(wide: DataFrame) -> DataFrame:
    """Turn one row of structs into rows; the structs have the same fields."""
    return wide.selectExpr(f"inline(array({', '.join(quoted(c) for c in wide.columns)}))")


def parse_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: numeric parse ratio and number of non-empty values. One scan, one small shuffle."""
    parts = parsed_parts(df, columns)
    wide = parts.agg(
        *[
            F.expr(f"struct({literal(c)} AS column, count(n{i}) AS parsed, count_if(NOT m{i}) AS non_empty)").alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return one_row_per_column(wide).selectExpr(
        "column", f"{ratio_sql('parsed', 'non_empty')} AS numeric_parse_ratio", "non_empty AS non_empty_count"
    )


@dataclass(frozen=True)
class ColumnFacts:
    """What one scan says about a text column."""

    name: str
    non_empty: int
    parsed: int
    numeric_ratio: float
    distinct_numbers: bool
    distinct_categories: bool

    def is_numeric(self, threshold: float) -> bool:
        return self.numeric_ratio >= threshold


def column_facts(df: DataFrame, columns: Sequence[str]) -> list[ColumnFacts]:
    """Facts for all columns from one wide aggregate; only counts and flags reach the driver.

    A column is constant when its minimum equals its maximum, which needs no
    distinct count and so no expansion of the rows.
    """
    if not columns:
        return []
    parts = parsed_parts(df, columns)
    parsed = parts.selectExpr(
        *[f"n{i}" for i in range(len(columns))], *[f"{category_of(i)} AS c{i}" for i in range(len(columns))]
    )
    row = parsed.agg(
        *[
            F.expr(
                f"struct(count_if(c{i} != '{MISSING_CATEGORY}') AS non_empty, count(n{i}) AS parsed, "
                f"coalesce(min(n{i}) != max(n{i}), false) AS numbers, "
                f"coalesce(min(c{i}) != max(c{i}), false) AS categories)"
            )
            for i in range(len(columns))
        ]
    ).first()
    return [
        ColumnFacts(
            c,
            f["non_empty"],
            f["parsed"],
            f["parsed"] / f["non_empty"] if f["non_empty"] else 1.0,
            f["numbers"],
            f["categories"],
        )
        for c, f in zip(columns, row)
    ]


def coerce_types(df: DataFrame, columns: Sequence[str], threshold: float = NUMERIC_THRESHOLD) -> DataFrame:
    """Columns as numbers where enough of their values parse, else as categories."""
    numeric = [f.name for f in column_facts(df, columns) if f.is_numeric(threshold)]
    return type_columns(df, numeric, columns, keep=[c for c in df.columns if c not in set(columns)])


def prune_columns(
    facts: Sequence[ColumnFacts], threshold: float = NUMERIC_THRESHOLD
) -> tuple[list[str], list[str], list[str], list[str]]:
    """(numeric, categorical, empty, constant) columns after typing; empty ones are not called constant."""
    numeric, categorical, empty, constant = [], [], [], []
    for f in facts:
        has_values = f.parsed > 0 if f.is_numeric(threshold) else f.non_empty > 0
        varies = f.distinct_numbers if f.is_numeric(threshold) else f.distinct_categories
        if not has_values:
            empty.append(f.name)
        elif not varies:
            constant.append(f.name)
        else:
            (numeric if f.is_numeric(threshold) else categorical).append(f.name)
    return numeric, categorical, empty, constant


def drop_empty_constant(df: DataFrame, columns: Sequence[str], threshold: float = NUMERIC_THRESHOLD) -> DataFrame:
    """Typed columns without those that are empty or constant."""
    numeric, categorical, _, _ = prune_columns(column_facts(df, columns), threshold)
    kept = [c for c in columns if c in {*numeric, *categorical}]
    return type_columns(df, numeric, kept, keep=[c for c in df.columns if c not in set(columns)])


def binary_labels(df: DataFrame, name: str = "label") -> tuple[DataFrame, str]:
    """Add the 0/1 label and tell the column it came from."""
    if "Attack_label" in df.columns:
        text = text_of("Attack_label")
        any_number = df.agg(F.count(parse_numeric(text)).alias("n")).first()["n"] > 0
        label = (F.coalesce(parse_numeric(text), F.lit(0.0)) > 0).cast("int") if any_number else is_attack_word(text)
        return df.withColumn(name, label), "Attack_label"
    if "Attack_type" in df.columns:
        return df.withColumn(name, is_attack_word(text_of("Attack_type"))), "Attack_type"
    raise ValueError("a label column is needed: Attack_label or Attack_type")


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).orderBy(label)


# ----------------------------------------------------------------- profiles


def column_profile(
    df: DataFrame,
    columns: Sequence[str],
    prefix: str,
    order_by: Sequence[str],
    *,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per column: presence, null ratio, constancy, numeric statistics, first values.

    Columns the frame lacks give a row that is marked absent. ``order_by``
    says which values come first.
    """
    here = [c for c in columns if c in df.columns]
    facts = profile_facts(df, here, limit) if here else []
    absent = [(c, False, *[None] * 6) for c in columns if c not in df.columns]
    shape = (
        f"column string, {prefix}_present boolean, {prefix}_null_ratio double, {prefix}_constant boolean, "
        f"{prefix}_numeric_ratio double, {prefix}_min double, {prefix}_median double, {prefix}_max double"
    )
    # One row per column on both sides of the join.
    report = df.sparkSession.createDataFrame([*facts, *absent], shape)
    sample = f"{prefix}_sample_values"
    samples = first_values(df, here, order_by, sample)
    return report.join(samples, "column", "left").withColumn(sample, F.coalesce(sample, F.lit("")))


def profile_facts(df: DataFrame, columns: Sequence[str], limit: int) -> list[tuple]:
    """Per column: name, presence, null ratio, constancy, numeric ratio, minimum, median, maximum.

    One scan yields all but the medians. Those are looked up only in columns
    that have numbers; numbers read from text are stored first, so that no
    text is parsed twice.
    """
    types = dict(df.dtypes)
    numbered = range(len(columns))
    parts = parsed_parts(df, columns, columns)
    parsed = parts.selectExpr(
        # Numbers differ where their texts differ, so a column of numbers needs no texts.
        *[
            f"n{i} AS t{i}" if holds_numbers(types, c) else f"if(m{i}, NULL, {quoted(c)}) AS t{i}"
            for i, c in enumerate(columns)
        ],
        *[f"n{i}" for i in numbered],
    )
    row = parsed.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.expr(
                f"struct(count(t{i}) AS texts, coalesce(min(t{i}) = max(t{i}), true) AS constant, "
                f"count(n{i}) AS numbers, min(n{i}) AS low, max(n{i}) AS high) AS f{i}"
            )
            for i in numbered
        ],
    ).first()
    with_numbers = [i for i in numbered if row[f"f{i}"]["numbers"]]
    medians = {}
    if with_numbers:
        numbers = parts.selectExpr(*[f"n{i}" for i in with_numbers])
        if not all(holds_numbers(types, columns[i]) for i in with_numbers):
            numbers = materialise(numbers, "numbers")
        counts = {f"n{i}": row[f"f{i}"]["numbers"] for i in with_numbers}
        medians = exact_percentiles(numbers, {c: (c, 0.5) for c in counts}, counts=counts, limit=limit)
    facts = []
    for i, c in enumerate(columns):
        f = row[f"f{i}"]
        null_ratio = 1 - f["texts"] / row["rows"] if row["rows"] else None
        numeric_ratio = f["numbers"] / f["texts"] if f["texts"] else 1.0
        facts.append((c, True, null_ratio, f["constant"], numeric_ratio, f["low"], medians.get(f"n{i}"), f["high"]))
    return facts


def first_values(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """The first values of each column that are not missing, in row order, joined as text.

    One scan, whatever the number of columns: a task keeps SAMPLE_VALUES values
    of each column with their places in the order, and what the tasks kept is
    cut once more. Rows in the same place are ordered by the value's text.
    """
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], f"column string, {name} string")
    types = dict(df.dtypes)

    def shown(i: int, c: str) -> str:
        value, text = quoted(c), text_of(c)
        kept = f"nullif({value}, double('nan')) IS NOT NULL" if holds_numbers(types, c) else f"NOT {missing_sql(text)}"
        return f"if({kept}, {text}, NULL) AS v{i}"

    def place(i: int, o: str) -> list[str]:
        """Null first and NaN last, as Spark sorts, for a sorter that puts both last."""
        value = quoted(o)
        if types[o] in ("float", "double"):
            return [f"CASE WHEN {value} IS NULL THEN 0 WHEN isnan({value}) THEN 2 ELSE 1 END AS f{i}", f"nullif({value}, double('nan')) AS o{i}"]
        whole = f"cast({value} AS int)" if types[o] == "boolean" else value
        return [f"if({value} IS NULL, 0, 1) AS f{i}", f"{whole} AS o{i}"]

    given = df.selectExpr(*[e for i, o in enumerate(order_by) for e in place(i, o)], *[shown(i, c) for i, c in enumerate(columns)])
    keys = [c for i in range(len(order_by)) for c in (f"f{i}", f"o{i}")]
    n, limit = len(columns), SAMPLE_VALUES
    shape = T.StructType([T.StructField("i", T.IntegerType()), *[given.schema[k] for k in keys], T.StructField("v", T.StringType())])

    def first_of_task(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        kept = [None] * n
        by = [(k, "ascending") for k in [*keys, "v"]]
        for b in batches:
            places = [b.column(k) for k in keys]
            for i in range(n):
                values = b.column(f"v{i}")
                if values.null_count == len(values):
                    continue
                own = pa.Table.from_arrays([*places, values], names=[*keys, "v"]).filter(pc.is_valid(values))
                own = pa.concat_tables([kept[i], own]) if kept[i] is not None else own
                kept[i] = own.take(pc.select_k_unstable(own, limit, by)) if own.num_rows > limit else own
        for i, own in enumerate(kept):
            if own is not None:
                numbered = own.add_column(0, "i", pa.array([i] * own.num_rows, pa.int32()))
                yield from numbered.combine_chunks().to_batches()

    order = ", ".join([*keys, "v"])
    first = given.mapInArrow(first_of_task, shape).selectExpr("*", f"row_number() OVER (PARTITION BY i ORDER BY {order}) AS n").where(f"n <= {limit}")
    names = spark.createDataFrame(list(enumerate(columns)), "i int, column string")
    joined = f"array_join(transform(sort_array(collect_list(struct(n, v))), p -> {strip_sql('p.v')}), ' | ') AS {name}"
    # One row per column.
    return first.groupBy("i").agg(F.expr(joined)).join(F.broadcast(names), "i").select("column", name)


def compare_profiles(left: DataFrame, right: DataFrame, prefixes: tuple[str, str] = ("edge", "local")) -> DataFrame:
    """Join two column profiles and add presence in both and the shift of the maximum."""
    a, b = prefixes
    report = left.join(right, "column", "full_outer")
    present_a, present_b = (F.coalesce(F.col(f"{p}_present"), F.lit(False)) for p in (a, b))
    max_a, max_b = F.col(f"{a}_max"), F.col(f"{b}_max")
    return report.select(
        "*",
        (present_a & present_b).alias("present_in_both"),
        F.when(F.abs(max_a) > 0, max_b / max_a).alias("range_shift_ratio"),
    )


def drift_lists(report: DataFrame, prefixes: tuple[str, str] = ("edge", "local")) -> DataFrame:
    """(list_name, column): columns in one dataset only, all null in the second, constant in the second."""
    a, b = prefixes
    in_a, in_b, both = (
        F.coalesce(F.col(c), F.lit(False)) for c in (f"{a}_present", f"{b}_present", "present_in_both")
    )
    lists = {
        f"{a}_only": in_a & ~in_b,
        f"{b}_only": ~in_a & in_b,
        f"{b}_all_null": both & (F.coalesce(F.col(f"{b}_null_ratio"), F.lit(1.0)) >= 1.0),
        f"{b}_constant": both & F.coalesce(F.col(f"{b}_constant"), F.lit(False)),
    }
    names = F.filter(F.array(*[F.when(cond, F.lit(n)) for n, cond in lists.items()]), lambda n: n.isNotNull())
    return report.select(F.explode(names).alias("list_name"), "column")


def describe(df: DataFrame, column: str, *, limit: int = ROWS_PER_TASK) -> DataFrame:
    """Count, mean, deviation, extremes and the 50, 90, 95 and 99 % points of a column."""
    points = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    values = df.select(column)
    found = exact_percentiles(values, {k: (column, q) for k, q in points.items()}, limit=limit)
    return values.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        *[F.lit(found[k]).cast("double").alias(k) for k in points],
        F.max(column).alias("max"),
    )


def feature_coverage(df: DataFrame, contract: FeatureContract) -> DataFrame:
    """(feature, state) for contract features that are missing or empty in the frame."""
    missing = [c for c in contract.feature_columns if c not in df.columns]
    here = [c for c in contract.feature_columns if c in df.columns]
    result = df.sparkSession.createDataFrame([(c, "missing") for c in missing], "feature string, state string")
    if here:
        counted = df.agg(
            *[
                F.expr(f"struct({literal(c)} AS feature, count_if(NOT {missing_sql(text_of(c))}) AS n)").alias(f"s{i}")
                for i, c in enumerate(here)
            ]
        )
        empty = one_row_per_column(counted).where("n = 0").selectExpr("feature", "'all_empty' AS state")
        result = result.unionByName(empty)
    return result


def rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"))
