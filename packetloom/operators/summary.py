"""Summaries of scored records per file or per window, and the decisions on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.contract import SOURCE_FILE, WINDOW_SUMMARY_FIELDS, Thresholds
from packetloom.functions.rules import label_text, record_label, share, window_label
from packetloom.functions.text import text_or_blank
from packetloom.operators.distribution import ROWS_PER_TASK, cell_quantiles, fits_one_task, group_quantiles
from packetloom.session import materialise

PROBABILITY = "pred_proba_attack"
LABEL = "pred_label"
PROBABILITY_FIELDS = [
    "mean_attack_probability",
    "median_attack_probability",
    "p95_attack_probability",
    "max_attack_probability",
]
QUANTILES = {"median_attack_probability": 0.5, "p95_attack_probability": 0.95}


def with_record_label(scored: DataFrame, threshold: float, probability: str = PROBABILITY) -> DataFrame:
    return scored.withColumn(LABEL, record_label(F.col(probability), threshold))


def probability_summary(
    scored: DataFrame,
    keys: Sequence[str],
    threshold: float,
    *,
    probability: str = PROBABILITY,
    weight: str | None = None,
    limit: int = ROWS_PER_TASK,
    split: bool | None = None,
) -> DataFrame:
    """Per key: records, attack_records, attack_record_ratio and four probability statistics.

    A row with a null probability marks a key without records: it yields
    zeros. ``weight`` counts equal rows that were collapsed before. Null keys
    are keys like others; any key may hold most of the rows. ``split`` chooses the
    plan: one group per key (False), ranges within keys (True), or by the
    number of rows (None).
    """
    keys = list(keys)
    p = F.col(probability)
    rows = scored.select(*keys, p, *([weight] if weight else []))
    if split is None:
        split = not fits_one_task(rows, limit)
    if split:
        # Inside one struct a null key equals itself in the joins that follow.
        rows = rows.withColumn("_keys", F.struct(*keys)).drop(*keys)
        outer, keys = keys, ["_keys"]
        cells = rows.groupBy(*keys, probability).agg(
            F.sum(weight).alias("n") if weight else F.count(F.lit(1)).alias("n")
        )
        rows, weight = materialise(cells, "summary-cells"), "n"

    one = F.col(weight) if weight else F.lit(1)
    some = F.when(p.isNotNull(), one).otherwise(F.lit(0))
    aggregates = [
        F.sum(some).alias("records"),
        F.sum(F.when(p >= F.lit(threshold), one).otherwise(F.lit(0))).alias("attack_records"),
        F.sum(p * one).alias("_sum"),
        F.max(p).alias("max_attack_probability"),
    ]
    if split:
        grouped = rows.groupBy(*keys).agg(*aggregates)
        grouped = grouped.join(cell_quantiles(rows, keys, probability, QUANTILES, limit=limit), keys, "left")
        grouped, keys = grouped.select("_keys.*", *[c for c in grouped.columns if c != "_keys"]), outer
    elif weight:
        quantiles = F.percentile(p, list(QUANTILES.values()), one).alias("_quantiles")
        grouped = rows.groupBy(*keys).agg(*aggregates, quantiles)
        grouped = grouped.withColumns({name: F.get("_quantiles", F.lit(i)) for i, name in enumerate(QUANTILES)})
    else:
        grouped = group_quantiles(rows, keys, probability, QUANTILES, aggregates)
    grouped = grouped.withColumn("mean_attack_probability", F.col("_sum") / F.nullif(F.col("records"), F.lit(0)))
    return grouped.select(
        *keys,
        "records",
        "attack_records",
        share(F.col("attack_records"), F.col("records")).alias("attack_record_ratio"),
        *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in PROBABILITY_FIELDS],
    )


def with_window_label(summary: DataFrame, rule: Thresholds, name: str = "window_pred_label") -> DataFrame:
    return summary.withColumn(
        name,
        window_label(F.col("records"), F.col("attack_record_ratio"), F.col("max_attack_probability"), rule),
    )


def file_summary(
    scored: DataFrame,
    rule: Thresholds,
    *,
    key: str = SOURCE_FILE,
    limit: int = ROWS_PER_TASK,
    split: bool | None = None,
) -> DataFrame:
    """One row per file with both partial rules and the file label; no minimum of records."""
    grouped = probability_summary(scored, [key], rule.record, limit=limit, split=split)
    passes_max = F.col("max_attack_probability") >= F.lit(rule.file_max)
    passes_ratio = F.col("attack_record_ratio") >= F.lit(rule.file_ratio)
    return grouped.select(
        key,
        "records",
        F.col("attack_records").alias("malicious_records"),
        F.col("attack_record_ratio").alias("malicious_record_ratio"),
        *PROBABILITY_FIELDS,
        passes_max.alias("file_pass_max_probability_rule"),
        passes_ratio.alias("file_pass_ratio_rule"),
        (passes_max & passes_ratio).cast("int").alias("file_pred_label"),
    )


def summary_rows(summary: DataFrame, rule: Thresholds, constants: dict[str, Column] | None = None) -> DataFrame:
    """The window summary in its fixed field order; fields the input lacks are blank text."""
    known = {
        "threshold": F.lit(rule.record),
        "file_max_threshold": F.lit(rule.file_max),
        "file_ratio_threshold": F.lit(rule.file_ratio),
        **(constants or {}),
    }

    def value(name: str) -> Column:
        if name in known:
            return known[name]
        return F.col(name) if name in summary.columns else F.lit("")

    return summary.select(*[value(n).alias(n) for n in WINDOW_SUMMARY_FIELDS])


def blank_where_null(df: DataFrame) -> DataFrame:
    """All columns as text with blanks for nulls, the form of an appended summary file."""
    return df.select(*[text_or_blank(F.col(f"`{c}`")).alias(c) for c in df.columns])


def with_label_text(summary: DataFrame, label: str = "window_pred_label") -> DataFrame:
    return summary.withColumn("label_text", label_text(F.col(label)))


def cap_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], cap: int) -> DataFrame:
    """First ``cap`` rows of each key. Spark limits the groups before it shuffles them."""
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_position", position).where(F.col("_position") <= cap).drop("_position")


def restrict(df: DataFrame, predicate: str | None) -> DataFrame:
    """Rows that a SQL predicate of the user keeps; all rows without one."""
    return df.where(F.expr(predicate)) if predicate else df


def throughput(df: DataFrame, key: Column, seconds: float, name: str) -> DataFrame:
    """Rows and rows per second for each time slot of ``seconds`` length."""
    return df.groupBy(key.alias(name)).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) / F.lit(float(seconds))).alias("rows_per_second"),
    )
