"""Thresholds calibrated on windows of benign traffic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.contract import CALIBRATION_FIELDS, Thresholds
from packetloom.functions.rules import clamp_fraction
from packetloom.functions.time import iso_text
from packetloom.operators.distribution import ROWS_PER_TASK, exact_percentiles
from packetloom.session import materialise

# Calibration defaults.
BASELINE_QUANTILE = 1.0
BASELINE_MARGIN = 0.05
MAX_RATIO_THRESHOLD = 0.99

NOTE = "Calibrated on traffic taken to be benign; calibrate again when normal traffic changes."


def usable_windows(summary: DataFrame) -> DataFrame:
    """The calibration fields as numbers, without rows that lack ratio or maximum."""
    missing = sorted(set(CALIBRATION_FIELDS) - set(summary.columns))
    if missing:
        raise ValueError(f"the calibration input lacks the columns {missing}")
    numbers = summary.select(*[F.col(c).try_cast("double").alias(c) for c in CALIBRATION_FIELDS])
    numbers = numbers.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in CALIBRATION_FIELDS])
    return numbers.na.drop(subset=["attack_record_ratio", "max_attack_probability"])


def windows_for_baseline(usable: DataFrame, min_records: int) -> DataFrame:
    """Windows with enough records, or all of them if none has."""
    enough = F.col("records") >= min_records
    any_enough = usable.agg(F.coalesce(F.bool_or(enough), F.lit(False)).alias("a")).scalar()
    return usable.where(F.coalesce(enough, F.lit(False)) | ~any_enough)


def baseline(
    summary: DataFrame,
    rule: Thresholds,
    *,
    model_path: str = "",
    quantile: float = BASELINE_QUANTILE,
    margin: float = BASELINE_MARGIN,
    max_ratio_threshold: float = MAX_RATIO_THRESHOLD,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """The calibration document as one row. Raises if no window is usable."""
    # Read several times below: counts, quantiles and measures.
    usable = materialise(usable_windows(summary), "calibration")
    if usable.isEmpty():
        raise ValueError("the calibration input has no usable numeric rows")
    used = windows_for_baseline(usable, rule.min_records)
    q = clamp_fraction(quantile)
    ratio, peak = "attack_record_ratio", "max_attack_probability"
    found = exact_percentiles(
        used,
        {
            "ratio_q": (ratio, q),
            "ratio_median": (ratio, 0.5),
            "ratio_p95": (ratio, 0.95),
            "peak_median": (peak, 0.5),
            "peak_p95": (peak, 0.95),
        },
        limit=limit,
    )
    measured = used.agg(
        F.lit(found["ratio_q"]).alias("_quantile"),
        F.count(F.lit(1)).alias("windows_used"),
        F.min(ratio).alias("attack_record_ratio_min"),
        F.lit(found["ratio_median"]).alias("attack_record_ratio_median"),
        F.lit(found["ratio_p95"]).alias("attack_record_ratio_p95"),
        F.max(ratio).alias("attack_record_ratio_max"),
        F.lit(found["peak_median"]).alias("max_attack_probability_median"),
        F.lit(found["peak_p95"]).alias("max_attack_probability_p95"),
        F.max(peak).alias("max_attack_probability_max"),
    )
    raised = F.least(F.lit(float(max_ratio_threshold)), F.col("_quantile") + F.lit(float(margin)))
    # The field names of the calibration document, in their order.
    return measured.select(
        iso_text(F.current_timestamp()).alias("created_at"),
        F.lit(model_path).alias("model_path"),
        F.lit(float(rule.record)).alias("record_threshold"),
        F.lit(float(rule.file_max)).alias("file_max_threshold"),
        F.greatest(F.lit(float(rule.file_ratio)), raised).alias("file_ratio_threshold"),
        F.lit(int(rule.min_records)).alias("min_records"),
        F.lit(q).alias("baseline_quantile"),
        F.lit(float(margin)).alias("baseline_margin"),
        usable.agg(F.count(F.lit(1)).alias("n")).scalar().alias("windows_total"),
        "windows_used",
        *[f"attack_record_ratio_{s}" for s in ("min", "median", "p95", "max")],
        *[f"max_attack_probability_{s}" for s in ("median", "p95", "max")],
        F.lit(NOTE).alias("note"),
    )


def thresholds_of(document: DataFrame) -> Thresholds:
    """Thresholds stored in a calibration document."""
    row = document.first()
    if row is None:
        raise ValueError("the calibration document is empty")
    values = row.asDict()
    return Thresholds(
        values.get("record_threshold"),
        values.get("file_max_threshold"),
        values.get("file_ratio_threshold"),
        values.get("min_records"),
    )
