"""Decision rules on probabilities, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packetloom.contract import Thresholds


def record_label(probability: Column, threshold: float) -> Column:
    """1 if the probability reaches the threshold, else 0."""
    return (probability >= F.lit(threshold)).cast("int")


def window_label(records: Column, ratio: Column, max_probability: Column, rule: Thresholds) -> Column:
    """1 if enough records were seen and both the maximum and the ratio reach their thresholds."""
    passed = (max_probability >= F.lit(rule.file_max)) & (ratio >= F.lit(rule.file_ratio))
    return F.when(records < F.lit(rule.min_records or 0), 0).otherwise(F.coalesce(passed, F.lit(False)).cast("int"))


def label_text(label: Column) -> Column:
    return F.when(label == 1, "ATTACK").otherwise("BENIGN")


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def clamp_fraction(value: float) -> float:
    return min(1.0, max(0.0, value))
