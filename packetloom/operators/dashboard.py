"""Queries behind the dashboard: recent rows, trend, indicators, latency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.time import duration_text, iso_time, seconds_between
from packetloom.operators.shape import flatten

RECENT_ROWS = 200
SCORE_COLUMNS = ["attack_record_ratio", "max_attack_probability"]


def recent(df: DataFrame, limit: int = RECENT_ROWS, sort_field: str = "created_at") -> DataFrame:
    """The newest rows without the key, nested fields flattened. A top-k, not a full sort."""
    return flatten(df.orderBy(*[F.col(c).desc() for c in newest_first(df, sort_field)]).limit(limit).drop("_id"))


def newest_first(df: DataFrame, sort_field: str) -> list[str]:
    """The sort field, and what decides between the rows of one micro-batch, which share one time."""
    return [sort_field, *[c for c in ("window_end", "_id") if c in df.columns and c != sort_field]]


def with_detection_latency(df: DataFrame) -> DataFrame:
    """Stored latency where it is a number, else created_at - window_end; and its text."""
    stored = F.lit(None).cast("double")
    if "detection_latency_seconds" in df.columns:
        given = F.col("detection_latency_seconds").try_cast("double")
        stored = F.when(~F.isnan(given), given)
    computed = F.lit(None).cast("double")
    if {"window_end", "created_at"} <= set(df.columns):
        computed = seconds_between(iso_time(F.col("window_end")), iso_time(F.col("created_at")))
    latency = df.withColumn("detection_latency_seconds", F.coalesce(stored, computed))
    return latency.withColumn("detection_latency", duration_text(F.col("detection_latency_seconds")))


def trend(predictions: DataFrame) -> DataFrame:
    """Score columns by window end; rows whose window end does not parse are left out."""
    scores = [c for c in SCORE_COLUMNS if c in predictions.columns]
    ends = predictions.select(iso_time(F.col("window_end")).alias("window_end"), *scores)
    return ends.where(F.col("window_end").isNotNull()).orderBy("window_end")


def latest(df: DataFrame, value: str, sort_field: str = "created_at"):
    """Value of the newest row, as a scalar subquery."""
    return df.agg(F.max_by(value, F.struct(*newest_first(df, sort_field))).alias("v")).scalar()


def indicators(windows: DataFrame, predictions: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: table counts, latest ratio and maximum, latest alert latency with its text."""

    def rows(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    alerts = with_detection_latency(alerts)
    return windows.sparkSession.range(1).select(
        rows(windows).alias("windows"),
        rows(predictions).alias("predictions"),
        rows(alerts).alias("alerts"),
        F.coalesce(latest(predictions, "attack_record_ratio"), F.lit(0.0)).alias("latest_attack_ratio"),
        F.coalesce(latest(predictions, "max_attack_probability"), F.lit(0.0)).alias("latest_max_probability"),
        latest(alerts, "detection_latency_seconds").alias("latest_alert_latency_seconds"),
        duration_text(latest(alerts, "detection_latency_seconds")).alias("latest_alert_latency"),
    )
