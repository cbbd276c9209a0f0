"""Scans of result tables and stored documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packetloom.contract import Thresholds
from packetloom.operators.calibrate import thresholds_of
from packetloom.operators.dashboard import RECENT_ROWS, recent
from packetloom.sinks.tables import read_upserted
from packetloom.sources.csv import QUOTING


def recent_rows(spark: SparkSession, path: str, limit: int = RECENT_ROWS, sort_field: str = "created_at") -> DataFrame:
    """Newest rows of a keyed result table."""
    return recent(read_upserted(spark, path), limit, sort_field)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A window summary table written as CSV, as text columns."""
    return spark.read.options(header="true", **QUOTING).csv(path)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def baseline_thresholds(spark: SparkSession, path: str | None) -> Thresholds | None:
    return thresholds_of(read_baseline(spark, path)) if path else None
