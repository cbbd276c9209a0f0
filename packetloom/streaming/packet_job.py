"""Capture windows over a stream of single records: fixed length, fixed pause.

What is kept of the records is one count per window and distinct probability,
so a window that receives most of the records is spread over many rows. The
counts are stored by micro-batch, written again if a batch is, and a window is
summarised exactly from all its counts whenever a batch touches it.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetloom.contract import Thresholds
from packetloom.functions.time import iso_text, window_key
from packetloom.operators.summary import PROBABILITY, probability_summary
from packetloom.session import materialise
from packetloom.sinks.compaction import BATCH, COMPACT_EVERY, KEEP_OPEN, batch_path, compact, read_table, require_open
from packetloom.sinks.tables import RunFolders, compact_upserted, compaction_is_due, read_batch, upsert_batch
from packetloom.streaming.window_job import TRIGGER, alerts_table, predictions_table

# Capture and pause length in seconds.
WINDOW_SECONDS = 30
PAUSE_SECONDS = 5


def capture_window(ts: Column, window_seconds: int, pause_seconds: int, start: str = "0 seconds") -> Column:
    """The period of capture and pause that a time falls into."""
    return F.window(ts, f"{window_seconds + pause_seconds} seconds", startTime=start)


def captured_records(
    records: DataFrame,
    ts: str,
    *,
    window_seconds: int = WINDOW_SECONDS,
    pause_seconds: int = PAUSE_SECONDS,
    start: str = "0 seconds",
) -> DataFrame:
    """Records inside a capture window, with its start as ``capture_start``; those in a pause are left out."""
    periods = records.withColumn("_period", capture_window(F.col(ts), window_seconds, pause_seconds, start))
    inside = F.col(ts) < F.col("_period.start") + F.make_dt_interval(secs=F.lit(window_seconds))
    return periods.where(inside).withColumn("capture_start", F.col("_period.start"))


def capture_cells(
    scored: DataFrame,
    ts: str,
    *,
    window_seconds: int = WINDOW_SECONDS,
    pause_seconds: int = PAUSE_SECONDS,
    start: str = "0 seconds",
) -> DataFrame:
    """Rows per capture window and distinct probability."""
    captured = captured_records(scored, ts, window_seconds=window_seconds, pause_seconds=pause_seconds, start=start)
    return captured.groupBy("capture_start", PROBABILITY).agg(F.count(F.lit(1)).alias("n"))


def capture_summary(
    cells: DataFrame,
    rule: Thresholds,
    *,
    window_seconds: int,
    interface: str = "",
    split: bool | None = None,
    window_id: Column | None = None,
) -> DataFrame:
    """Window summary with the identifying columns of a document."""
    grouped = probability_summary(cells, ["capture_start"], rule.record, weight="n", split=split)
    start = F.col("capture_start")
    number = window_id if window_id is not None else F.lit(0)
    return grouped.select(
        "*",
        number.cast("int").alias("window_id"),
        window_key(number, start).alias("stream_file"),
        iso_text(start).alias("window_start"),
        iso_text(start + F.make_dt_interval(secs=F.lit(window_seconds))).alias("window_end"),
        F.lit(interface).alias("interface"),
        F.lit("live_capture").alias("source_path"),
    )


def capture_number(origin: datetime, period_seconds: int) -> Column:
    """1 for the window that starts at ``origin``, then one more for each period; earlier windows count down."""
    passed = F.unix_timestamp("capture_start") - F.unix_timestamp(F.lit(origin))
    return (F.floor(passed / period_seconds) + 1).cast("int")


def packet_windows_table(summary: DataFrame, at: Column, window_seconds: int) -> DataFrame:
    """The windows table of a record stream; its records are not kept, so there is no preview."""
    return summary.select(
        F.col("stream_file").alias("_id"),
        "window_id",
        "window_start",
        "window_end",
        "interface",
        "source_path",
        "stream_file",
        F.lit(window_seconds).alias("window_seconds"),
        F.col("records").cast("int").alias("record_count"),
        iso_text(at).alias("ingested_at"),
    )


def start_packet_scoring(
    scored: DataFrame,
    ts: str,
    rule: Thresholds,
    folders: RunFolders,
    *,
    watermark: str,
    window_seconds: int = WINDOW_SECONDS,
    pause_seconds: int = PAUSE_SECONDS,
    start: str = "0 seconds",
    trigger_interval: str = TRIGGER,
    available_now: bool = False,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start the stream over scored records; windows, predictions and alerts follow every micro-batch.

    The cells of each micro-batch are stored by day. The windows that a batch
    touches are summarised again from all their cells, and the keyed tables
    take the newer row: a window is there as soon as it has a row, is complete
    when its last row is in, and a late row corrects it. ``watermark`` only
    says from when on a row counts as late in the progress table. An alert
    that was raised stays. Every ``compact_every`` batches the old ones of all
    tables are folded, so what a batch lists does not grow with the run's age.
    """
    period = window_seconds + pause_seconds

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist()
        try:
            if kept.isEmpty():
                return
            at = F.lit(datetime.now(timezone.utc).replace(microsecond=0))
            options = {"window_seconds": window_seconds, "pause_seconds": pause_seconds, "start": start}
            day = F.to_date("capture_start").alias("capture_day")
            cells = capture_cells(kept, ts, **options).select("capture_start", PROBABILITY, "n", day)
            writer = cells.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("capture_day")
            require_open(spark, folders.table("cells"), batch_id)
            writer.parquet(batch_path(folders.table("cells"), batch_id))
            write_progress(kept, ts, folders, batch_id, watermark, options)

            fresh = read_batch(spark, folders.table("cells"), batch_id)
            touched = fresh.select("capture_day", "capture_start").distinct()
            stored = read_table(spark, folders.table("cells"), upto=batch_id)
            known = stored.join(touched, ["capture_day", "capture_start"], "left_semi")
            origin = first_capture(spark, folders, fresh, batch_id)
            if origin is None:
                return
            number = capture_number(origin, period)
            summary = materialise(capture_summary(known, rule, window_seconds=window_seconds, window_id=number), "packets")
            upsert_batch(packet_windows_table(summary, at, window_seconds), folders.table("windows"), batch_id)
            upsert_batch(predictions_table(summary, rule, at), folders.table("predictions"), batch_id)
            upsert_batch(
                alerts_table(read_batch(spark, folders.table("predictions"), batch_id)), folders.table("alerts"), batch_id
            )
            if compaction_is_due(batch_id, compact_every):
                compact_run(spark, folders)
        finally:
            kept.unpersist()

    trigger = {"availableNow": True} if available_now else {"processingTime": trigger_interval}
    writer = scored.writeStream.foreachBatch(write).outputMode("append")
    return writer.option("checkpointLocation", folders.checkpoint).trigger(**trigger).start()


def compact_run(spark: SparkSession, folders: RunFolders, keep_open: int = KEEP_OPEN) -> None:
    """Fold the old batches of a run's tables: one count per window and probability, one row per key, all progress rows."""

    def added(cells: DataFrame) -> DataFrame:
        counted = cells.groupBy("capture_day", "capture_start", PROBABILITY)
        return counted.agg(F.sum("n").alias("n"), F.max(BATCH).alias(BATCH))

    compact(spark, folders.table("cells"), added, partition_by=["capture_day"], keep_open=keep_open)
    compact(spark, folders.table("progress"), key=[BATCH], keep_open=keep_open)
    for name in ("windows", "predictions", "alerts"):
        compact_upserted(spark, folders.table(name), keep_open=keep_open)


def first_capture(spark: SparkSession, folders: RunFolders, fresh: DataFrame, batch_id: int) -> datetime | None:
    """Start of the run's first capture window, kept from the first micro-batch that has one."""
    earlier = read_progress(spark, folders).where((F.col(BATCH) < batch_id) & F.col("first_capture").isNotNull())
    known = earlier.orderBy(BATCH).first()
    return known["first_capture"] if known else fresh.agg(F.min("capture_start")).first()[0]


def write_progress(
    batch: DataFrame, ts: str, folders: RunFolders, batch_id: int, watermark: str, options: dict
) -> None:
    """One row per micro-batch: rows, captured rows, late rows, first capture and latest time."""
    spark = batch.sparkSession
    latest = None
    if batch_id > 0:
        latest = read_progress(spark, folders).where(F.col(BATCH) < batch_id).agg(F.max("latest")).first()[0]
    length = F.make_dt_interval(secs=F.lit(options["window_seconds"]))
    end = F.col("capture_start") + length
    late = F.lit(False) if latest is None else end <= F.lit(latest) - F.expr(f"INTERVAL {watermark}")
    captured = captured_records(batch, ts, **options)
    counts = captured.agg(F.count(F.lit(1)), F.count_if(late), F.min("capture_start")).first()
    rows = batch.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(ts).alias("latest"),
        F.lit(counts[0]).cast("long").alias("captured_rows"),
        F.lit(counts[1]).cast("long").alias("late_rows"),
        F.lit(counts[2]).cast("timestamp").alias("first_capture"),
    )
    path = batch_path(folders.table("progress"), batch_id)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_progress(spark: SparkSession, folders: RunFolders) -> DataFrame:
    """The progress of all micro-batches so far; rows that came late are counted, none is lost."""
    return read_table(spark, folders.table("progress"))


def run_metrics(query: StreamingQuery) -> list[dict]:
    """Rows and rows per second of the micro-batches a query still reports."""
    return [
        {
            "batch_id": p["batchId"],
            "rows": p["numInputRows"],
            "rows_per_second": p.get("processedRowsPerSecond"),
            "seconds": p["durationMs"].get("triggerExecution", 0) / 1000,
        }
        for p in query.recentProgress
    ]
