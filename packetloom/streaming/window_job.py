"""Scoring of window documents: explode, score, summarise, decide, write three keyed tables.

All steps are plans over the documents; nothing is collected. The same
functions serve a stream's micro-batch and a batch of stored documents.

The parts of a large window may come in several micro-batches. Their counts per
distinct probability are stored by micro-batch, written again if a batch is, and
a window is summarised again from all its parts whenever a batch touches it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetloom.contract import Thresholds
from packetloom.functions.time import iso_text, seconds_since_window_end
from packetloom.operators.shape import PART_SUFFIX, explode_records, stringify_records, windows_table, with_window_key
from packetloom.operators.summary import PROBABILITY, probability_summary, with_window_label
from packetloom.session import materialise
from packetloom.sinks.compaction import BATCH, COMPACT_EVERY, KEEP_OPEN, batch_path, compact, read_table, require_open
from packetloom.sinks.tables import RunFolders, compact_upserted, compaction_is_due, last_per_key, read_batch, upsert_batch
from packetloom.sources.windows import stream_documents

DOCUMENT_META = ["stream_file", "window_id", "window_start", "window_end", "interface", "source_path"]
NEWEST = ["window_end", "origin", "place"]
REASON = "window_pred_label=1"  # fixed value: text stored with an alert
TRIGGER = "5 seconds"  # fixed value: default trigger interval

# A scorer takes raw record rows and the columns to keep, and adds PROBABILITY.
Scorer = Callable[[DataFrame, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class WindowTables:
    windows: DataFrame
    predictions: DataFrame
    alerts: DataFrame


def keyed_documents(documents: DataFrame, batch_id: int) -> DataFrame:
    """Documents with clean records, their key, and an identity per document.

    Two documents may carry the same key; the identity keeps their records
    apart. The parts of one window, whose keys say so, have one identity, so
    the window's prediction does not depend on how it was cut. ``part`` is the
    key of such a part, null for a whole window, and ``copy`` tells apart the
    parts that carry one key.
    """
    placed = stringify_records(documents).withColumns(
        {"_origin": F.col("origin_file"), "_place": F.monotonically_increasing_id()}
    )
    given = placed.where(F.col("stream_file") != "")
    # Documents without a key that were read from one file, or from files of one name, are told apart by number.
    unnamed = placed.where(F.coalesce(F.col("stream_file") == "", F.lit(True)))
    number = F.row_number().over(W.partitionBy("origin_file").orderBy("_place")) - 1
    name = F.when(number == 0, F.col("origin_file")).otherwise(F.format_string("%s#%d", F.col("origin_file"), number))
    unnamed = unnamed.withColumn("origin_file", F.when(F.col("origin_file").isNotNull(), name))
    keyed = with_window_key(given.unionByName(unnamed), batch_id, F.col("origin_file"))
    part = F.col("stream_file").rlike(PART_SUFFIX)
    keyed = keyed.withColumns(
        {
            "part": F.when(part, F.col("stream_file")),
            "copy": F.struct(F.col("_origin").alias("origin"), F.col("_place").alias("place")),
            "_origin": F.when(part, "").otherwise(F.col("_origin")),
            "_place": F.when(part, -1).otherwise(F.col("_place")),
            "stream_file": F.regexp_replace("stream_file", PART_SUFFIX, ".json"),
        }
    )
    meta = F.struct(*[F.col(c) for c in DOCUMENT_META], F.col("_origin").alias("origin"), F.col("_place").alias("place"))
    return keyed.withColumn("document", meta).drop("_origin", "_place")


def score_records(documents: DataFrame, score: Scorer, keep: Sequence[str] = ("document",)) -> DataFrame:
    """document, record_index and probability; a document without records keeps one row without probability."""
    records = explode_records(documents, keep)
    scored = score(records, [*keep, "record_index"])
    return scored.withColumn(PROBABILITY, F.when(F.col("record_index").isNotNull(), F.col(PROBABILITY)))


def predictions_table(summary: DataFrame, rule: Thresholds, at: Column) -> DataFrame:
    """Window summary rows in the shape of the predictions table."""
    # Its column names, in their order.
    return with_window_label(summary, rule).select(
        F.col("stream_file").alias("_id"),
        "window_id",
        "stream_file",
        "window_start",
        "window_end",
        "interface",
        "source_path",
        F.col("records").cast("int").alias("record_count"),
        F.col("attack_records").cast("int").alias("attack_records"),
        "attack_record_ratio",
        "mean_attack_probability",
        "median_attack_probability",
        "p95_attack_probability",
        "max_attack_probability",
        F.lit(float(rule.record)).alias("record_threshold"),
        F.lit(float(rule.file_max)).alias("file_max_threshold"),
        F.lit(float(rule.file_ratio)).alias("file_ratio_threshold"),
        F.lit(int(rule.min_records)).alias("min_records"),
        "window_pred_label",
        seconds_since_window_end(F.col("window_end"), at).alias("detection_latency_seconds"),
        iso_text(at).alias("created_at"),
    )


def alerts_table(predictions: DataFrame) -> DataFrame:
    """Alerts for windows labelled as attack."""
    # The table's column names, in their order.
    return predictions.where(F.col("window_pred_label") == 1).select(
        "_id",
        "window_id",
        "stream_file",
        "window_start",
        "window_end",
        "interface",
        "source_path",
        "record_count",
        "attack_records",
        "attack_record_ratio",
        "max_attack_probability",
        "mean_attack_probability",
        F.lit(REASON).alias("reason"),
        "detection_latency_seconds",
        "created_at",
    )


def score_documents(
    documents: DataFrame,
    score: Scorer,
    rule: Thresholds,
    *,
    batch_id: int = 0,
    at: Column | None = None,
    stream_dir: str = "",
    split: bool | None = None,
) -> WindowTables:
    """The three result tables for a set of documents. ``at`` is the one time stamped on all rows."""
    at = at if at is not None else F.current_timestamp()
    keyed = keyed_documents(documents, batch_id)
    summary = probability_summary(score_records(keyed, score), ["document"], rule.record, split=split)
    windows = windows_table(keyed, iso_text(at), stream_dir, extra=["document.origin", "document.place", "part"])
    return result_tables(summary, windows, rule, at)


def result_tables(summary: DataFrame, windows: DataFrame, rule: Thresholds, at: Column) -> WindowTables:
    """Of several documents with one key the last one stands, in all tables the same; parts make one document."""
    flat = summary.select("document.*", *[c for c in summary.columns if c != "document"])
    predictions = predictions_table(last_per_key(flat, "stream_file", NEWEST), rule, at)
    whole = F.sum("record_count").over(W.partitionBy("_id", "window_end", "origin", "place")).cast("int")
    windows = windows.withColumn("record_count", whole)
    first = W.partitionBy("_id").orderBy(*[F.col(c).desc() for c in NEWEST], F.col("part").asc())
    windows = windows.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return WindowTables(windows.drop("origin", "place", "part", "_n"), predictions, alerts_table(predictions))


# ------------------------------------------------- parts over several batches


def write_parts(parts: DataFrame, score: Scorer, folders: RunFolders, batch_id: int, at: Column, stream_dir: str) -> None:
    """Store the parts that came in one micro-batch: a row of the windows table each, and their counts."""
    day = F.coalesce(F.substring("document.window_start", 1, 10), F.lit("")).alias("window_day")
    key = ["document", "part", "copy"]
    cells = score_records(parts, score, key).groupBy(*key, PROBABILITY).agg(F.count(F.lit(1)).alias("n"))
    rows = windows_table(parts, iso_text(at), stream_dir, extra=key)
    for name, table in (("part_cells", cells), ("parts", rows)):
        require_open(parts.sparkSession, folders.table(name), batch_id)
        writer = table.select("*", day).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("window_day").parquet(batch_path(folders.table(name), batch_id))


def known_parts(spark: SparkSession, folders: RunFolders, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Rows and counts of all parts so far of the windows that a batch touches; of one part the newest copy."""

    def stored(name: str) -> DataFrame:
        every = read_table(spark, folders.table(name), upto=batch_id)
        return every.withColumn("window_day", F.col("window_day").cast("string"))

    rows = stored("parts")
    touched = rows.where(F.col(BATCH) == batch_id).select("window_day", "document").distinct()
    same = ["window_day", "document"]
    newest = W.partitionBy("document", "part").orderBy(F.col(BATCH).desc(), F.col("copy").desc())
    rows = rows.join(touched, same, "left_semi").withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    rows = materialise(rows, "window-parts")
    standing = rows.select(*same, "part", "copy", BATCH)
    return rows, stored("part_cells").join(standing, standing.columns, "left_semi")


def score_batch(
    documents: DataFrame, score: Scorer, rule: Thresholds, folders: RunFolders, batch_id: int, at: Column, stream_dir: str
) -> WindowTables:
    """The result tables of a micro-batch; parts are put together with those of earlier ones."""
    keyed = keyed_documents(documents, batch_id)
    parts = keyed.where(F.col("part").isNotNull())
    if parts.isEmpty():
        return score_documents(documents, score, rule, batch_id=batch_id, at=at, stream_dir=stream_dir)
    write_parts(parts, score, folders, batch_id, at, stream_dir)
    rows, cells = known_parts(documents.sparkSession, folders, batch_id)
    whole = keyed.where(F.col("part").isNull())
    summary = probability_summary(score_records(whole, score), ["document"], rule.record)
    summary = summary.unionByName(probability_summary(cells, ["document"], rule.record, weight="n"))
    extra = ["document.origin", "document.place", "part"]
    windows = windows_table(whole, iso_text(at), stream_dir, extra=extra)
    rows = rows.withColumn("ingested_at", iso_text(at)).select("*", *extra[:2])
    return result_tables(materialise(summary, "windows"), windows.unionByName(rows.select(*windows.columns)), rule, at)


def compact_run(spark: SparkSession, folders: RunFolders, keep_open: int = KEEP_OPEN) -> None:
    """Fold the old batches of a run's tables; stored parts keep the number of the batch that they came with."""
    for name in ("windows", "predictions", "alerts"):
        compact_upserted(spark, folders.table(name), keep_open=keep_open)
    for name in ("parts", "part_cells"):
        compact(spark, folders.table(name), partition_by=["window_day"], keep_open=keep_open)


def batch_writer(
    score: Scorer, rule: Thresholds, folders: RunFolders, stream_dir: str = "", compact_every: int = COMPACT_EVERY
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function: writes windows, predictions and alerts of one micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if kept.isEmpty():
                return
            at = F.lit(datetime.now(timezone.utc).replace(microsecond=0))
            tables = score_batch(kept, score, rule, folders, batch_id, at, stream_dir)
            upsert_batch(tables.windows, folders.table("windows"), batch_id)
            upsert_batch(tables.predictions, folders.table("predictions"), batch_id)
            # Alerts come from the rows just stored, so nothing is scored twice.
            spark = kept.sparkSession
            stored = read_batch(spark, folders.table("predictions"), batch_id)
            upsert_batch(alerts_table(stored), folders.table("alerts"), batch_id)
            if compaction_is_due(batch_id, compact_every):
                compact_run(spark, folders)
        finally:
            kept.unpersist()

    return write


def start_window_scoring(
    spark: SparkSession,
    stream_dir: str,
    fields: Sequence[str],
    score: Scorer,
    rule: Thresholds,
    folders: RunFolders,
    *,
    trigger_interval: str = TRIGGER,
    available_now: bool = False,
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start the scoring stream. ``available_now`` handles what is there and stops.

    Every ``compact_every`` batches the old ones are folded into the tables' bases.
    """
    documents = stream_documents(
        spark, stream_dir, fields, multi_line=multi_line, max_files_per_trigger=max_files_per_trigger
    )
    writer = (
        documents.writeStream.foreachBatch(batch_writer(score, rule, folders, stream_dir, compact_every))
        .option("checkpointLocation", folders.checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": trigger_interval}
    return writer.trigger(**trigger).start()
