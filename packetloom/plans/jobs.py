"""Jobs: train, extract, score, compare, replay, calibrate, and the run of all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.contract import (
    DEFAULT_MIN_RECORDS,
    DEFAULT_RATIO_THRESHOLD,
    DEFAULT_RECORD_THRESHOLD,
    FILE_METADATA_FIELDS,
    SOURCE_FILE,
    WINDOW_METADATA_FIELDS,
    Thresholds,
    merge_fields,
    requested_fields,
    resolve_thresholds,
    source_names,
)
from packetloom.functions.text import joined
from packetloom.functions.time import iso_text
from packetloom.operators.calibrate import BASELINE_MARGIN, BASELINE_QUANTILE, MAX_RATIO_THRESHOLD, baseline
from packetloom.operators.distribution import distinct_rank, with_record_index
from packetloom.operators.profile import (
    NUMERIC_THRESHOLD,
    class_distribution,
    column_profile,
    compare_profiles,
    describe,
    drift_lists,
    feature_coverage,
)
from packetloom.operators.shape import metadata_columns, unsupported_fields
from packetloom.operators.summary import (
    PROBABILITY,
    cap_rows,
    file_summary,
    probability_summary,
    restrict,
    summary_rows,
    with_label_text,
    with_record_label,
    with_window_label,
)
from packetloom.operators.training import (
    MIN_CATEGORY_COUNT,
    TARGET,
    Bundle,
    TreeSettings,
    fit_bundle,
    load_bundle,
    prepare_training_frame,
    save_bundle,
)
from packetloom.session import configure, materialise
from packetloom.sinks.tables import RunFolders, append_predictions, append_summary, record_predictions, write_table
from packetloom.sources.csv import FILE_ORDER, QUOTING, first_files, header_or_default, ingest, list_files, read_csv, read_many
from packetloom.sources.tables import baseline_thresholds, read_summary
from packetloom.streaming.window_job import TRIGGER, start_window_scoring


@dataclass(frozen=True)
class TrainOptions:
    """Training options; the defaults are fixed values."""

    sample_rows: int | None = None
    keep_duplicates: bool = False
    keep_identity_payload: bool = False
    numeric_threshold: float = NUMERIC_THRESHOLD
    min_category_count: int = MIN_CATEGORY_COUNT
    max_categories: int | None = None  # if given, only so many categories of a column have their own feature
    threshold_strategy: str = "fixed"
    fixed_threshold: float = DEFAULT_RECORD_THRESHOLD
    min_precision: float = 0.0
    file_max_threshold: float = DEFAULT_RECORD_THRESHOLD
    file_ratio_threshold: float = DEFAULT_RATIO_THRESHOLD
    min_records: int = DEFAULT_MIN_RECORDS
    trees: TreeSettings = TreeSettings()


@dataclass(frozen=True)
class TrainResult:
    bundle: Bundle
    report: DataFrame
    classes: DataFrame


def train(spark: SparkSession, raw: DataFrame, model_path: str | None, options: TrainOptions = TrainOptions()) -> TrainResult:
    """Labelled text rows to a stored bundle, with the training report and the class distribution."""
    configure(spark)
    if options.sample_rows is not None:
        raw = raw.limit(options.sample_rows)
    typed, contract = prepare_training_frame(
        raw,
        keep_identity_payload=options.keep_identity_payload,
        numeric_threshold=options.numeric_threshold,
        drop_duplicates=not options.keep_duplicates,
    )
    bundle = fit_bundle(
        typed,
        contract,
        settings=options.trees,
        min_category_count=options.min_category_count,
        max_categories=options.max_categories,
        threshold_strategy=options.threshold_strategy,
        fixed_threshold=options.fixed_threshold,
        min_precision=options.min_precision,
        file_max_threshold=options.file_max_threshold,
        file_ratio_threshold=options.file_ratio_threshold,
        min_records=options.min_records,
    )
    if model_path:
        save_bundle(bundle, model_path, spark)
    return TrainResult(bundle, contract.report(spark), class_distribution(typed, TARGET))


def extract(
    spark: SparkSession, folder: str, output: str, *, template_csv: str | None = None, pattern: str = "*.csv"
) -> DataFrame:
    """Align every readable file of a folder to the requested columns and store them; returns the report per file."""
    configure(spark)
    requested = header_or_default(spark, template_csv)
    rows, report = ingest(spark, folder, requested, pattern=pattern)
    # Quotes are doubled, as every reader here expects them.
    writer = rows.write.mode("overwrite").option("header", "true").option("escape", '"')
    writer.partitionBy(SOURCE_FILE).csv(output)
    return report


def read_extracted(spark: SparkSession, folder: str) -> DataFrame:
    """The table that extract stored, with its source_file column."""
    names = header_or_default(spark, None)
    first = list_files(spark, folder, "*.csv", recursive=True).select("path").first()["path"]
    header = header_or_default(spark, first, names)
    schema = ", ".join(f"`{n}` string" for n in [*header, SOURCE_FILE])
    return spark.read.schema(schema).options(header="true", **QUOTING).csv(folder)


@dataclass(frozen=True)
class ScoreResult:
    predictions: DataFrame
    summary: DataFrame
    distribution: DataFrame
    coverage: DataFrame


def score(
    spark: SparkSession,
    bundle: Bundle,
    raw: DataFrame,
    output: str | None = None,
    thresholds: Thresholds = Thresholds(),
) -> ScoreResult:
    """Record predictions and file summary for raw rows with a source_file column.

    Scored rows are stored once and feed all results.
    """
    configure(spark)
    rule = resolve_thresholds(thresholds, bundle.contract.thresholds)
    metadata = metadata_columns(raw, FILE_METADATA_FIELDS)
    scored = materialise(with_record_label(bundle.score(raw, metadata), rule.record), "scored")
    predictions = record_predictions(scored, [SOURCE_FILE], metadata)
    summary = file_summary(scored, rule)
    if output:
        write_table(predictions, f"{output}/predictions")
        write_table(summary, f"{output}/summary")
    return ScoreResult(predictions, summary, describe(scored, PROBABILITY), feature_coverage(raw, bundle.contract))


def compare(
    spark: SparkSession,
    training: DataFrame,
    local: DataFrame,
    output: str | None = None,
    *,
    training_order: Sequence[str],
    local_order: Sequence[str],
    prefixes: tuple[str, str] = ("edge", "local"),
) -> tuple[DataFrame, DataFrame]:
    """Profiles of two datasets side by side, and the lists of columns that differ."""
    configure(spark)
    hidden = {*FILE_ORDER, "_order"}
    columns = [c for c in merge_fields(training.columns, local.columns) if c not in hidden]
    report = compare_profiles(
        column_profile(training, columns, prefixes[0], training_order),
        column_profile(local, columns, prefixes[1], local_order),
        prefixes,
    )
    if output:
        write_table(report, output)
    return report, drift_lists(report, prefixes)


@dataclass(frozen=True)
class ReplayResult:
    summary: DataFrame
    predictions: DataFrame


def replay(
    spark: SparkSession,
    bundle: Bundle,
    folder: str,
    output: str | None = None,
    *,
    pattern: str = "*.csv",
    recursive: bool = False,
    max_files: int | None = None,
    rows_per_file: int | None = None,
    predicate: str | None = None,
    include_metadata: bool = True,
    thresholds: Thresholds = Thresholds(),
    baseline_path: str | None = None,
) -> ReplayResult:
    """Score a folder of recorded files: each is one window, numbered in file order, all in one job."""
    configure(spark)
    rule = resolve_thresholds(thresholds, baseline_thresholds(spark, baseline_path), bundle.contract.thresholds)
    files = list_files(spark, folder, pattern, recursive, with_empty=True).select("_file", "path", "name")
    chosen = first_files(files, max_files) if max_files else None
    if chosen is not None:
        files = files.where(F.col("path").isin(chosen))
    raw = read_many(spark, folder, pattern=pattern, recursive=recursive, only=chosen, file_order=True)
    wanted = requested_fields(bundle.contract, include_metadata)
    missing = unsupported_fields(wanted, raw.columns)
    kept = restrict(raw, predicate)
    if rows_per_file:
        kept = cap_rows(kept, ["_file"], FILE_ORDER, rows_per_file)
    metadata = metadata_columns(kept, WINDOW_METADATA_FIELDS) if include_metadata else []
    started = F.current_timestamp()
    scored = with_record_label(bundle.score(kept, [*FILE_ORDER, *metadata]), rule.record)
    scored = with_record_index(materialise(scored, "replayed"), ["_file"], FILE_ORDER, block=["_block"])
    # Files without rows are windows, too.
    numbered = distinct_rank(files, "_file", "window_id").join(files, "_file")
    windows = numbered.join(probability_summary(scored, ["_file"], rule.record), "_file", "left")
    zeros = {c: 0 for c in ("records", "attack_records")}
    measures = [c for c in windows.columns if c.endswith("_probability") or c == "attack_record_ratio"]
    labelled = with_window_label(windows.na.fill({**zeros, **{m: 0.0 for m in measures}}), rule)
    now = iso_text(started)
    summary = summary_rows(
        labelled.withColumns(
            {"interface": F.col("name"), "source_path": F.col("path"), "raw_csv_path": F.col("path")}
        ),
        rule,
        {"window_start": now, "window_end": now, "unsupported_tshark_fields": joined(missing)},
    )
    predictions = record_predictions(
        scored.join(numbered.select("_file", "window_id"), "_file"), ["window_id", "record_index"], metadata
    )
    if output:
        append_summary(summary, f"{output}/window_predictions")
        append_predictions(predictions, f"{output}/packet_predictions")
    return ReplayResult(with_label_text(summary), predictions)


def calibrate(
    spark: SparkSession,
    summary: DataFrame,
    rule: Thresholds,
    output: str | None = None,
    *,
    model_path: str = "",
    quantile: float = BASELINE_QUANTILE,
    margin: float = BASELINE_MARGIN,
    max_ratio_threshold: float = MAX_RATIO_THRESHOLD,
) -> DataFrame:
    """Calibration document from window summaries of benign traffic."""
    configure(spark)
    document = baseline(
        summary, rule, model_path=model_path, quantile=quantile, margin=margin, max_ratio_threshold=max_ratio_threshold
    )
    if output:
        document.coalesce(1).write.mode("overwrite").json(output)
    return document


def calibrate_on_benign(
    spark: SparkSession, bundle: Bundle, folder: str, output: str, *, thresholds: Thresholds = Thresholds(), **options
) -> DataFrame:
    """Replay benign files, store their windows with label 0, and calibrate on them."""
    rule = resolve_thresholds(thresholds, bundle.contract.thresholds)
    windows = replay(spark, bundle, folder, thresholds=thresholds, **options).summary
    benign = windows.drop("label_text").withColumn("window_pred_label", F.lit(0))
    append_summary(benign, f"{output}/baseline_windows")
    return calibrate(spark, read_summary(spark, f"{output}/baseline_windows"), rule, f"{output}/baseline")


def stream(
    spark: SparkSession,
    bundle: Bundle,
    stream_dir: str,
    folders: RunFolders,
    *,
    thresholds: Thresholds = Thresholds(),
    trigger_interval: str = TRIGGER,
    available_now: bool = False,
    **options,
):
    """Score window documents as they arrive, with the bundle's model."""
    configure(spark)
    rule = resolve_thresholds(thresholds, bundle.contract.thresholds)

    def scorer(records: DataFrame, keep: Sequence[str]) -> DataFrame:
        return bundle.score(records, keep)

    return start_window_scoring(
        spark,
        stream_dir,
        source_names(bundle.contract.feature_columns),
        scorer,
        rule,
        folders,
        trigger_interval=trigger_interval,
        available_now=available_now,
        **options,
    )


def run(
    spark: SparkSession,
    training_csv: str,
    folder: str,
    output: str,
    options: TrainOptions = TrainOptions(),
    *,
    compare_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Train, align the folder's files, score them and compare them with the training table.

    All training rows are compared unless ``compare_rows`` asks for the first ones.
    """
    configure(spark)
    trained = train(spark, read_csv(spark, training_csv), f"{output}/model", options)
    report = extract(spark, folder, f"{output}/extracted", template_csv=training_csv)
    extracted = read_extracted(spark, f"{output}/extracted")
    scored = score(spark, load_bundle(spark, f"{output}/model"), extracted, f"{output}/scored")
    ordered = read_csv(spark, training_csv, sample_rows=compare_rows).withColumn("_order", F.monotonically_increasing_id())
    local = extracted.withColumn("_order", F.monotonically_increasing_id())
    comparison, lists = compare(
        spark,
        materialise(ordered, "compare-left"),
        materialise(local, "compare-right"),
        f"{output}/comparison",
        training_order=["_order"],
        local_order=[SOURCE_FILE, "_order"],
    )
    return {
        "training_report": trained.report,
        "classes": trained.classes,
        "extract_report": report,
        "predictions": scored.predictions,
        "summary": scored.summary,
        "distribution": scored.distribution,
        "coverage": scored.coverage,
        "comparison": comparison,
        "drift_lists": lists,
    }


__all__ = [
    "ReplayResult",
    "ScoreResult",
    "TrainOptions",
    "TrainResult",
    "calibrate",
    "calibrate_on_benign",
    "compare",
    "extract",
    "read_extracted",
    "replay",
    "run",
    "score",
    "stream",
    "train",
]
