"""Projections: header hygiene, contract alignment, window documents, nested columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.contract import (
    IDENTITY_PAYLOAD_COLUMNS,
    LABEL_COLUMNS,
    SOURCE_FILE,
    FeatureContract,
    feature_columns,
    spark_name,
    spark_names,
    split_supported,
)
from packetloom.functions.text import text_or_blank
from packetloom.functions.time import fallback_window_key, iso_text, window_key
from packetloom.operators.distribution import ROWS_PER_TASK, fits_one_task, join_null_safe, with_record_index
from packetloom.operators.typing import type_columns

PREVIEW_LIMIT = 25
RECORDS_PER_DOCUMENT = 100_000
PART_SUFFIX = r"_part\d+\.json$"  # of the key of a document that holds a part of a window


# ------------------------------------------------------------------- headers


def unique_names(names: Sequence[str]) -> list[str]:
    """Clean names, with throw-away names in the places of repeated columns.

    Fields whose names differ only by a dot or an underscore are two columns;
    the second one is numbered.
    """
    taken: dict[str, str] = {}
    seen: set[str] = set()
    result = []
    for i, (name, clean) in enumerate(zip((n.replace("\ufeff", "").strip() for n in names), spark_names(names))):
        if name in seen:
            result.append(f"_repeat_{i}")
            continue
        seen.add(name)
        number, free = 2, clean
        while free in taken:
            free, number = f"{clean}_{number}", number + 1
        taken[free] = name
        result.append(free)
    return result


def normalize_columns(df: DataFrame) -> DataFrame:
    """Clean column names and keep the first of each repeated name."""
    names = unique_names(df.columns)
    kept = [n for n in names if not n.startswith("_repeat_")]
    return df.toDF(*names).select(*kept)


def drop_identity_payload(df: DataFrame, keep: bool = False) -> DataFrame:
    return df if keep else df.drop(*spark_names(IDENTITY_PAYLOAD_COLUMNS))


def select_features(df: DataFrame) -> DataFrame:
    return df.select(*feature_columns(df.columns))


# ----------------------------------------------------------------- alignment


def align_to_contract(df: DataFrame, contract: FeatureContract, keep: Sequence[str] = ()) -> DataFrame:
    """Typed feature columns in contract order, plus provenance and columns to keep.

    Missing features are null before typing; a frame without provenance gets "unknown".
    """
    source = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else F.lit("unknown")
    kept = [c for c in keep if c in df.columns and c != SOURCE_FILE]
    # A kept column that is also a feature stays available as text under another name.
    names = [f"raw_{c}" if c in contract.feature_columns else c for c in kept]
    extra = df.select(
        "*", source.alias("_source"), *[F.col(c).alias(n) for c, n in zip(kept, names) if n != c]
    )
    typed_rows = type_columns(extra, contract.numeric_columns, contract.feature_columns, keep=["_source", *names])
    return typed_rows.withColumnRenamed("_source", SOURCE_FILE)


def align_extract(df: DataFrame, requested: Sequence[str], *, blank_labels: bool = True) -> DataFrame:
    """Requested columns in order, absent ones as blank text, label columns blanked."""
    labels = set(spark_names(LABEL_COLUMNS)) | set(LABEL_COLUMNS)

    def value(name: str) -> Column:
        if name not in df.columns or (blank_labels and name in labels):
            return F.lit("").alias(name)
        return F.col(name)

    return df.select(*[value(c) for c in requested])


def unsupported_fields(requested: Sequence[str], available: Sequence[str] | None) -> Column:
    """The requested fields a source lacks, sorted, as an array column."""
    _, missing = split_supported(requested, available)
    return F.lit(missing) if missing else F.array().cast("array<string>")


def metadata_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Which of the metadata columns the frame has, in the given order."""
    return [c for c in spark_names(names) if c in df.columns]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("there are no frames to unite")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


# ---------------------------------------------------------- window documents


def stringify_fields(names: Sequence[str], source: Sequence[str]) -> list[Column]:
    """Record fields as text with blanks for nulls; fields the source lacks are blank."""
    return [(text_or_blank(F.col(n)) if n in source else F.lit("")).alias(n) for n in names]


def window_documents(
    records: DataFrame,
    window: str,
    order_by: Sequence[str],
    fields: Sequence[str],
    *,
    window_seconds: int,
    interface: Column | None = None,
    source_path: Column | None = None,
    stream_dir: str = "",
    unsupported: Column | None = None,
    capture_filter: str = "",
    display_filter: str = "",
    window_id: Column | None = None,
    records_per_document: int = RECORDS_PER_DOCUMENT,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """One document per capture window with its records nested in row order.

    ``window`` is the window start. A document is one row and must fit in
    memory, so a window with more than ``records_per_document`` records becomes
    several documents, numbered in their keys; no record is left out, and the
    scoring of documents puts the parts of a window together again. Parts are
    cut by the record's number in its window, wherever rows are equal, and
    ``first_record`` is the number of a document's first one: the parts' records
    one after the other are those of the whole window.
    """
    position = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    record = F.struct(*stringify_fields(fields, records.columns))
    end = F.col("_window") + F.make_dt_interval(secs=F.lit(window_seconds))
    placed = records.select(F.col(window).alias("_window"), position.alias("_at"), record.alias("_record"))
    if fits_one_task(records, records_per_document):
        parted = placed.withColumns({"_part": F.lit(0), "_first": F.lit(0)})
    else:
        # The list of large windows is short; Spark sees its real size before it picks the join.
        large = placed.groupBy("_window").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > records_per_document)
        marked = join_null_safe(placed, large, ["_window"], "left")
        whole = marked.where(F.col("_n").isNull()).withColumns({"_part": F.lit(0), "_first": F.lit(0)})
        ranked = with_record_index(marked.where(F.col("_n").isNotNull()), ["_window"], ["_at", "_record"], name="_rank", limit=limit)
        part = F.floor(F.col("_rank") / records_per_document).cast("int")
        cut = ranked.withColumns({"_part": part + 1, "_first": (part * records_per_document).cast("int")})
        parted = whole.select(*placed.columns, "_part", "_first").unionByName(cut.select(*placed.columns, "_part", "_first"))
    grouped = parted.groupBy("_window", "_part", "_first").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_at").alias("o"), F.col("_record").alias("r")))).alias("_sorted")
    )
    number = window_id if window_id is not None else F.lit(0)
    suffix = F.format_string("_part%04d.json", F.col("_part"))
    whole = window_key(number, F.col("_window"))
    key = F.when(F.col("_part") > 0, F.replace(whole, F.lit(".json"), suffix)).otherwise(whole)
    return grouped.select(
        number.cast("int").alias("window_id"),
        iso_text(F.col("_window")).alias("window_start"),
        iso_text(end).alias("window_end"),
        (interface if interface is not None else F.lit("")).alias("interface"),
        (source_path if source_path is not None else F.lit("live_capture")).alias("source_path"),
        key.alias("stream_file"),
        F.concat(F.lit(stream_dir.rstrip("/") + "/" if stream_dir else ""), key).alias("stream_json_path"),
        F.lit(window_seconds).cast("int").alias("window_seconds"),
        F.size("_sorted").alias("record_count"),
        F.lit(capture_filter).alias("capture_filter"),
        F.lit(display_filter).alias("display_filter"),
        (unsupported if unsupported is not None else F.array().cast("array<string>")).alias("unsupported_tshark_fields"),
        F.transform("_sorted", lambda s: s["r"]).alias("records"),
        F.col("_first").alias("first_record"),
    )


def stringify_records(documents: DataFrame, records: str = "records") -> DataFrame:
    """Drop null entries of the record array and turn null fields into blanks."""
    element = documents.schema[records].dataType.elementType

    def clean(r: Column) -> Column:
        return F.struct(*[text_or_blank(r[f.name]).alias(f.name) for f in element.fields])

    cleaned = F.transform(F.filter(F.col(records), lambda r: r.isNotNull()), clean)
    blank = F.array().cast(T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in element.fields])))
    return documents.withColumn(records, F.coalesce(cleaned, blank))


def with_window_key(documents: DataFrame, batch_id: int, source_file: Column | None = None) -> DataFrame:
    """Set stream_file to the document key, falling back to the file read."""
    source = source_file if source_file is not None else F.lit(None).cast("string")
    return documents.withColumn("stream_file", fallback_window_key(F.col("stream_file"), source, batch_id))


def preview_columns(records: str = "records", limit: int = PREVIEW_LIMIT) -> list[Column]:
    size = F.greatest(F.size(records), F.lit(0))
    return [
        F.slice(records, 1, limit).alias("record_preview"),
        F.least(size, F.lit(limit)).alias("record_preview_count"),
        (size > limit).alias("records_truncated"),
    ]


def windows_table(
    documents: DataFrame, ingested_at: Column, stream_dir: str = "", extra: Sequence[str] = ()
) -> DataFrame:
    """Window metadata with a bounded preview of the records."""
    # The table's column names, in their order.
    default_path = F.concat(F.lit(stream_dir.rstrip("/") + "/" if stream_dir else ""), F.col("stream_file"))
    given_path = F.col("stream_json_path") if "stream_json_path" in documents.columns else F.lit(None).cast("string")
    return documents.select(
        F.col("stream_file").alias("_id"),
        "window_id",
        "window_start",
        "window_end",
        "interface",
        "source_path",
        "stream_file",
        "window_seconds",
        "record_count",
        "capture_filter",
        "display_filter",
        "unsupported_tshark_fields",
        *preview_columns(),
        F.coalesce(F.when(given_path != "", given_path), default_path).alias("stream_json_path"),
        ingested_at.alias("ingested_at"),
        *extra,
    )


def explode_records(documents: DataFrame, keep: Sequence[str], records: str = "records") -> DataFrame:
    """One row per record with its 0-based position in its window; a window without records keeps one null row."""
    element = documents.schema[records].dataType.elementType
    first = F.coalesce(F.col("first_record"), F.lit(0)) if "first_record" in documents.columns else F.lit(0)
    exploded = documents.select(*keep, first.alias("_first"), F.posexplode_outer(records).alias("_position", "_record"))
    index = (F.col("_first") + F.col("_position")).alias("record_index")
    return exploded.select(
        *keep, index, *[F.col("_record").getField(f.name).alias(spark_name(f.name)) for f in element.fields]
    )


# ------------------------------------------------------------ nested columns


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested struct fields as top-level columns named by their path; arrays stay."""

    def leaves(fields: list[T.StructField], path: list[str]) -> list[Column]:
        result = []
        for f in fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                result += leaves(f.dataType.fields, here)
            else:
                result.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return result

    return df.select(*leaves(df.schema.fields, []))
