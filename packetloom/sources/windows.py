"""Window documents: schema, batch scan and streaming scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_FIELDS = [
    T.StructField("window_id", T.IntegerType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("interface", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("stream_file", T.StringType()),
    T.StructField("stream_json_path", T.StringType()),
    T.StructField("window_seconds", T.IntegerType()),
    T.StructField("record_count", T.IntegerType()),
    T.StructField("capture_filter", T.StringType()),
    T.StructField("display_filter", T.StringType()),
    T.StructField("unsupported_tshark_fields", T.ArrayType(T.StringType())),
    T.StructField("first_record", T.IntegerType()),  # number of the first record in its window; absent means 0
]


def document_schema(fields: Sequence[str]) -> T.StructType:
    """Schema of a window document whose records have the given text fields."""
    record = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return T.StructType([*DOCUMENT_FIELDS, T.StructField("records", T.ArrayType(record))])


def with_origin(documents: DataFrame) -> DataFrame:
    """Keep the name of the file that each document came from."""
    return documents.select("*", F.col("_metadata.file_name").alias("origin_file"))


def read_documents(spark: SparkSession, folder: str, fields: Sequence[str], *, multi_line: bool = True) -> DataFrame:
    reader = spark.read.schema(document_schema(fields)).option("multiLine", str(multi_line).lower())
    return with_origin(reader.option("pathGlobFilter", "*.json").json(folder))


def stream_documents(
    spark: SparkSession,
    folder: str,
    fields: Sequence[str],
    *,
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Documents as they arrive. One JSON object per file, or per line without ``multi_line``."""
    reader = spark.readStream.schema(document_schema(fields)).option("multiLine", str(multi_line).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_origin(reader.option("pathGlobFilter", "*.json").json(folder))
