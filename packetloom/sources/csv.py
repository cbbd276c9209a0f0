"""CSV scans: explicit all-text schema, clean headers, provenance."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.contract import PACKET_COLUMNS, SOURCE_FILE, spark_name, spark_names
from packetloom.operators.shape import align_extract, union_by_name, unique_names
from packetloom.session import materialise

# Up to this many files, each first line is fetched by a job that reads one split.
HEADERS_BY_FILE = 64
SPLIT_BYTES = 128 << 20  # files up to this size are one task's work anyway
HEAD_BYTES = 16 << 10  # of a file that one read fetches; longer first lines take more reads
CORRUPT = "_corrupt_record"
# A quote inside a quoted field is doubled, as the csv module and pandas write it. Whole lines are parsed: a parser that
# skips columns loses its place after a field that ends in a doubled quote, and does not notice broken lines.
QUOTING = {"quote": '"', "escape": '"', "columnPruning": "false"}
FILE_ORDER = ["_file", "_block", "_row"]


def file_name_column() -> Column:
    """Plain base name of the file read; Spark gives it URL-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def list_files(
    spark: SparkSession, folder: str, pattern: str = "*.csv", recursive: bool = False, *, with_empty: bool = False
) -> DataFrame:
    """(_file, path, name) of the files that match, without reading them. Raises if there are none.

    ``_file`` is the identity of a file beside its rows. Spark plans no scan
    for files of zero bytes; ``with_empty`` adds them from its file index,
    which takes a call per file.
    """

    def reader(file_format: str) -> DataFrame:
        options = {"pathGlobFilter": pattern, "recursiveFileLookup": str(recursive).lower()}
        return spark.read.format(file_format).options(**options).load(folder)

    listed = reader("binaryFile").select(F.col("_metadata.file_path").alias("_file"), "path")
    if with_empty:
        names = [(f.replace("file:///", "file:/"),) for f in reader("text").inputFiles()]
        indexed = spark.createDataFrame(names, "_file string")
        path = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B"))).alias("path")
        listed = listed.unionByName(indexed.join(listed, "_file", "left_anti").select("_file", path))
    if listed.isEmpty():
        raise FileNotFoundError(f"no files match {pattern} in {folder}")
    return listed.withColumn("name", F.element_at(F.split("path", "/"), -1))


def first_files(listed: DataFrame, cap: int) -> list[str]:
    """Paths of the first ``cap`` files in sorted order; ``cap`` is what the caller asked for."""
    return [r["path"] for r in listed.select("path").orderBy("path").limit(cap).collect()]


def literal_path(path: str) -> str:
    """A listed path as a pattern that matches itself alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def parse_header(line: str) -> list[str]:
    return next(csv.reader([line]), [])


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Field names in the first line of a file; reads no more than one split."""
    first = spark.read.text(literal_path(path)).first()
    return parse_header(first["value"]) if first else []


def header_or_default(spark: SparkSession, path: str | None, default: Sequence[str] = PACKET_COLUMNS) -> list[str]:
    """Clean distinct field names of a CSV header, or the default fields without a file."""
    if path is not None:
        try:
            header = header_of(spark, path)
        except Exception as error:  # Spark raises an analysis error for a path that does not exist
            if "PATH_NOT_FOUND" not in str(error):
                raise
            header = []
        if header:
            return list(dict.fromkeys(spark_names(header)))
    return spark_names(default)


def _read(
    spark: SparkSession, paths: str | list[str], header: Sequence[str], **options: str
) -> DataFrame:
    names = unique_names(header)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema.add(CORRUPT, T.StringType())).option("header", "true")
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(**QUOTING, **options).csv([literal_path(p) for p in ([paths] if isinstance(paths, str) else paths)])


def quoted_lines(lines: DataFrame) -> DataFrame:
    """Add ``_record`` to lines (_file, _block, _row, value): the number in its file of the record that a line belongs to.

    A line starts a record if the quotes before it in its file are even, which
    doubled quotes inside a field do not change. Quotes are counted per line,
    summed per block, and the blocks' sums are put before those inside a block,
    so a file is spread over as many tasks as it has blocks.
    """
    counted = lines.withColumn("_quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    # One row per block of a file.
    blocks = counted.groupBy("_file", "_block").agg(F.sum("_quotes").alias("_in"))
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_file", "_block").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    placed = counted.join(blocks, ["_file", "_block"])
    before = F.col("_before") + F.coalesce(F.sum("_quotes").over(inside), F.lit(0))
    starts = placed.withColumn("_start", (before % 2 == 0).cast("int")).drop("_quotes", "_before")
    # Lines that start a record, again summed per block and then inside.
    per_block = starts.groupBy("_file", "_block").agg(F.sum("_start").alias("_in"))
    per_block = per_block.select("_file", "_block", F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_before"))
    upto = W.partitionBy("_file", "_block").orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = starts.join(per_block, ["_file", "_block"]).withColumn("_record", F.col("_before") + F.sum("_start").over(upto) - 1)
    return numbered.drop("_before")


def read_split_records(spark: SparkSession, paths: list[str], header: Sequence[str]) -> DataFrame:
    """What _read gives for fields with line breaks, by several tasks a file; the place columns stand beside it.

    Lines end with a line feed, with or without a carriage return before it.
    Records of one line, nearly all, are parsed where they lie; only the lines
    of longer ones are brought together.
    """
    names = unique_names(header)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    text = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths])
    lines = text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        file_name_column().alias(SOURCE_FILE),
        "value",
    )
    # The numbers of rows must not change between the counts and their use.
    lines = quoted_lines(materialise(lines, "lines"))
    split = lines.where("_start = 0").select("_file", "_record").distinct()
    several = lines.join(split, ["_file", "_record"], "left_semi")
    single = lines.join(split, ["_file", "_record"], "left_anti").select("_file", "_block", "_row", SOURCE_FILE, "_record", "value")
    joined = several.groupBy("_file", "_record").agg(
        F.min(F.struct("_block", "_row")).alias("_at"),
        F.first(SOURCE_FILE).alias(SOURCE_FILE),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_row", "value"))), lambda p: p["value"]), "\n").alias("value"),
    )
    joined = joined.select("_file", "_at._block", "_at._row", SOURCE_FILE, "_record", "value")
    records = single.unionByName(joined).where("_record > 0").withColumn("value", F.regexp_replace("value", "\r$", ""))
    options = {**QUOTING, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.where(F.trim("value") != "").withColumn("_parsed", F.from_csv("value", schema.simpleString(), options))
    return parsed.select("_parsed.*", SOURCE_FILE, *FILE_ORDER)


def _columns(header: Sequence[str]) -> list[str]:
    return [n for n in unique_names(header) if not n.startswith("_repeat_")]


def needs_splits(spark: SparkSession, paths: list[str]) -> bool:
    """Whether a file is too long for the reader that takes a file with quoted line breaks in one task. Reads no content."""
    sizes = spark.read.format("binaryFile").load([literal_path(p) for p in paths]).select("length")
    return (sizes.agg(F.max("length")).first()[0] or 0) > SPLIT_BYTES


def _placed(spark: SparkSession, paths: list[str], header: Sequence[str], multi_line: bool) -> DataFrame:
    """The clean columns, the file name, and columns that sort rows as they stand in the files."""
    if multi_line and needs_splits(spark, paths):
        return read_split_records(spark, paths, header).select(*_columns(header), SOURCE_FILE, *FILE_ORDER)
    # Ids grow inside a split, and splits are ordered by where they begin.
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    row = F.monotonically_increasing_id().alias("_row")
    scan = _read(spark, paths, header, multiLine=str(multi_line).lower())
    return scan.select(*_columns(header), file_name_column().alias(SOURCE_FILE), *place, row)


def read_csv(spark: SparkSession, path: str, *, sample_rows: int | None = None, multi_line: bool = False) -> DataFrame:
    """One CSV as text columns with clean names; the first of repeated columns is kept.

    ``sample_rows`` takes the first rows as they stand in the file, the same
    ones on any cluster; each task keeps as many. ``multi_line`` allows line
    breaks inside quotes, also in files of several splits.
    """
    header = header_of(spark, path)
    placed = _placed(spark, [path], header, multi_line)
    if sample_rows is None:
        return placed.drop(SOURCE_FILE, *FILE_ORDER)
    return placed.drop(SOURCE_FILE).orderBy(*FILE_ORDER).limit(sample_rows).drop(*FILE_ORDER)


def first_lines(listed: DataFrame, head_bytes: int = HEAD_BYTES) -> DataFrame:
    """(path, line) of the first line of each listed file, null where a task cannot open the file by itself.

    Tasks open the files and read their first bytes, so what is read does not
    depend on how long the files are. An empty file has an empty line.
    """

    def read_heads(batches):
        import re
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        plain = "".join(map(chr, range(33, 127)))
        end = re.compile(rb"[\r\n]")

        def first_line(uri: str) -> str | None:
            try:
                system, place = fs.FileSystem.from_uri(quote(uri, safe=plain))
                with system.open_input_stream(place, compression="detect", buffer_size=0) as stream:
                    head = b""
                    while not end.search(head):
                        more = stream.read(head_bytes)
                        if not more:
                            break
                        head += more
            except (OSError, pa.ArrowException):
                return None  # a store that only Spark reads
            return end.split(head, maxsplit=1)[0].decode("utf-8", errors="replace")

        for b in batches:
            lines = [first_line(uri) for uri in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lines, pa.string())], names=["path", "line"])

    # Paths as Spark lists them are unescaped; the identity beside a row is the escaped form that a file system takes.
    cores = listed.sparkSession.sparkContext.defaultParallelism
    return listed.select("path", "_file").repartition(4 * cores).mapInArrow(read_heads, "path string, line string")


def file_headers(spark: SparkSession, folder: str, pattern: str, recursive: bool = False) -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it.

    A few files are asked one by one. Of many, tasks read the heads; where
    they cannot open a file by themselves, one pass over its text finds the
    first line, and per file only one line survives the map side.
    """
    listed = list_files(spark, folder, pattern, recursive)
    some = first_files(listed, HEADERS_BY_FILE + 1)
    groups: dict[tuple[str, ...], list[str]] = {}
    if len(some) <= HEADERS_BY_FILE:
        for path in some:
            groups.setdefault(tuple(header_of(spark, path)), []).append(path)
        return groups
    heads = materialise(first_lines(listed), "heads")
    unread = heads.where(F.col("line").isNull())
    if not unread.isEmpty():
        lines = (
            spark.read.option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(recursive).lower())
            .text(folder)
            .where(F.col("_metadata.file_block_start") == 0)
            .select(F.col("_metadata.file_path").alias("_file"), "value", F.monotonically_increasing_id().alias("row"))
        )
        first = lines.groupBy("_file").agg(F.min_by("value", "row").alias("line"))
        found = listed.join(first, "_file", "left").join(unread.select("path"), "path", "left_semi").select("path", "line")
        heads = heads.where(F.col("line").isNotNull()).unionByName(found)
    # File names and headers are what Spark's own file index keeps on the driver, too.
    for r in heads.orderBy("path").toLocalIterator():
        groups.setdefault(tuple(parse_header(r["line"]) if r["line"] else []), []).append(r["path"])
    return groups


def read_many(
    spark: SparkSession,
    folder: str,
    *,
    pattern: str = "*.csv",
    recursive: bool = False,
    max_files: int | None = None,
    only: Sequence[str] | None = None,
    file_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """All matching CSVs, united by column name, with the file name as source_file.

    Files with the same header are read together. ``only`` names the paths to
    take, ``max_files`` takes the first ones that have a header. ``file_order``
    adds columns that sort rows as they stand in the files. ``multi_line``
    allows line breaks inside quotes, also in files of several splits.
    """
    groups = file_headers(spark, folder, pattern, recursive)
    if only is not None:
        groups = {h: [p for p in paths if p in set(only)] for h, paths in groups.items()}
    if max_files:
        kept = set(sorted(p for paths in groups.values() for p in paths)[:max_files])
        groups = {h: [p for p in paths if p in kept] for h, paths in groups.items()}
    frames = []
    for header, paths in groups.items():
        if not header or not paths:
            continue
        placed = _placed(spark, paths, header, multi_line)
        frames.append(placed if file_order else placed.drop(*FILE_ORDER))
    if not frames:
        raise ValueError(f"the files that match {pattern} in {folder} have no header")
    return union_by_name(frames)


def read_window_csv(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """One window's CSV with the contract fields; an empty file gives no rows."""
    header = header_of(spark, path)
    names = spark_names(fields)
    if not header:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return align_extract(_read(spark, path, header).select(*_columns(header)), names, blank_labels=False)


def ingest(
    spark: SparkSession,
    folder: str,
    requested: Sequence[str],
    *,
    pattern: str = "*.csv",
    recursive: bool = False,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Read every file that can be read: (aligned rows, report).

    The report has one row per listed file: rows, corrupt_rows and status. A
    file fails if its header has none of the requested fields or it cannot be
    read; the other files go on.
    """
    names = spark_names(requested)
    groups = file_headers(spark, folder, pattern, recursive)
    usable = {h: paths for h, paths in groups.items() if set(spark_names(h)) & set(names)}
    located = list_files(spark, folder, pattern, recursive, with_empty=True)
    listed = located.select("_file", F.col("name").alias(SOURCE_FILE))
    if not usable:
        none = F.lit(0).cast("bigint")
        report = listed.select(SOURCE_FILE, none.alias("rows"), none.alias("corrupt_rows"), F.lit("failed").alias("status"))
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in [*names, SOURCE_FILE])), report
    frames = []
    for header, paths in usable.items():
        if multi_line and needs_splits(spark, paths):
            raw = read_split_records(spark, paths, header).select(*_columns(header), CORRUPT, SOURCE_FILE, "_file")
        else:
            options = {"ignoreCorruptFiles": "true", "multiLine": str(multi_line).lower()}
            raw = _read(spark, paths, header, **options).select(
                *_columns(header), CORRUPT, file_name_column().alias(SOURCE_FILE), F.col("_metadata.file_path").alias("_file")
            )
        frames.append(align_extract(raw, [*names, CORRUPT, SOURCE_FILE, "_file"]))
    # Parsed once: both the rows and the counts come from the stored table.
    rows = materialise(union_by_name(frames), "ingested")
    counted = rows.groupBy("_file").agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("rows"), F.count(CORRUPT).alias("corrupt_rows")
    )
    # A usable file without any row is fine if only its header could be read.
    paths = [p for found in usable.values() for p in found]
    readable = spark.createDataFrame([(p,) for p in paths], "path string").withColumn("readable", F.lit(True))
    report = (
        listed.join(located.join(readable, "path").select("_file", "readable"), "_file", "left")
        .join(counted, "_file", "left")
        .select(
            SOURCE_FILE,
            F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("corrupt_rows", F.lit(0)).alias("corrupt_rows"),
            F.when(F.col("readable").isNull(), "failed")
            .when(F.coalesce("corrupt_rows", F.lit(0)) == 0, "ok")
            .when(F.col("rows") > 0, "partial")
            .otherwise("failed")
            .alias("status"),
        )
    )
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file"), report
