"""Token ids as Parquet files for selective reading.

A file holds the documents of one range of doc_id in ascending order: key,
part, offset of the document's first id inside the part, number of ids, and
the ids as a list column. Ids are dictionary-encoded; the ascending and small
numbers beside them are not, so that the version 2 writer delta-encodes them.
Row groups and pages are kept small and every page is in the page index, so a
reader of the numbers alone touches few bytes, and a reader of some documents
only their pages. A manifest, one row per part, holds where each part starts.

Ids are those of the plain library call on each whole text, which turns the
string of an added token into that token. A null text has no ids of its own. Null keys come first. Rows with equal keys
are ordered by a digest of their text; equal rows stay as they are. Empty
tables give empty files.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks, fields, full_texts, kept
from packetloom.llm.chunks import PartMemory, odd

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 5_000
TOGETHER = 300  # parts of texts given to the tokenizer as one text


class LibraryEncoder:
    """Ids by a tokenizer of the tokenizers library, with a memory of the parts of texts seen before."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        # What the library does with a whole text, for the few that hold the string of an added token.
        self.plain = Tokenizer.from_str(definition)
        added = [t.content for t in self.plain.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        # Parts of other texts hold none, and side by side they may not make one either.
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # parts come once; the memory of parts stands in for it
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # In the byte-level alphabet each character of a token stands for one byte.
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)
        self.memory = PartMemory(self.encode_parts, encode_plain=self.encode_plain)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part; those with white space at an end are encoded one by one."""
        found: list[bytes] = [b""] * len(parts)
        alone = [i for i, p in enumerate(parts) if odd(p)]
        for i, ids in zip(alone, self._ids([parts[i] for i in alone])):
            found[i] = np.array(ids, "<u4").tobytes()
        plain = [i for i, p in enumerate(parts) if not odd(p)]
        for i, ids in zip(plain, self.encode_plain([parts[i] for i in plain], "\n")):
            found[i] = ids
        return found

    def encode_plain(self, parts: list[str], before: str = " ") -> list[bytes]:
        """Ids of parts without white space at their ends, each with a space or after a line break.

        They may stand side by side in one text. The space belongs to the part;
        the line break is a token of its own, which is left out.
        """
        if not parts:
            return []
        left_out = 4 * (before == "\n")
        groups = [parts[k : k + TOGETHER] for k in range(0, len(parts), TOGETHER)]
        numbers = np.concatenate([np.array(ids, "<u4") for ids in self._ids([before + before.join(g) for g in groups])])
        reached = np.cumsum(self.n_bytes[numbers])
        ends = np.cumsum(1 + pc.binary_length(pa.array(parts, pa.large_string())).to_numpy())
        cuts = (4 * np.searchsorted(reached, ends) + 4).tolist()
        raw = numbers.tobytes()
        return [raw[start + left_out : end] for start, end in zip([0, *cuts], cuts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as the library gives them; the string of an added token is that token's id."""
        ids, ends = self.encode_flat(pa.array(texts, pa.large_string()))
        raw, cuts = ids.tobytes(), (4 * ends).tolist()
        return [raw[start:end] for start, end in zip([0, *cuts], cuts)]

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, in one array for all texts, which are not null, and where each text's ids end in it."""
        whole = [i for i, t in enumerate(texts.to_pylist()) if self.added.search(t)] if self.added else []
        if not whole:
            return self.memory.flat_ids_of(texts)
        others = np.ones(len(texts), bool)
        others[whole] = False
        ids, ends = self.memory.flat_ids_of(texts.filter(pa.array(others)))
        rest = iter(np.split(ids, ends[:-1]))
        plain = (self.plain.encode(t, add_special_tokens=False).ids for t in texts.take(pa.array(whole)).to_pylist())
        found = [next(rest) if other else np.array(next(plain), "<u4") for other in others.tolist()]
        return np.concatenate(found), np.cumsum([len(f) for f in found])


def write_token_files(
    docs: DataFrame, definition_path: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int = 0
) -> None:
    """Write ``folder``/ids and ``folder``/manifest; ``end_id`` follows each document's ids.

    The tokenizer's definition is read on the driver and sent along.
    """
    with open(definition_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType(
        fields(docs, key)
        + [
            T.StructField("part", T.IntegerType()),
            T.StructField("part_start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(LibraryEncoder, shared.value)
        part, start = TaskContext.get().partitionId(), 0
        for b in batches:
            for own in blocks(b, 1):
                ids, reached = encoder.encode_flat(full_texts(own.column(1)))
                values = pa.array(np.insert(ids, reached, end_id).view(np.int32))
                ends = np.append(0, reached + np.arange(1, len(reached) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values, type=arrow.field("ids").type)
                parts = pa.array(np.full(len(reached), part, np.int32))
                yield batch(arrow, [own.column(0), parts, pa.array(start + ends[:-1]), pa.array(np.diff(ends)), lists])
                start += int(ends[-1])

    ordered = (
        docs.select(F.col(key), F.col(text))
        .withColumn("_digest", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
        .repartitionByRange(F.col(key).asc_nulls_first(), F.col("_digest"))
        .sortWithinPartitions(F.col(key).asc_nulls_first(), F.col("_digest"))
        .select(key, text)
    )
    numbers = [key, "part", "part_start", "n_tokens"]
    writer = ordered.mapInArrow(encode_batches, schema).write
    writer = writer.option("parquet.writer.version", "v2").option("parquet.block.size", ROW_GROUP_BYTES)
    writer = writer.option("parquet.page.size", PAGE_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
    for name in numbers:
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    writer.option("parquet.enable.dictionary#ids.list.element", "true").option("compression", "zstd").parquet(f"{folder}/ids")

    spark = docs.sparkSession
    totals = (
        spark.read.parquet(f"{folder}/ids")
        .groupBy("part")
        .agg(F.sum("n_tokens").alias("n_ids"), F.count(F.lit(1)).alias("n_documents"))
    )
    # One row per file, so one task can add them up.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    manifest = totals.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the files with ``start``, the number of ids in all documents before."""
    ids = spark.read.parquet(f"{folder}/ids")
    manifest = spark.read.parquet(f"{folder}/manifest").select("part", "first_id")
    # The manifest has one row per file.
    placed = ids.join(F.broadcast(manifest), "part")
    return placed.withColumn("start", F.col("first_id") + F.col("part_start")).drop("part", "part_start", "first_id")


def id_checksums(tokens: DataFrame, *keep: str) -> DataFrame:
    """``ids_crc32`` of each row's ids as little-endian unsigned 32-bit integers."""
    schema = T.StructType(fields(tokens, *keep) + [T.StructField("ids_crc32", T.LongType())])
    arrow = to_arrow_schema(schema)

    def sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(len(keep))
            ends = lists.offsets.to_numpy()
            raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            sums = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield batch(arrow, [*(b.column(i) for i in range(len(keep))), sums])

    return tokens.select(*keep, "ids").mapInArrow(sum_batches, schema)
