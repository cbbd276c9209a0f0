"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

A byte goes if it lies in a string of WIDTH bytes that also starts anywhere
else in the corpus. Sorting all suffixes would move every position; here each
start is represented by its anchor, the leftmost smallest GRAM-byte gram of
its WIDTH bytes. Equal strings have equal anchors at equal offsets, so only
anchors (about one in 85 positions) are shuffled.

1. Initial buckets: anchors with the same gram. Buckets of one are done.
2. The bucket is refined by the text from the first to the last start that the
   anchor stands for. Anchors that agree are repeated with all their starts.
3. The rest is refined by buckets of later offsets, recursively: the offsets
   from a start to its anchor are cut into blocks of BLOCK_WIDTHS[0], and an
   anchor's block is named by the bytes that all starts of the block cover
   together. Equal names: the whole block is repeated. If not even the bytes
   that every start of the block shares are found again, no start of it is
   repeated. Otherwise the block is cut into the next smaller ones. An anchor
   that is settled goes on standing for its bucket, one for each name, so the
   others are still compared with it.

Names are 64-bit hashes inside a bucket that is itself a 64-bit hash. Nothing
compares pairs: every step counts names, with partial aggregation first, so a
bucket may hold a third of all anchors.

Null texts are empty. Texts below WIDTH bytes lose nothing. Equal rows are
occurrences of their own, so their texts go. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks, byte_values, fields
from packetloom.llm.storage import Scratch

WIDTH = 200
GRAM = 32  # a power of two
SPAN = WIDTH - GRAM + 1  # grams of a string, and offsets from a start to its anchor
BLOCK_WIDTHS = (16, 4, 1)
SEGMENT = 1 << 20  # starts handled at a time in one long text
POSITION_BITS = 21
MIX, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all grams of GRAM bytes, built from those of half their length."""
    hashes, factor, step = BYTE_CODES[data], BYTE_CODES[:1], 1
    while step < GRAM:
        hashes = hashes[:-step] * factor + hashes[step:]
        factor, step = mixed(factor), 2 * step
    return mixed(hashes)


def segment_anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, first and last start of each, and the hashes of their grams."""
    hashes = gram_hashes(data)
    low = np.uint64((1 << POSITION_BITS) - 1)
    # The hash above, the position below: the smallest is the leftmost of the smallest hashes.
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    rows = np.concatenate([keys, np.full(-len(keys) % SPAN, ~np.uint64(0))]).reshape(-1, SPAN)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    starts = len(keys) - SPAN + 1
    position = (np.minimum(behind[:starts], ahead[SPAN - 1 : len(keys)]) & low).astype(np.int64)
    first = np.flatnonzero(np.diff(position, prepend=-1))
    last = np.append(first[1:], starts) - 1
    return position[first], first, last, hashes[position[first]]


def text_anchors(text: bytes) -> tuple[np.ndarray, ...]:
    """As ``segment_anchors`` for a whole text, a segment at a time; an anchor on a seam is one."""
    data = np.frombuffer(text, np.uint8)
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(data) - WIDTH + 1, SEGMENT):
        position, first, last, gram = segment_anchors(data[at : at + SEGMENT + WIDTH - 1])
        position, first, last = position + at, first + at, last + at
        if found and found[-1][0][-1] == position[0]:
            first[0] = found[-1][1][-1]
            found[-1] = tuple(x[:-1] for x in found[-1])
        found.append((position, first, last, gram))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*found))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def anchor_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each row's key, text digest, and its anchors: gram, name of the text around, and place.

    A place holds the anchor's position, and the distances to its first start and from first to last start.
    """
    longs = T.ArrayType(T.LongType(), False)
    schema = T.StructType(
        fields(docs, key)
        + [T.StructField("digest", T.BinaryType())]
        + [T.StructField(n, longs) for n in ("gram", "around", "place")]
    )
    arrow = to_arrow_schema(schema)

    def anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in (block for b in batches for block in blocks(b, 1)):
            texts = byte_values(own.column(1))
            grams, arounds, places, ends = [], [], [], [0]
            for t in texts:
                position, first, last, gram = text_anchors(t)
                grams.append(gram.view(np.int64))
                places.append(position << 16 | (position - first) << 8 | (last - first))
                arounds += [
                    xxhash.xxh3_64_intdigest(t[s : e + WIDTH], p - s)
                    for p, s, e in zip(position.tolist(), first.tolist(), last.tolist())
                ]
                ends.append(ends[-1] + len(gram))
            offsets = pa.array(ends, pa.int32())
            values = (np.concatenate(grams), np.array(arounds, np.uint64).view(np.int64), np.concatenate(places))
            kind = arrow.field("gram").type
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64()), type=kind) for v in values]
            yield batch(arrow, [own.column(0), [hashlib.md5(t).digest() for t in texts], *lists])

    return docs.select(key, text).mapInArrow(anchor_batches, schema)


def contexts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """The bytes that the strings over an anchor can reach, for each wanted (key, digest, class, gram, witness, place)."""
    schema = T.StructType(
        [
            T.StructField("class", T.LongType()),
            T.StructField("gram", T.LongType()),
            T.StructField("witness", T.BooleanType()),
            T.StructField("place", T.LongType()),
            T.StructField("before", T.IntegerType()),
            T.StructField("context", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    lists = wanted.groupBy("key", "digest").agg(F.collect_list(F.struct("class", "gram", "witness", "place")).alias("anchors"))
    own = docs.select(F.col(key).alias("_own"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    same = F.col("_own").eqNullSafe(F.col("key")) & (F.upper(F.md5("_text")) == F.hex("digest"))
    texts = own.join(lists, same).select("_text", "anchors")

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in (block for b in batches for block in blocks(b, 0)):
            rows = []
            for t, anchors in zip(byte_values(own.column(0)), own.column(1).to_pylist()):
                for a in anchors:
                    p = a["place"] >> 16
                    start = max(0, p - SPAN + 1)
                    rows.append((a["class"], a["gram"], a["witness"], a["place"], p - start, t[start : p + WIDTH]))
            if rows:
                yield batch(arrow, [list(c) for c in zip(*rows)])

    return texts.mapInArrow(cut_batches, schema)


NAMED = T.StructType(
    [
        T.StructField("class", T.LongType()),
        T.StructField("gram", T.LongType()),
        T.StructField("witness", T.BooleanType()),
        T.StructField("position", T.LongType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("whole", T.LongType()),
        T.StructField("core", T.LongType()),
    ]
)


def named_blocks(rows: DataFrame, level: int) -> DataFrame:
    """Blocks of one level with the names of their bytes.

    ``rows`` are contexts with a column ``block``: the block of the level
    before that is cut, or null for all blocks that hold a start of the anchor.
    ``whole`` covers all starts of the block, null where the text ends before
    it does; ``core`` is what they share.
    """
    arrow = to_arrow_schema(NAMED)
    width = BLOCK_WIDTHS[level]
    parts = BLOCK_WIDTHS[level - 1] // width if level else 0

    def name_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in (block for b in batches for block in blocks(b, 5)):
            found = []
            columns = (own.column(i).to_pylist() for i in range(7))
            for cls, gram, witness, place, before, context, block in zip(*columns):
                p, back, reach = place >> 16, place >> 8 & 0xFF, place & 0xFF
                if block is None:
                    cut = range((back - reach) // width, back // width + 1)
                else:
                    cut = range(block * parts, (block + 1) * parts)
                for j in cut:
                    near, far = j * width, min((j + 1) * width, SPAN) - 1
                    # The offsets of the block whose strings lie inside the text.
                    if max(near, before + WIDTH - len(context)) > min(far, before):
                        continue
                    core = signed(xxhash.xxh3_64_intdigest(context[before - near : before - far + WIDTH], j))
                    whole = None
                    if far <= before and before - near + WIDTH <= len(context):
                        whole = signed(xxhash.xxh3_64_intdigest(context[before - far : before - near + WIDTH], j))
                    found.append((cls, gram, witness, p, j, whole, core))
            if found:
                yield batch(arrow, [list(c) for c in zip(*found)])

    order = ["class", "gram", "witness", "place", "before", "context", "block"]
    return rows.select(*order).mapInArrow(name_batches, NAMED)


def refined(named: DataFrame, level: int, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Byte runs (class, start, end) of settled blocks, and the blocks (class, witness, block) that are cut next."""
    spans = named.groupBy("gram", "block", "whole").agg(
        F.min("class").alias("first"), F.max("class").alias("last"), F.max("witness").alias("seen")
    )
    again = spans.where(F.col("whole").isNotNull() & (F.col("seen") | (F.col("first") != F.col("last"))))
    flagged = named.join(again, ["gram", "block", "whole"], "left")
    flagged = scratch.keep(flagged.withColumn("settled", F.col("first").isNotNull()), f"flagged-{level}")
    width = BLOCK_WIDTHS[level]
    near, far = F.col("block") * width, F.least((F.col("block") + 1) * width, F.lit(SPAN)) - 1
    runs = flagged.where("settled and not witness").select(
        "class", (F.col("position") - far).alias("start"), (F.col("position") - near + WIDTH).alias("end")
    )
    if level + 1 == len(BLOCK_WIDTHS):
        return runs, None
    shared = flagged.groupBy("gram", "block", "core").agg(
        F.min("class").alias("core_first"), F.max("class").alias("core_last"), F.max("witness").alias("core_seen")
    )
    shared = shared.where("core_seen or core_first != core_last").select("gram", "block", "core")
    open_ = flagged.where("not settled and not witness").join(shared, ["gram", "block", "core"], "left_semi")
    open_ = scratch.keep(open_.select("class", "gram", "block"), f"open-{level}")
    # One anchor for each name goes on as a witness where something is still open.
    stands = flagged.where("witness or (settled and class = first)").select(
        F.when(F.col("settled"), F.col("first")).otherwise(F.col("class")).alias("class"), "gram", "block"
    )
    stands = stands.distinct().join(open_.select("gram", "block").distinct(), ["gram", "block"], "left_semi")
    following = open_.select("class", "block", F.lit(False).alias("witness")).distinct()
    return runs, following.unionAll(stands.select("class", "block", F.lit(True).alias("witness")))


def repeated_runs(docs: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """(key, digest, runs): the bytes of each text that are repeated, as a list of runs that may overlap."""
    table = anchor_table(docs, key, text).withColumn("row", F.monotonically_increasing_id())
    table = scratch.keep(table, "anchors")
    rows = table.select("row", F.col(key).alias("key"), "digest")
    often = table.select(F.explode("gram").alias("gram")).groupBy("gram").count().where("count > 1").select("gram")
    # Written, so that the join below shuffles both sides itself and Spark can cut a gram that many anchors have.
    often = scratch.keep(often, "repeated-grams")
    anchors = table.select("row", F.explode(F.arrays_zip("gram", "around", "place")).alias("a")).select("row", "a.*")
    anchors = scratch.keep(anchors.join(often, "gram", "left_semi"), "repeated-anchors")
    rows = scratch.keep(rows, "rows")
    scratch.drop("anchors", "repeated-grams")

    classes = anchors.groupBy("gram", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "place")).alias("first")
    )
    classes = classes.withColumn("class", F.monotonically_increasing_id())
    classes = scratch.keep(classes.select("class", "gram", "around", "n", "first.row", "first.place"), "classes")
    start = F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(F.lit(255))
    end = start + F.col("place").bitwiseAND(F.lit(255)) + WIDTH
    known = classes.where("n > 1").select("gram", "around")
    whole = anchors.join(known, ["gram", "around"], "left_semi").select("row", start.alias("start"), end.alias("end"))

    open_buckets = classes.groupBy("gram").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("classes"))
    open_buckets = open_buckets.where("least = 1 and classes > 1").select("gram")
    active = classes.join(open_buckets, "gram", "left_semi")
    wanted = active.select("class", "gram", (F.col("n") > 1).alias("witness"), "place", "row").join(rows, "row").drop("row")
    around = scratch.keep(contexts(docs, wanted, key, text), "contexts")

    found: list[DataFrame] = []
    cut = around.withColumn("block", F.lit(None).cast("int"))
    for level in range(len(BLOCK_WIDTHS)):
        named = scratch.keep(named_blocks(cut, level), f"named-{level}")
        runs, following = refined(named, level, scratch)
        found.append(runs)
        scratch.drop(f"named-{level}")
        if following is not None:
            cut = around.drop("witness").join(following, "class")
    runs = found[0]
    for more in found[1:]:
        runs = runs.unionAll(more)
    some = runs.distinct().join(classes.select("class", "row"), "class").select("row", "start", "end")
    by_row = whole.unionAll(some).groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs"))
    # Equal rows have equal runs.
    result = by_row.join(rows, "row").groupBy("key", "digest").agg(F.first("runs").alias("runs"))
    result = scratch.keep(result, "runs")
    scratch.drop("repeated-anchors", "classes", "contexts", *[f"flagged-{i}" for i in range(len(BLOCK_WIDTHS))])
    return result


def merged(runs: list[dict]) -> list[tuple[int, int]]:
    """Runs joined where they touch or overlap, in order."""
    joined: list[tuple[int, int]] = []
    for start, end in sorted((r["start"], r["end"]) for r in runs):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: key, n_bytes, n_removed, n_spans (maximal removed runs), kept (the remaining bytes), kept_sha256."""
    scratch = Scratch(docs.sparkSession, "repeated-bytes")
    runs = repeated_runs(docs, key, text, scratch)
    schema = T.StructType(
        fields(docs, key)
        + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())]
    )
    arrow = to_arrow_schema(schema)
    own = docs.select(F.col(key).alias("_own"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    same = F.col("_own").eqNullSafe(F.col("key")) & (F.upper(F.md5("_text")) == F.hex("digest"))
    marked = own.join(runs, same, "left").select("_own", "_text", "runs")

    def remove_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in (block for b in batches for block in blocks(b, 1)):
            rows = []
            for conv, t, found in zip(own.column(0).to_pylist(), byte_values(own.column(1)), own.column(2).to_pylist()):
                gone = merged(found or [])
                edges = [0, *(e for run in gone for e in run), len(t)]
                kept = b"".join(t[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                rows.append((conv, len(t), len(t) - len(kept), len(gone), kept, hashlib.sha256(kept).hexdigest()))
            yield batch(arrow, [list(c) for c in zip(*rows)])

    return marked.mapInArrow(remove_batches, schema)
