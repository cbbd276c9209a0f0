"""Benchmark decontamination as a prefix-filtered set join.

A benchmark window is a run of 13 item words (a whole shorter item is one
window). Its set of shingles is ordered by rarity over all documents. A
document can only contain a window if it contains its rarest shingle, so one
prefix shingle per window is joined with the document's shingles. Matches
must leave room for the whole window before and after the shingle (length and
positional bounds), and are then compared word by word.

The benchmark side is indexed in groups of at most GROUP_WORDS words, which
bounds what is broadcast; every document is joined with every group.

Null and empty texts have no words. Items without words have no windows.
Repeated documents are judged one by one; repeated items count once. A null
item_id is written as the empty string. Empty tables are no special case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks, byte_values, fields, plain_names

WINDOW = 13
SHINGLE = 3
GROUP_WORDS = 2_000_000
CONTAMINATED_SHARE = 20  # a document is contaminated if a 20th of its words is hit
ID_BITS = 21  # of a word's number inside one group; three of them make a shingle's code

# Words are runs of digits, letters a-z (A-Z lower-cased) and bytes from 0x80 on.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def fold_words(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


def shingle_codes(ids: np.ndarray, width: int) -> np.ndarray:
    """Codes of the shingles at each position; 0 where a word is not one of the benchmark's."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code, known = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(width):
        part = ids[i : i + n]
        code |= part << (ID_BITS * (SHINGLE - 1 - i))
        known &= part > 0
    code[~known] = 0
    return code


@dataclass
class WindowIndex:
    """Windows of a group of items as slices of one stream of word numbers."""

    vocabulary: dict[bytes, int]
    stream: np.ndarray
    start: np.ndarray
    length: np.ndarray
    item: np.ndarray
    item_ids: list[str]

    @classmethod
    def build(cls, items: list[tuple[str, bytes]], window: int = WINDOW) -> WindowIndex:
        vocabulary: dict[bytes, int] = {}
        stream: list[int] = []
        start, length, item, names = [], [], [], []
        for name, text in sorted(set(items)):
            words = fold_words(text)
            if not words:
                continue
            size = min(window, len(words))
            for i in range(len(words) - size + 1):
                start.append(len(stream) + i)
                length.append(size)
                item.append(len(names))
            stream += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            names.append(name)
        whole = [np.array(x, np.int64) for x in (stream, start, length, item)]
        return cls(vocabulary, *whole, names)

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, offset, code) of every shingle of every window."""
        parts = []
        for width in range(1, SHINGLE + 1):
            own = np.flatnonzero(np.minimum(self.length, SHINGLE) == width)
            codes = shingle_codes(self.stream, width)
            for offset in range(int((self.length[own] - width).max(initial=-1)) + 1):
                at = own[self.length[own] - width >= offset]
                parts.append((at, np.full(len(at), offset), codes[self.start[at] + offset]))
        if not parts:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*parts))


@dataclass
class PrefixIndex:
    """For each prefix shingle, in ascending order of codes, its windows."""

    windows: WindowIndex
    widths: tuple[int, ...]
    codes: np.ndarray
    first: np.ndarray
    window: np.ndarray
    offset: np.ndarray

    @classmethod
    def build(cls, windows: WindowIndex, frequency: dict[int, int]) -> PrefixIndex:
        """Take each window's rarest shingle; a window with a shingle that no document has cannot occur."""
        window, offset, code = windows.shingles()
        often = np.fromiter((frequency.get(c, 0) for c in code.tolist()), np.int64, len(code))
        order = np.lexsort((code, often, window))
        window, offset, code, often = (x[order] for x in (window, offset, code, often))
        rarest = np.ones(len(window), bool)
        rarest[1:] = window[1:] != window[:-1]
        rarest &= often > 0
        window, offset, code = (x[rarest] for x in (window, offset, code))
        order = np.argsort(code, kind="stable")
        codes, first = np.unique(code[order], return_index=True)
        widths = tuple(sorted({int(w) for w in np.minimum(windows.length[window], SHINGLE)}))
        return cls(windows, widths, codes, np.append(first, len(window)), window[order], offset[order])

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and window of every verified occurrence in a stream of word numbers, where 0 separates texts."""
        starts, found = [], []
        for width in self.widths:
            codes = shingle_codes(ids, width)
            at, k = lookup(self.codes, codes)
            n = self.first[k + 1] - self.first[k]
            each = np.repeat(self.first[k] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            window = self.window[each]
            start = np.repeat(at, n) - self.offset[each]
            length = self.windows.length[window]
            fits = (np.minimum(length, SHINGLE) == width) & (start >= 0) & (start + length <= len(ids))
            window, start, length = window[fits], start[fits], length[fits]
            for i in range(int(length.max(initial=0))):
                inside = np.minimum(i, length - 1)
                same = ids[start + inside] == self.windows.stream[self.windows.start[window] + inside]
                window, start, length = window[same], start[same], length[same]
            starts.append(start)
            found.append(window)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(found)


def lookup(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the values that are among the sorted codes, and the index of each."""
    at = np.flatnonzero(values)
    if not len(codes) or not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    some = values[at]
    k = np.minimum(np.searchsorted(codes, some), len(codes) - 1)
    hit = codes[k] == some
    return at[hit], k[hit]


def word_stream(vocabulary: dict[bytes, int], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of the texts, a 0 after each, and where each text ends."""
    words: list[bytes] = []
    ends = []
    for t in texts:
        words += fold_words(t)
        words.append(b"")
        ends.append(len(words))
    return np.fromiter(map(vocabulary.get, words, repeat(0)), np.int64, len(words)), np.array(ends, np.int64)


def shingle_frequency(docs: DataFrame, text: str, windows: WindowIndex) -> dict[int, int]:
    """How often each benchmark shingle occurs over all documents. At most one number per benchmark shingle returns."""
    _, _, codes = windows.shingles()
    known = np.unique(codes)
    widths = sorted({int(w) for w in np.minimum(windows.length, SHINGLE)})
    shared = docs.sparkSession.sparkContext.broadcast((windows.vocabulary, known, widths))

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, codes, widths = shared.value
        total = np.zeros(len(codes), np.int64)
        for b in batches:
            for own in blocks(b, 0):
                texts = byte_values(own.column(0))
                ids, _ = word_stream(vocabulary, texts)
                for width in widths:
                    total += np.bincount(lookup(codes, shingle_codes(ids, width))[1], minlength=len(codes))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(codes[seen]), pa.array(total[seen])], names=["code", "n"])

    counts = docs.select(text).mapInArrow(count_batches, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return {r[0]: r[1] for r in counts.collect()}


def window_hits(docs: DataFrame, key: str, text: str, index: PrefixIndex) -> DataFrame:
    """For each document: word count, runs of hit words, and the items with windows in it."""
    runs = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType(
        fields(docs, key)
        + [
            T.StructField("digest", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", runs),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def hit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: PrefixIndex = shared.value
        windows = index.windows
        for b in batches:
            for own in blocks(b, 1):
                texts = byte_values(own.column(1))
                ids, ends = word_stream(windows.vocabulary, texts)
                begins = np.append(0, ends[:-1])
                start, window = index.occurrences(ids)
                edges = np.zeros(len(ids) + 1, np.int64)
                np.add.at(edges, start, 1)
                np.add.at(edges, start + windows.length[window], -1)
                # A separator is never hit, so no run crosses texts.
                steps = np.diff((np.cumsum(edges[:-1]) > 0).astype(np.int8), prepend=0, append=0)
                run_from, run_to = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
                hits: dict[int, list] = {}
                for d, s, e in zip(np.searchsorted(ends, run_from, "right").tolist(), run_from.tolist(), run_to.tolist()):
                    hits.setdefault(d, []).append({"start": s - int(begins[d]), "end": e - int(begins[d])})
                items: dict[int, set] = {}
                for d, i in zip(np.searchsorted(ends, start, "right").tolist(), windows.item[window].tolist()):
                    items.setdefault(d, set()).add(windows.item_ids[i])
                n = range(len(texts))
                yield batch(
                    arrow,
                    [
                        own.column(0),
                        [hashlib.sha256(t).digest() for t in texts],
                        pa.array(ends - begins - 1),
                        [hits.get(d, []) for d in n],
                        [sorted(items.get(d, ())) for d in n],
                    ],
                )

    return docs.select(key, text).mapInArrow(hit_batches, schema)


def benchmark_groups(benchmark: DataFrame, key: str, text: str, group_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in groups of about ``group_words`` words; only one group is on the driver at a time."""
    items = benchmark.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # A word and its separator take two bytes at least.
    words = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    groups = int(words // group_words) + 1
    for g in range(groups):
        own = items if groups == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == g)
        yield [(r[0], r[1].encode()) for r in own.collect()]


def contaminated_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """One row per document: digest (sha256 of the text), n_words, n_hit, runs, items, contaminated."""
    parts = []
    for group in benchmark_groups(benchmark, item_key, item_text, group_words):
        windows = WindowIndex.build(group)
        frequency = shingle_frequency(docs, text, windows)
        parts.append(window_hits(docs, key, text, PrefixIndex.build(windows, frequency)))
    hits = parts[0]
    if len(parts) > 1:
        # Rows of one document meet; equal rows are counted, so that they come back as often as they were there.
        for p in parts[1:]:
            hits = hits.unionAll(p)
        hits = (
            hits.groupBy(key, "digest", "n_words")
            .agg(
                F.flatten(F.collect_set("runs")).alias("runs"),
                F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
                (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"),
            )
            .withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        )
    covered = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, r: F.struct(
            F.greatest(a["end"], r["end"]).alias("end"),
            (a["n"] + F.greatest(r["end"] - F.greatest(a["end"], r["start"]), F.lit(0).cast("long"))).alias("n"),
        ),
        lambda a: a["n"],
    )
    return hits.select(
        key, "digest", "n_words", covered.alias("n_hit"), "runs", F.sort_array("items").alias("items")
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (CONTAMINATED_SHARE * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    names = docs.columns
    docs, (key, text) = plain_names(docs, key, text)
    found = contaminated_documents(docs, benchmark, key, text).where("contaminated")
    gone = found.select(F.col(key).alias("_key"), F.lower(F.hex("digest")).alias("_digest")).distinct()
    own = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    kept = docs.join(gone, F.col(key).eqNullSafe(F.col("_key")) & (own == F.col("_digest")), "left_anti")
    return kept.toDF(*names)
