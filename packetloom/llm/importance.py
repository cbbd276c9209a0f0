"""Quality classifier by importance resampling.

Two bag-of-n-gram models over hashed buckets, one of the target text (documents
labelled good) and one of all raw text, give each document a log importance
weight: the log of how much likelier the target model makes its n-grams. A
Gumbel top-k then draws k documents without replacement, in proportion to
their weights raised to a power.

The n-grams are words, pairs of words, and pairs of word shapes (case, length,
trailing signs, whether the word repeats the one before), each family in its
own buckets. The counts of the raw model cover all documents, those of the
target model the good ones among half of the label sample; BUCKETS numbers of
each reach the driver and go back to the tasks. Good is of quality 1 and not
toxic, for the target model and the threshold.

Null and empty texts have no n-grams: their weight is 0 (log), which is
neutral. The noise is a hash of key and text, so equal rows are drawn or left
together and a run can be repeated. Ties at the last place are all drawn.
Without labelled documents the weights are all 0 and every document is drawn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks, byte_values, fields, full_texts, plain_names, release
from packetloom.session import materialise

WORD_BUCKETS = 1 << 16
SHAPE_BUCKETS = 1 << 12
BUCKETS = 2 * WORD_BUCKETS + SHAPE_BUCKETS
SMOOTHING = 1.0
POWER = 50.0  # of the importance weights; the noise then only decides between nearly equal ones
SEED = 7
WORD_MEMORY = 500_000
LABEL_ROWS = 50_000  # labelled documents that the model and the threshold are fitted on
LOWEST, BIN, BINS, LOST = -8.0, 0.01, 1000, 3.0
SEARCH_BINS = 4096
MIX = np.uint64(0x9E3779B97F4A7C15)
SIGNS = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""


def word_code(word: bytes) -> int:
    """A 64-bit number: hash above, shape (below 2 ** 10) in the lowest bits."""
    core = word.strip(SIGNS)
    tail = word[len(word.rstrip(SIGNS)) :] if core else word
    if not core:
        case = 0
    elif core.islower():
        case = 1
    elif core.istitle():
        case = 2
    elif core.isupper():
        case = 3
    elif any(0x30 <= b <= 0x39 for b in core):
        case = 4
    else:
        case = 5
    sign = 0 if not tail else 1 if tail == b"," else 2 if tail in (b".", b"!", b"?") else 3 if len(tail) == 1 else 4
    size = min(7, len(core).bit_length())
    shape = (case * 5 + sign) * 8 + size
    return (xxhash.xxh64_intdigest(word) & ~0x3FF) | shape


class WordCodes:
    """Codes of words, remembered up to WORD_MEMORY words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > WORD_MEMORY:
            known.clear()
        for w in set(words).difference(known):
            known[w] = word_code(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def bucket_stream(codes: WordCodes, texts: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, which are not null, and the number of the text that each stands in.

    Each different word is looked up once; Python holds no object per occurrence.
    """
    if isinstance(texts, list):
        texts = pa.array(texts, pa.large_binary()).cast(pa.large_string(), safe=False)
    split = pc.ascii_split_whitespace(texts)
    words, n = split.flatten(), split.value_lengths().to_numpy(zero_copy_only=False)
    # White space at either end leaves an empty piece.
    is_word = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), n)[is_word]
    coded = words.filter(pa.array(is_word)).dictionary_encode()
    code = codes.of(byte_values(coded.dictionary))[coded.indices.to_numpy(zero_copy_only=False)]
    if not len(code):
        return np.zeros(0, np.int64), owner
    same_text = owner[1:] == owner[:-1]
    left, right = code[:-1][same_text], code[1:][same_text]
    words = (code >> np.uint64(10)) % np.uint64(WORD_BUCKETS)
    mixed = (left * MIX) ^ right
    pairs = ((mixed ^ (mixed >> np.uint64(29))) * MIX >> np.uint64(20)) % np.uint64(WORD_BUCKETS) + np.uint64(WORD_BUCKETS)
    low = np.uint64(0x3FF)
    shapes = ((left & low) * np.uint64(0x400) + (right & low)) * np.uint64(2) + (left == right)
    shapes = (shapes * MIX >> np.uint64(24)) % np.uint64(SHAPE_BUCKETS) + np.uint64(2 * WORD_BUCKETS)
    buckets = np.concatenate([words, pairs, shapes]).astype(np.int64)
    return buckets, np.concatenate([owner, owner[1:][same_text], owner[1:][same_text]])


def bucket_counts(docs: DataFrame, text: str = "text", target: str = "_target") -> DataFrame:
    """Counts of each bucket over all documents (``raw``) and over those of the target (``target``)."""

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        codes = WordCodes()
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for own in blocks(b, 0):
                is_target = np.array(own.column(1).to_pylist(), bool)
                buckets, owner = bucket_stream(codes, full_texts(own.column(0)))
                raw += np.bincount(buckets, minlength=BUCKETS)
                good += np.bincount(buckets[is_target[owner]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(raw[seen]), pa.array(good[seen])], names=["bucket", "raw", "target"]
        )

    counts = docs.select(text, target).mapInArrow(count_batches, "bucket int, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log P(bucket | target) - log P(bucket | raw), each family of n-grams a distribution of its own."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, r, t in counts.collect():  # at most BUCKETS rows
        raw[bucket], target[bucket] = r, t
    ratio = np.zeros(BUCKETS)
    if not target.any():
        return ratio
    for start, end in ((0, WORD_BUCKETS), (WORD_BUCKETS, 2 * WORD_BUCKETS), (2 * WORD_BUCKETS, BUCKETS)):
        r, t = raw[start:end] + SMOOTHING, target[start:end] + SMOOTHING
        ratio[start:end] = np.log(t / t.sum()) - np.log(r / r.sum())
    return ratio


def importance_weights(docs: DataFrame, ratios: np.ndarray, keep: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with ``_log_weight``, ``_n_grams``, ``_mean`` and ``_draw``, the perturbed weight."""
    added = [
        T.StructField("_log_weight", T.DoubleType()),
        T.StructField("_n_grams", T.LongType()),
        T.StructField("_mean", T.DoubleType()),
        T.StructField("_draw", T.DoubleType()),
    ]
    schema = T.StructType(fields(docs, *keep) + added)
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    n = len(keep)

    def weigh_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        codes, ratios = WordCodes(), shared.value
        for b in batches:
            for own in blocks(b, n + 1):
                texts = byte_values(own.column(n + 1))
                buckets, owner = bucket_stream(codes, full_texts(own.column(n + 1)))
                weight = np.bincount(owner, ratios[buckets], len(texts))
                grams = np.bincount(owner, minlength=len(texts))
                mean = weight / np.maximum(grams, 1)
                named = [f"{k}\n".encode() + t for k, t in zip(own.column(n).to_pylist(), texts)]
                drawn = np.fromiter((xxhash.xxh64_intdigest(v, SEED) for v in named), np.uint64, len(named))
                uniform = (drawn >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54
                draw = POWER * mean - np.log(-np.log(uniform))
                columns = [own.column(i) for i in range(n)]
                yield batch(arrow, columns + [pa.array(x) for x in (weight, grams.astype(np.int64), mean, draw)])

    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(key).alias("_key"), F.col(text).alias("_text"))
    return given.mapInArrow(weigh_batches, schema)


def label_sample(labels: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents by hash of their key, half for the target model, half for the threshold."""
    own = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
    own = own.groupBy(F.col(key).alias("_label_key")).agg(
        F.min("quality").alias("_quality"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("_toxic")
    )
    good = F.col("_label_key"), ((F.col("_quality") == 1) & (F.col("_toxic") == 0)).cast("int").alias("_good")
    own = own.select(*good).withColumn("_place", F.xxhash64("_label_key")).orderBy("_place").limit(rows)
    return own.withColumn("_for_model", F.pmod("_place", F.lit(2)) == 0).drop("_place")


def threshold(scored: DataFrame) -> float:
    """The mean weight that best parts good from bad among labelled rows; losing a good one counts LOST times."""
    # At most BINS rows.
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("_mean") - LOWEST) / BIN))).cast("int")
    rows = scored.groupBy(place.alias("bin")).agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")).collect()
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for at, g, b in rows:
        good[at], bad[at] = g, b
    if not bad.sum():
        return -math.inf
    cost = LOST * np.append(0, np.cumsum(good)) + np.append(np.cumsum(bad[::-1])[::-1], 0)
    best = np.flatnonzero(cost == cost.min())
    return float(LOWEST + BIN * best[len(best) // 2])


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by counting in ever narrower ranges; SEARCH_BINS numbers reach the driver in each round."""
    if k <= 0:
        return math.inf
    value = F.col(column)
    low, high, n = values.agg(F.min(value), F.max(value), F.count(value)).first()
    if k >= n:
        return -math.inf
    while True:
        width = (high - low) / SEARCH_BINS
        own = values.where(value.between(low, high))
        if width <= 0 or low + width == low or high - width == high:
            break
        place = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(SEARCH_BINS - 1))
        counts = own.groupBy(place.alias("bin")).agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        for _, n, bin_low, bin_high in sorted(counts.collect(), reverse=True):
            if k <= n:
                break
            k -= n
        low, high = bin_low, bin_high
        if n <= SEARCH_BINS:
            break
    own = values.where(value.between(low, high)).groupBy(column).count()
    for found, n in sorted(own.collect(), reverse=True):
        if k <= n:
            return found
        k -= n
    return low


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_rows: int = LABEL_ROWS):
    """The ratios of the two models, all rows' weights (written once), and the draw that the last drawn row has.

    How many rows are drawn is the number whose mean weight passes the
    threshold, which comes from labelled rows that the target model has not seen.
    """
    sample = materialise(label_sample(labels, key, label_rows), "label-sample")
    # At most LABEL_ROWS short rows.
    small = F.broadcast(sample)
    marked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        small, F.col("_key") == F.col("_label_key"), "left"
    )
    is_target = F.coalesce(F.col("_for_model") & (F.col("_good") == 1), F.lit(False))
    ratios = log_ratios(bucket_counts(marked.select("_text", is_target.alias("_target")), "_text", "_target"))
    scored = materialise(importance_weights(docs, ratios, [key], key, text), "importance-weights")
    unseen = scored.join(small, (F.col(key) == F.col("_label_key")) & ~F.col("_for_model"))
    least = threshold(unseen) if ratios.any() else -math.inf
    k = scored.where(F.col("_mean") >= F.lit(least)).count()
    return ratios, scored, kth_largest(scored, "_draw", k)


def resampled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Weight, n-grams, draw and verdict of each row."""
    _, scored, last = fitted(docs, labels, key, text)
    return scored.select(
        key,
        F.col("_log_weight").alias("log_weight"),
        F.col("_n_grams").alias("n_grams"),
        F.col("_draw").alias("draw"),
        (F.col("_draw") >= F.lit(last)).alias("kept"),
    )


def drawn_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns; texts are weighed again rather than shuffled."""
    names = docs.columns
    docs, (own_key, own_text) = plain_names(docs, key, text)
    labels = labels.select(F.col(key).alias(own_key), "quality", "toxic")
    ratios, _, last = fitted(docs, labels, own_key, own_text)
    weighed = importance_weights(docs, ratios, docs.columns, own_key, own_text)
    return weighed.where(F.col("_draw") >= F.lit(last)).select(*docs.columns).toDF(*names)
