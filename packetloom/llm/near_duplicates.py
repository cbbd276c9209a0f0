"""Near-duplicate documents by one-permutation MinHash.

The set of a document is its distinct shingles of ``width`` words. One hash function deals
the shingles to SLOTS bins and the smallest hash of each bin is its value; an
empty bin borrows the value of a bin that a second hash function picks, again
and again until it finds one that is not empty (optimal densification). BANDS
groups of ROWS slots are bucket keys.

Documents with equal sets form one class, which is found by a digest, so that
copies take no part in what follows. The classes of a bucket are joined to one
centre (star-shaped edges: one less than there are classes), and each edge is
confirmed on the full sets. Buckets whose classes then still lie in different
components get stars around other centres. What is left, mostly classes that
differ from their group in more than a fifth, is settled by an exact prefix
join between components, so a link that runs over no centre is not lost.

A pair of similarity 0.8 shares no bucket with probability (1 - 0.8 ** ROWS)
** BANDS, one in a million; all links found are exact.

Null and empty texts, and texts without words, have an empty set and no links.
Repeated rows belong to one class. Null keys are never a component's name if
there is another; a component of null keys alone has the name null. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks, byte_values, fields, plain_names
from packetloom.llm.components import connected_components
from packetloom.operators.distribution import join_null_safe
from packetloom.session import materialise

WIDTH = 2  # words of a shingle by op3's contract
ROWS, BANDS = 5, 36
SLOTS = ROWS * BANDS
SIMILAR = 80  # percent
CENTRES = 4  # orders in which further centres are taken
WORD_MEMORY = 500_000
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
MIX, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SETS = T.StructType([T.StructField("class", T.LongType()), T.StructField("members", T.ArrayType(T.LongType(), False))])
EDGES = np.array([(i << 64) // SLOTS + (1 if (i << 64) % SLOTS else 0) for i in range(SLOTS)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, remembered up to WORD_MEMORY words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > WORD_MEMORY:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_sets(hashes: WordHashes, texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles of ``width`` words; a shorter text is one shingle."""
    split = [t.translate(LOWER).split() for t in texts]
    code = hashes.of([w for words in split for w in words])
    runs = [mixed(code)]  # runs[i]: hashes of i + 1 words from each place on
    for i in range(1, width):
        runs.append(mixed(runs[-1][:-1] + code[i:] * MIX))
    sets, at = [], 0
    for words in split:
        n = len(words)
        extra = min(n, width) - 1
        sets.append(np.unique(runs[extra][at : at + n - extra]) if n else code[:0])
        at += n
    return sets


def signature(members: np.ndarray) -> np.ndarray:
    """The smallest hash of each slot; empty slots are densified."""
    first = np.searchsorted(members, EDGES)
    last = np.append(first[1:], len(members))
    filled = first < last
    values = np.zeros(SLOTS, np.uint64)
    values[filled] = members[first[filled]]
    open_ = np.flatnonzero(~filled)
    source, attempt = np.arange(SLOTS), 0
    while len(open_):
        attempt += 1
        pick = mixed(open_.astype(np.uint64) + np.uint64(attempt << 20)) % np.uint64(SLOTS)
        hit = filled[pick]
        source[open_[hit]] = pick[hit]
        open_ = open_[~hit]
    return values[source]


def band_keys(values: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in values.reshape(BANDS, ROWS).T:
        key = mixed(key + column * MIX)
    return key.view(np.int64)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Each row's key, digests of text and set, size of the set, and bucket keys (none for an empty set)."""
    schema = T.StructType(
        fields(docs, key)
        + [
            T.StructField("text_digest", T.BinaryType()),
            T.StructField("set_digest", T.BinaryType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType(), False)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for own in blocks(b, 1):
                texts = byte_values(own.column(1))
                sets = shingle_sets(hashes, texts, width)
                keys = [band_keys(signature(s)) for s in sets if len(s)]
                ends = np.cumsum([0] + [BANDS if len(s) else 0 for s in sets]).astype(np.int32)
                values = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
                yield batch(
                    arrow,
                    [
                        own.column(0),
                        [hashlib.md5(t).digest() for t in texts],
                        [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                        [len(s) for s in sets],
                        pa.ListArray.from_arrays(pa.array(ends), values, type=arrow.field("bands").type),
                    ],
                )

    return docs.select(key, text).mapInArrow(sign_batches, schema)


def similar(common: Column, size_a: Column, size_b: Column) -> Column:
    return 100 * common >= SIMILAR * (size_a + size_b - common)


def sizes_allow(size_a: Column, size_b: Column) -> Column:
    """Sets of these sizes can be similar enough."""
    return 100 * F.least(size_a, size_b) >= SIMILAR * F.greatest(size_a, size_b)


def star_edges(bands: DataFrame) -> DataFrame:
    """(a, b): every class of a bucket, and the bucket's first class as its centre."""
    hubs = bands.groupBy("band").agg(F.min(F.struct("class", "size")).alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = hubs.where("n > 1").select("band", F.col("hub.class").alias("a"), F.col("hub.size").alias("hub_size"))
    edges = bands.join(hubs, "band").where((F.col("a") != F.col("class")) & sizes_allow(F.col("size"), F.col("hub_size")))
    return edges.select("a", F.col("class").alias("b")).distinct()


def more_star_edges(opened: DataFrame) -> DataFrame:
    """Stars of open buckets around other centres: CENTRES orders of the classes give about as many centres to a group."""
    order = F.xxhash64("class", F.pmod("band", F.lit(CENTRES)))
    hubs = opened.groupBy("band").agg(F.min_by(F.struct("class", "size", "component"), order).alias("hub"))
    edges = opened.join(hubs, "band").where(
        (F.col("component") != F.col("hub.component")) & sizes_allow(F.col("size"), F.col("hub.size"))
    )
    return edges.select(F.least("class", "hub.class").alias("a"), F.greatest("class", "hub.class").alias("b")).distinct()


def confirmed(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges whose full sets are similar."""
    left = sets.select(F.col("class").alias("a"), F.col("members").alias("members_a"))
    right = sets.select(F.col("class").alias("b"), F.col("members").alias("members_b"))
    pairs = edges.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("members_a", "members_b"))
    return pairs.where(similar(common, F.size("members_a"), F.size("members_b"))).select("a", "b")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(class, members) for the wanted classes (key, text_digest, class); only their first documents are read as sets."""
    first = wanted.select(F.col("first_key").alias("_key"), F.hex("first_digest").alias("_digest"), "class")
    given = docs.select(F.col(key).alias("_own"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    same = F.col("_own").eqNullSafe(F.col("_key")) & (F.upper(F.md5("_text")) == F.col("_digest"))
    texts = given.join(first, same).select("class", "_text")
    kind = to_arrow_schema(SETS)

    def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for own in blocks(b, 1):
                sets = shingle_sets(hashes, byte_values(own.column(1)), width)
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(ends), values, type=kind.field("members").type)
                yield batch(kind, [own.column(0), lists])

    return texts.mapInArrow(set_batches, SETS).dropDuplicates(["class"])


def open_buckets(bands: DataFrame, components: DataFrame) -> DataFrame:
    """The rows of buckets whose classes lie in several components, with these."""
    placed = bands.join(components.withColumnRenamed("v", "class"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    split = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(split.where("low != high").select("band"), "band", "left_semi")


def unlinked_pairs(opened: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of the classes of open buckets that lie in different components and may be similar.

    A prefix join: the shingles of a class are ordered from rare to frequent,
    and two similar sets share one among the first fifth of each. The places of
    the shared one bound what the rest can add. In each shingle's list, the
    classes of its commonest component are not paired among themselves.
    """
    classes = opened.select("class", "component").distinct()
    members = sets.join(classes, "class").select("class", "component", F.size("members").alias("size"), F.explode("members").alias("shingle"))
    often = members.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    ranked = members.join(often, "shingle").groupBy("class", "component", "size")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("ordered"))  # one document's shingles
    length = F.col("size") - F.ceil(F.col("size") * SIMILAR / 100) + 1
    prefix = ranked.select("class", "component", "size", F.posexplode(F.slice("ordered", F.lit(1), length.cast("int"))).alias("place", "s"))
    prefix = materialise(prefix.where("s.n > 1").select("class", "component", "size", "place", "s.shingle"), "minhash-prefixes")
    lists = prefix.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n"))
    lists = lists.groupBy("shingle").agg(F.max_by("component", F.struct("n", "component")).alias("commonest"), F.count(F.lit(1)).alias("k"))
    left = prefix.join(lists.where("k > 1"), "shingle").where(F.col("component") != F.col("commonest")).alias("x")
    rest = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    apart = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component"))
    enough = similar(rest, F.col("x.size"), F.col("y.size")) & sizes_allow(F.col("x.size"), F.col("y.size"))
    pairs = left.join(prefix.alias("y"), apart & enough)
    return pairs.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """For each row: key, text_digest (md5), n_shingles, component_id, kept, and component, the number of its component.

    Components whose rows share a key have one component_id; their numbers differ. Rows without words have none.
    """
    signed = materialise(signatures(docs, key, text, width), "minhash-signatures")
    known = signed.where(F.col("n_shingles") > 0)
    # One row per distinct set; partial aggregation meets copies before the shuffle.
    classes = known.groupBy("set_digest").agg(
        F.min(key).alias("smallest"),
        F.min(F.struct(F.col(key), F.col("text_digest"))).alias("first"),
        F.first("n_shingles").alias("size"),
        F.first("bands").alias("bands"),
    )
    classes = classes.select(
        "set_digest", "smallest", F.col(f"first.{key}").alias("first_key"), F.col("first.text_digest").alias("first_digest"), "size", "bands"
    )
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "minhash-classes")
    every = classes.select("class", "size", F.explode("bands").alias("band"))
    shared = every.groupBy("band").count().where("count > 1").select("band")
    bands = materialise(every.join(shared, "band", "left_semi"), "minhash-buckets")

    wanted = classes.join(bands.select("class").distinct(), "class", "left_semi")
    sets = materialise(full_sets(docs, wanted, key, text, width), "minhash-sets")
    links = materialise(confirmed(star_edges(bands), sets), "minhash-links")
    components = connected_components(links)
    for pairs in (more_star_edges, lambda opened: unlinked_pairs(opened, sets)):
        opened = materialise(open_buckets(bands, components), "minhash-open")
        more = materialise(confirmed(pairs(opened), sets), "minhash-links")
        if not more.isEmpty():
            links = links.unionAll(more)
            components = connected_components(links)

    named = classes.join(components.withColumnRenamed("v", "class"), "class", "left")
    named = named.select("set_digest", "smallest", F.coalesce("component", "class").alias("component"))
    names = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = named.join(names, "component").select("set_digest", "component_id", "component")
    found = known.join(named, "set_digest").select(key, "text_digest", "n_shingles", "component_id", "component")
    empty = signed.where(F.col("n_shingles") == 0).select(
        key, "text_digest", "n_shingles", F.col(key).alias("component_id"), F.lit(None).cast("long").alias("component")
    )
    return found.unionAll(empty).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one of each.

    Rows without words are linked with nothing and all stay, repeated ones,
    too. Of the rows whose key names the component, which may share the key and
    not the text, the one with the smallest text digest stays, and of equal
    rows one.
    """
    names = docs.columns
    docs, (key, text) = plain_names(docs, key, text)
    found = near_duplicates(docs, key, text, width)
    digest = F.lower(F.hex("text_digest"))
    known = found.where("n_shingles > 0")
    # One row per component, with the number of rows of each key and text, since of equal ones one stays.
    chosen = known.where("kept").groupBy("component").agg(F.min(F.struct(F.col(key).alias("_key"), digest.alias("_digest"))).alias("_first"))
    counted = known.where("kept").groupBy(F.col(key).alias("_key"), digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_rows"))
    chosen = join_null_safe(chosen.select("_first.*"), counted, ["_key", "_digest"])
    wordless = found.where("n_shingles = 0").select(F.col(key).alias("_key"), digest.alias("_digest"), F.lit(1).cast("long").alias("_rows"))
    standing = materialise(chosen.unionAll(wordless.distinct()), "standing")
    own = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    same = F.col(f"`{key}`").eqNullSafe(F.col("_key")) & (own == F.col("_digest"))
    single = docs.join(standing.where("_rows = 1"), same, "left_semi")
    repeated = docs.join(standing.where("_rows > 1"), same, "left_semi").dropDuplicates([key, text])
    return single.unionAll(repeated).toDF(*names)
