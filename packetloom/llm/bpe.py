"""Byte-level BPE encoding and decoding with segment trees.

A pre-token starts as its bytes. The leaves of a segment tree stand for byte
positions; a leaf holds the rank of the pair that starts at that position,
and each inner node the leftmost smallest rank below it. The root names the
next merge. A merge changes the pairs of its left end and of the live
neighbour before it and removes the leaf of its right end: three point
updates, each as long as the tree is high. A pre-token of n bytes costs
O(n log n), however it merges. Many short pre-tokens are merged side by side
in arrays with one row each; long ones one by one.

Null and empty texts have no ids. Rows are independent of each other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks, fields, full_texts, kept
from packetloom.llm.chunks import PartMemory

# Fixed value: the pattern that cuts a text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = 1 << 62  # the key of a leaf without a pair
POSITION_BITS = 32
WIDEST_ROW = 64  # longer pre-tokens are merged one by one
ROWS = 65_536  # pre-tokens side by side


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a rank file: base64 of the token, a space, the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PairRanks:
    """The rank of the token that two neighbouring tokens make."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        found = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        self.by_pair = found
        self.pairs = np.array(sorted(found), np.int64)
        self.rank = np.array([found[p] for p in self.pairs.tolist()], np.int64)

    def keys(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Keys of leaves, rank before position; NONE where the tokens make none or ``right`` is -1."""
        if not len(self.pairs):
            return np.full(left.shape, NONE)
        pair = left * self.size + right
        at = np.searchsorted(self.pairs, pair)
        np.minimum(at, len(self.pairs) - 1, out=at)
        known = (self.pairs[at] == pair) & (right >= 0)
        return np.where(known, (self.rank[at] << POSITION_BITS) | position, NONE)


def merge_one(tokens: list[int], pairs: PairRanks) -> list[int]:
    """Merge one pre-token; ``tokens`` are the ids of its bytes."""
    n = len(tokens)
    tokens, by_pair, size = list(tokens), pairs.by_pair, pairs.size
    width = 1 << max(0, n - 1).bit_length()
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        rank = by_pair.get(tokens[i] * size + tokens[i + 1])
        if rank is not None:
            tree[width + i] = rank << POSITION_BITS | i
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(leaf: int, key: int) -> None:
        node = width + leaf
        tree[node] = key
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put_pair(i: int) -> None:
        rank = by_pair.get(tokens[i] * size + tokens[after[i]]) if after[i] < n else None
        put(i, NONE if rank is None else rank << POSITION_BITS | i)

    while n > 1 and tree[1] < NONE:
        at = tree[1] & ((1 << POSITION_BITS) - 1)
        gone = after[at]
        tokens[at] = tree[1] >> POSITION_BITS
        tokens[gone] = -1
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
        put(gone, NONE)
        put_pair(at)
        if before[at] >= 0:
            put_pair(before[at])
    return [t for t in tokens if t >= 0]


def merge_rows(tokens: np.ndarray, pairs: PairRanks) -> np.ndarray:
    """Merge many pre-tokens, one per row, padded with -1 to a power of two; merged tokens keep their first place."""
    rows, width = tokens.shape
    tokens = tokens.copy()
    place = np.arange(width)
    after = np.tile(place + 1, (rows, 1))
    before = np.tile(place - 1, (rows, 1))
    right = np.concatenate([tokens[:, 1:], np.full((rows, 1), -1)], 1)
    tree = np.full((rows, 2 * width), NONE)
    tree[:, width:] = np.where(tokens >= 0, pairs.keys(tokens, right, place[None, :]), NONE)
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    def put(row: np.ndarray, leaf: np.ndarray, key: np.ndarray) -> None:
        node = leaf + width
        tree[row, node] = key
        for _ in range(width.bit_length() - 1):
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def pair_key(row: np.ndarray, at: np.ndarray) -> np.ndarray:
        follows = after[row, at]
        inside = follows < width
        right = np.where(inside, tokens[row, np.minimum(follows, width - 1)], -1)
        return pairs.keys(tokens[row, at], right, at)

    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        root = tree[live, 1]
        at = root & ((1 << POSITION_BITS) - 1)
        gone = after[live, at]
        follows = after[live, gone]
        tokens[live, at] = root >> POSITION_BITS
        tokens[live, gone] = -1
        after[live, at] = follows
        inside = follows < width
        before[live[inside], follows[inside]] = at[inside]
        put(live, gone, np.full(len(live), NONE))
        put(live, at, pair_key(live, at))
        ahead = before[live, at]
        has = ahead >= 0
        put(live[has], ahead[has], pair_key(live[has], ahead[has]))
        live = live[tree[live, 1] < NONE]
    return tokens


class Bpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.pairs = PairRanks(ranks)
        self.cut = regex.compile(pattern)
        self.token = [b""] * self.pairs.size
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.memory = PartMemory(self.encode_parts)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, four bytes each."""
        found: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                found[i] = rank.to_bytes(4, "little")
            elif len(p) > WIDEST_ROW:
                found[i] = np.array(merge_one(self.byte_id[list(p)].tolist(), self.pairs), "<u4").tobytes()
            elif p:
                by_width.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, own in by_width.items():
            for first in range(0, len(own), ROWS):
                some = own[first : first + ROWS]
                flat = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in some), np.uint8).reshape(-1, width)
                length = np.array([len(pieces[i]) for i in some])
                tokens = np.where(np.arange(width) < length[:, None], self.byte_id[flat], -1)
                merged = merge_rows(tokens, self.pairs)
                kept = merged >= 0
                ids = merged[kept].astype("<u4").tobytes()
                ends = (np.cumsum(kept.sum(1)) * 4).tolist()
                for i, start, end in zip(some, [0, *ends], ends):
                    found[i] = ids[start:end]
        return found

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part of a text; equal pre-tokens are merged once."""
        cut = [self.cut.findall(p) for p in parts]
        pieces = list({piece for own in cut for piece in own})
        ids = dict(zip(pieces, self.encode_pieces([p.encode() for p in pieces])))
        return [ids[own[0]] if len(own) == 1 else b"".join(map(ids.__getitem__, own)) for own in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.memory.ids_of(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _worker_bpe(ranks: tuple[bytes, ...], pattern: str) -> Bpe:
    return Bpe({token: rank for rank, token in enumerate(ranks) if token}, pattern)


def rank_list(ranks: dict[bytes, int]) -> tuple[bytes, ...]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tuple(tokens)


def encoded_documents(
    docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """Each document's ids as an array, its number of ids, and digests of ids and of the decoded bytes.

    The rank file is read on the driver and sent along, so executors need not have it.
    """
    schema = T.StructType(
        fields(docs, key)
        + [
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return docs.select(key, text).mapInArrow(_coder(docs, ranks_path, pattern, schema, True), schema)


def encoded_digests(
    docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """As ``encoded_documents`` without the ids."""
    schema = T.StructType(
        fields(docs, key)
        + [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return docs.select(key, text).mapInArrow(_coder(docs, ranks_path, pattern, schema, False), schema)


def _coder(docs: DataFrame, ranks_path: str, pattern: str, schema: T.StructType, with_ids: bool):
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(rank_list(read_ranks(ranks_path)))

    def code_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept(_worker_bpe, shared.value, pattern)
        for b in batches:
            for own in blocks(b, 1):
                flat, reached = coder.memory.flat_ids_of(full_texts(own.column(1)))
                ends = np.append(0, reached)
                columns = [own.column(0)]
                if with_ids:
                    values = pa.array(flat.view(np.int32))
                    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values, type=arrow.field(1).type))
                raw, cuts = flat.tobytes(), (4 * ends).tolist()
                ids = [raw[start:end] for start, end in zip(cuts, cuts[1:])]
                columns += [
                    pa.array(np.diff(ends)),
                    [hashlib.sha256(i).hexdigest() for i in ids],
                    [hashlib.sha256(coder.decode(i)).hexdigest() for i in ids],
                ]
                yield batch(arrow, columns)

    return code_batches
