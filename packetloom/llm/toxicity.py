"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms (runs of ASCII letters and of characters beyond
ASCII, A-Z in lower case), each hashed to one of BUCKETS. The machine adds a
weight per term and, for each pair of terms of the text, the inner product of
their factor vectors, so that two terms can mean together what neither means
alone. All pairs of a text cost as much as its terms: half of |sum v|^2 - sum |v|^2.

The fit is bounded: at most FIT_ROWS labelled documents and about FIT_CELLS of
their terms, both chosen by a hash of the key, reach the driver. A first phase
chooses terms: a penalty at NOISE standard deviations of what a term without
meaning would show cuts all others to zero. It runs twice, over the weights of
all terms of MIN_ROWS documents, and over weights and factor vectors of those
that PAIR_SHARE of the documents hold, which finds terms that only mean
something in pairs. A second phase fits weights and vectors of the terms found
with a small ridge. Documents with the same terms and label count once. A fifth
of the sample is kept from both fits: it chooses between them by log loss and
places the cut, so that the score is 0.5 where it parts that fifth best.

Only labels of documents outside the held-out fold are read, and nothing but
the text makes a score. Scoring is one pass over whole texts; a 20 MB text is
one batch. Null, empty and term-free texts score as the bias alone, repeated
rows score alike, repeated labels of a key count as toxic if one says so, and
null labels are none. Without labels, or with one class only, no term has a
weight and the score is the share of toxic ones, kept within 0.001 and 0.999.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, blocks, byte_values, fields, plain_names
from packetloom.llm.storage import Scratch

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
BUCKETS = 1 << 22
FIT_ROWS = 20_000  # labelled documents that may reach the driver
FIT_CELLS = 3_000_000  # their terms, about
FACTORS = 8
MIN_ROWS = 3
NOISE = 4.5
RIDGE = 0.1
FIRST_ROUNDS, SECOND_ROUNDS = 50, 150
STEP = 0.4
PAIR_SHARE = 0.01  # of the rows must hold a term that gets a factor vector
SEED = 11
TERM_MEMORY = 500_000
HELD_OUT_FOLD, FOLDS = 0, 5


@dataclass(frozen=True)
class Machine:
    """Sorted buckets with their weights and factor vectors; the bias holds the cut."""

    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float


class TermBuckets:
    """Buckets of terms, remembered up to TERM_MEMORY terms."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: bytes) -> np.ndarray:
        """The distinct buckets of a text, sorted."""
        terms = set(TERM.findall(text.lower()))
        if len(self.known) > TERM_MEMORY:
            self.known.clear()
        for t in terms.difference(self.known):
            self.known[t] = xxhash.xxh64_intdigest(t) % BUCKETS
        return np.unique(np.fromiter(map(self.known.__getitem__, terms), np.int32, len(terms)))


# ------------------------------------------------------------------------- fit


def _bias(labels: np.ndarray) -> float:
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 0.001, 0.999))
    return float(np.log(share / (1 - share)))


def _sums(machine: Machine, place: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Margins of the rows whose terms stand at ``place``, and the sums of their factor vectors."""
    weights, factors = machine.weights, machine.factors
    held = factors.any(axis=1)[place]
    at, of = place[held], owner[held]
    together = np.stack([np.bincount(of, factors[at, f], rows) for f in range(factors.shape[1])], 1)
    alone = np.bincount(of, (factors**2).sum(axis=1)[at], rows)
    pairs = ((together**2).sum(axis=1) - alone) / 2
    return machine.bias + np.bincount(owner, weights[place], rows) + pairs, together


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _descend(
    machine: Machine, place: np.ndarray, owner: np.ndarray, labels: np.ndarray, *, rounds: int, noise: float, factors: bool
) -> Machine:
    """Proximal descent over all rows with a step of its own per term, on the weights and, if asked, the factor vectors.

    ``noise`` is the size, in standard deviations of a term without meaning,
    that is cut to zero; 0 means a ridge instead.
    """
    rows, terms, k = len(labels), len(machine.weights), machine.factors.shape[1]
    ridge = 0.0 if noise else RIDGE
    share = labels.mean()
    spread = share * (1 - share)
    weight_cut = noise * np.sqrt(np.bincount(place, minlength=terms) * spread) / rows
    weight_path, factor_path, bias_path = np.full(terms, 1e-12), np.full(terms, 1e-12), 1e-12
    for turn in range(rounds):
        w, v = machine.weights, machine.factors
        margin, together = _sums(machine, place, owner, rows)
        error = _chance(margin) - labels
        by_term = np.bincount(place, error[owner], terms)
        if factors:
            pull = np.stack([np.bincount(place, (error * together[:, f])[owner], terms) for f in range(k)], 1)
            gradient = (pull - v * by_term[:, None] + ridge * v) / rows
            factor_path += (gradient**2).sum(axis=1)
            step = STEP / np.sqrt(factor_path)
            moved = v - step[:, None] * gradient
            # A pair shows only when both of its vectors have grown, so this cut comes slowly.
            cut = min(1.0, 2 * turn / rounds) * noise * np.sqrt(spread * np.bincount(place, (together**2).sum(axis=1)[owner], terms))
            size = np.sqrt((moved**2).sum(axis=1))
            v = moved * np.maximum(1 - step * cut / rows / np.maximum(size, 1e-12), 0)[:, None]
        gradient = (by_term + ridge * w) / rows
        weight_path += gradient**2
        step = STEP / np.sqrt(weight_path)
        moved = w - step * gradient
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * weight_cut, 0)
        bias_path += error.mean() ** 2
        machine = Machine(machine.buckets, w, v, float(machine.bias - STEP * error.mean() / np.sqrt(bias_path)))
    return machine


def _kept(machine: Machine, kept: np.ndarray, place: np.ndarray, owner: np.ndarray) -> tuple[Machine, np.ndarray, np.ndarray]:
    """The machine and the cells of the terms that are kept."""
    smaller = Machine(machine.buckets[kept], machine.weights[kept], machine.factors[kept], machine.bias)
    held = kept[place]
    return smaller, (np.cumsum(kept) - 1)[place[held]], owner[held]


def fit_machine(cells: Sequence[np.ndarray], labels: Sequence[int], factors: int = FACTORS, *, pairs_first: bool = False) -> Machine:
    """Fit on rows of sorted buckets with 0/1 labels. With no factors it is an additive model.

    Terms are chosen by what they mean alone, or with ``pairs_first`` by what
    frequent ones mean alone or in pairs; those chosen are fitted together.
    """
    first = {}
    for i, own in enumerate(cells):
        first.setdefault((own.tobytes(), labels[i]), i)
    chosen = sorted(first.values())
    y = np.array([labels[i] for i in chosen], float)
    k = max(factors, 1)
    nothing = Machine(np.zeros(0, np.int32), np.zeros(0), np.zeros((0, k)), _bias(y))
    if len(set(y)) < 2:
        return nothing
    flat = np.concatenate([cells[i] for i in chosen])
    owner = np.repeat(np.arange(len(chosen)), [len(cells[i]) for i in chosen])
    buckets, place, rows = np.unique(flat, return_inverse=True, return_counts=True)
    noise = np.random.default_rng(SEED)

    def drawn(n: int, size: float) -> np.ndarray:
        return noise.normal(0, size, (n, k)) if factors else np.zeros((n, k))

    pairs = bool(factors) and pairs_first
    machine = Machine(buckets, np.zeros(len(buckets)), np.zeros((len(buckets), k)), _bias(y))
    machine, place, owner = _kept(machine, rows >= (max(MIN_ROWS, PAIR_SHARE * len(y)) if pairs else MIN_ROWS), place, owner)
    if pairs:
        machine = Machine(machine.buckets, machine.weights, drawn(len(machine.buckets), 0.05), machine.bias)
    machine = _descend(machine, place, owner, y, rounds=FIRST_ROUNDS, noise=NOISE, factors=pairs)
    machine, place, owner = _kept(machine, (machine.weights != 0) | machine.factors.any(axis=1), place, owner)
    if not len(machine.buckets):
        return nothing
    machine = Machine(machine.buckets, machine.weights, drawn(len(machine.buckets), 0.1), machine.bias)
    return _descend(machine, place, owner, y, rounds=SECOND_ROUNDS, noise=0.0, factors=bool(factors))


def log_loss(margin: np.ndarray, labels: np.ndarray) -> float:
    chance = np.clip(_chance(margin), 1e-12, 1 - 1e-12)
    return float(-np.log(np.where(labels == 1, chance, 1 - chance)).mean()) if len(labels) else 0.0


def best_machine(cells: Sequence[np.ndarray], labels: Sequence[int], is_test: Sequence[bool], factors: int = FACTORS) -> Machine:
    """Fit both ways on the rows that are no test rows; the test rows choose one and place its cut."""
    fit, test = [i for i, t in enumerate(is_test) if not t], [i for i, t in enumerate(is_test) if t]
    test_cells, test_labels = [cells[i] for i in test], np.array([labels[i] for i in test], float)
    ways = [
        fit_machine([cells[i] for i in fit], [labels[i] for i in fit], factors, pairs_first=first)
        for first in ([False, True] if factors else [False])
    ]
    best = min(ways, key=lambda m: log_loss(margins(m, test_cells), test_labels))
    return with_cut(best, margins(best, test_cells), test_labels)


def margins(machine: Machine, cells: Sequence[np.ndarray]) -> np.ndarray:
    """Log odds of rows of sorted buckets."""
    owner = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    flat = np.concatenate([*cells, np.zeros(0, np.int32)]).astype(np.int64)
    place = np.searchsorted(machine.buckets, flat)
    held = place < len(machine.buckets)
    held[held] = machine.buckets[place[held]] == flat[held]
    return _sums(machine, place[held], owner[held], len(cells))[0]


def with_cut(machine: Machine, margin: np.ndarray, labels: np.ndarray) -> Machine:
    """Move the bias so that 0.5 parts the labels with the best F1; among equal cuts, the middle of the widest gap."""
    if len(set(labels)) < 2 or not len(machine.buckets):
        return machine
    order = np.argsort(-margin, kind="stable")
    found = np.cumsum(labels[order])
    f1 = 2 * found / (np.arange(1, len(order) + 1) + labels.sum())
    value = np.append(margin[order], margin.min() - 1)
    gap = value[:-1] - value[1:]
    f1[gap <= 0] = -1
    best = max(np.flatnonzero(f1 == f1.max()), key=lambda i: gap[i])
    return Machine(machine.buckets, machine.weights, machine.factors, machine.bias - float(value[best] + value[best + 1]) / 2)


# ----------------------------------------------------------------------- Spark


def held_out(key: Column) -> Column:
    """Whether a key is in the fold whose labels are never read. A null key is the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD


def label_sample(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled keys outside the held-out fold, by hash."""
    own = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    own = own.groupBy(F.col(key).alias("_label_key")).agg(F.max(F.col(label)).cast("int").alias("_label"))
    return own.orderBy(F.xxhash64("_label_key"), "_label_key").limit(rows)


def term_sets(rows: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and the distinct buckets of each text as 32-bit numbers in bytes."""
    schema = T.StructType([*fields(rows, *keep), T.StructField("_cells", T.BinaryType())])
    arrow, n = to_arrow_schema(schema), len(keep)

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = TermBuckets()
        for b in batches:
            for own in blocks(b, n):
                cells = [terms.of(t).astype("<i4").tobytes() for t in byte_values(own.column(n))]
                yield batch(arrow, [own.column(i) for i in range(n)] + [cells])

    return rows.select(*keep, text).mapInArrow(read_batches, schema)


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    *,
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
    fit_cells: int = FIT_CELLS,
    factors: int = FACTORS,
) -> Machine:
    """The machine, fitted on the bounded sample of labelled documents."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    # At most FIT_ROWS keys and labels.
    sample = F.broadcast(scratch.keep(label_sample(labels, key, label, fit_rows), "labels"))
    rows = docs.join(sample, F.col(key) == F.col("_label_key")).select("_label_key", "_label", F.col(text).alias("_text"))
    cells = scratch.keep(term_sets(rows, "_text", ["_label_key", "_label"]), "cells")
    total = cells.agg(F.sum(F.length("_cells")).alias("n")).first()["n"] or 0
    share = min(1.0, fit_cells * 4 / max(total, 1))
    scale = 1 << 30
    chosen = cells.where(F.pmod(F.xxhash64("_label_key", F.lit(SEED)), F.lit(scale)) < F.lit(int(share * scale)))
    part = F.pmod(F.xxhash64("_label_key", F.lit(SEED + 1)), F.lit(5)) == 0
    found = chosen.select("_label", "_cells", part.alias("_is_test")).orderBy("_label_key", "_cells").collect()
    scratch.drop("labels", "cells")
    own = [np.frombuffer(r["_cells"], "<i4") for r in found]
    return best_machine(own, [r["_label"] for r in found], [r["_is_test"] for r in found], factors)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    *,
    fit_rows: int = FIT_ROWS,
    fit_cells: int = FIT_CELLS,
    factors: int = FACTORS,
) -> DataFrame:
    """Each row's key, whether its fold is held out, its score from 0 to 1, and 1 where that is 0.5 or more."""
    docs, (own_key, own_text) = plain_names(docs, key, text)
    labels = labels.select(F.col(key).alias(own_key), F.col(label).alias("_toxic"))
    machine = fitted(
        docs, labels, own_key, own_text, label="_toxic", fit_rows=fit_rows, fit_cells=fit_cells, factors=factors
    )
    schema = T.StructType([*fields(docs, own_key), T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, machine = TermBuckets(), shared.value
        for b in batches:
            for own in blocks(b, 1):
                cells = [terms.of(t) for t in byte_values(own.column(1))]
                yield batch(arrow, [own.column(0), pa.array(_chance(margins(machine, cells)))])

    scored = docs.select(own_key, own_text).mapInArrow(score_batches, schema)
    return scored.select(
        F.col(own_key).alias(key),
        held_out(F.col(own_key)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
