"""Audit of how much the sources of a language differ in their words.

In-mapper stripes: a task folds whole documents into one hash stripe per
language and term, the number of documents and the count in each source, and
spills its stripes when it holds SPILL_CELLS counts. Spilled stripes are merged
by key; terms in fewer than MIN_DOCUMENTS documents of a language go. Merged
stripes emit the divergences.

A source's probability of a term is smoothed, so a source without the term has
the same one for all such terms. The sum over all terms of f(p, q) for a pair
of sources is therefore taken as if neither had any term, plus what each term
of either one changes, plus what a term of both changes beyond that. Only
terms that two sources share make pairs, and only within their stripe.

All arithmetic is on 64-bit integers: a probability is at most 10^9 + 1, so a
square is at most 10^18, and the probabilities of a source add up to at most
10^9 + V, so no sum of f goes beyond about 10^18 for up to 10^9 terms. The
quotient of a count is taken digit by digit, which holds for 9 * 10^15 words
of a source and language; beyond, the job fails.

Null text, language and source are the empty text. Every language and source
that occurs is a group, also without a term; a language without a kept term
has pairs of value 0. Repeated rows count as rows. Without rows there are no
groups and no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.llm.arrow import blocks, byte_values
from packetloom.llm.storage import Scratch

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
SPILL_CELLS = 1_000_000  # counts that a task holds
SPILL_TERMS = 300_000  # distinct terms that a task holds
PAIR_CELLS = 1 << 19  # pairs of one step
MOST_WORDS = 9_000_000_000_000_000


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the exact integer sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *[np.add.reduceat(v[order], starts) if len(keys) else v for v in values]


class Numbers:
    """Numbers of values in the order they come."""

    def __init__(self):
        self.of: dict = {}

    def add(self, values: set) -> None:
        for v in values.difference(self.of):
            self.of[v] = len(self.of)

    def names(self) -> list:
        return list(self.of)


class HashStripes:
    """Counts of (language, term, source) and documents of (language, term), until they are spilled."""

    def __init__(self):
        self.groups, self.terms = Numbers(), Numbers()
        self.counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def fold(self, groups: list[tuple[str, str]], texts: list[bytes]) -> None:
        """Add whole documents of the given (language, source) groups."""
        split = [TERM.findall(t.lower()) for t in texts]
        flat = [w for words in split for w in words]
        self.terms.add(set(flat))
        self.groups.add(set(groups))
        number = self.terms.of
        term = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        row = np.repeat(np.arange(len(texts)), [len(w) for w in split])
        own = np.array([self.groups.of[g] for g in groups], np.int64)
        # One cell for each term of a document, then one for each term of a group.
        cell, count = summed((row << 32) | term, np.ones(len(term), np.int64))
        group = own[cell >> 32]
        found = summed((group << 32) | (cell & 0xFFFFFFFF), count, np.ones(len(cell), np.int64))
        self.counts.append(found)
        self.held += len(found[0])

    def merge(self) -> None:
        """Make one sorted run of all runs so far."""
        if len(self.counts) > 1:
            self.counts = [summed(*[np.concatenate(c) for c in zip(*self.counts)])]
            self.held = len(self.counts[0][0])

    def full(self) -> bool:
        if self.held >= SPILL_CELLS:
            self.merge()
        return self.held >= SPILL_CELLS // 2 or len(self.terms.of) >= SPILL_TERMS

    def spill(self) -> Iterator[pa.RecordBatch]:
        """The stripes as rows (lang, term, documents, sources, counts); the object is empty afterwards."""
        self.merge()
        if self.held:
            key, count, documents = self.counts[0]
            names, terms = self.groups.names(), np.array(self.terms.names(), object)
            group, term = key >> 32, key & 0xFFFFFFFF
            langs = Numbers()
            langs.add({lang for lang, _ in names})
            lang = np.array([langs.of[n[0]] for n in names], np.int64)[group]
            order = np.lexsort((group, term, lang))
            lang, term, group, count, documents = (a[order] for a in (lang, term, group, count, documents))
            starts = np.flatnonzero(np.append(True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])))
            documents = np.add.reduceat(documents, starts)
            ends = np.append(starts, len(key))
            sources = pa.DictionaryArray.from_arrays(pa.array(group), pa.array([n[1] for n in names], pa.string())).cast(pa.string())
            lang_names = pa.array(langs.names(), pa.string())
            for first in range(0, len(starts), 50_000):
                at = slice(first, first + 50_000)
                own = ends[first : first + 50_001]
                inside = slice(own[0], own[-1])
                offsets = pa.array((own - own[0]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        lang_names.take(pa.array(lang[starts[at]])),
                        pa.array(terms[term[starts[at]]].tolist(), pa.binary()).cast(pa.string()),
                        pa.array(documents[at]),
                        pa.ListArray.from_arrays(offsets, sources[inside]),
                        pa.ListArray.from_arrays(offsets, pa.array(count[inside])),
                    ],
                    names=["lang", "term", "documents", "sources", "counts"],
                )
        self.__init__()


def stripes(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """Spilled stripes of all documents."""

    def fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = HashStripes()
        for b in batches:
            for own in blocks(b, 2):
                held.fold(list(zip(own.column(0).to_pylist(), own.column(1).to_pylist())), byte_values(own.column(2)))
                if held.full():
                    yield from held.spill()
        yield from held.spill()

    return docs.select(lang, source, text).mapInArrow(
        fold_batches, "lang string, term string, documents long, sources array<string>, counts array<long>"
    )


def merged_stripes(spilled: DataFrame, least: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, cells) of the terms that enough documents of a language hold; cells are (source, n)."""
    cells = spilled.select("lang", "term", "documents", F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "c"))
    cells = cells.select(
        "lang",
        "term",
        F.col("c.sources").alias("source"),
        F.col("c.counts").alias("n"),
        # The documents of a spilled stripe ride on its first cell.
        F.when(F.col("at") == 0, F.col("documents")).otherwise(F.lit(0)).alias("documents"),
    )
    counted = cells.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    joined = counted.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("cells")
    )
    return joined.where(F.col("documents") >= least).drop("documents")


# ---------------------------------------------------------------- probabilities


def probability_sql(count: str, total: str) -> str:
    """1 + floor(10^9 * (count + 1) / total), three digits at a time so that nothing overflows; count < total."""
    whole, rest, digits = "0L", f"({count} + 1L)", []
    for _ in range(3):
        digits.append(f"(({rest} * 1000L) div {total})")
        rest = f"(({rest} * 1000L) % {total})"
    whole = f"({digits[0]} * 1000000L + {digits[1]} * 1000L + {digits[2]})"
    return f"1L + {whole}"


def divergence_sql(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def group_totals(groups: DataFrame, merged: DataFrame) -> DataFrame:
    """(lang, source) of every group with total, the words of kept terms, v, the terms, lang_total, and p0, the probability of no word."""
    terms = merged.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    words = merged.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = groups.join(words, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["total", "v"])
    langs = known.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    most = F.col("lang_total") + F.col("v")
    checked = F.when(most <= MOST_WORDS, most).otherwise(F.raise_error(F.lit(f"a language has more than {MOST_WORDS} words")))
    known = known.join(langs, "lang").withColumn("_most", checked).where(F.col("_most") >= 0).drop("_most")
    return known.withColumn("p0", F.when(F.col("v") > 0, F.expr(probability_sql("0L", "(total + v)"))))


def probabilities(merged: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, term, source, p, q, p0) of each term in each source that has it; q is the language's probability."""
    in_lang = F.aggregate("cells", F.lit(0).cast("long"), lambda n, c: n + c["n"])
    cells = merged.select("lang", "term", in_lang.alias("lang_n"), F.inline("cells")).join(totals, ["lang", "source"])
    return cells.select(
        "lang",
        "term",
        "source",
        F.expr(probability_sql("n", "(total + v)")).alias("p"),
        F.expr(probability_sql("lang_n", "(lang_total + v)")).alias("q"),
        "p0",
    )


# ------------------------------------------------------------------ divergences


def term_divergences(cells: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The terms of each group that diverge most upwards from the language."""
    found = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(divergence_sql("p", "q")).alias("value"))
    return ranked(found, "term").where(F.col("rank") <= top)


def ranked(found: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _shared_in(lang: pa.Array, cells: pa.ListArray, groups: Numbers) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of ordered pairs of groups and what their common terms add, in steps of about PAIR_CELLS pairs."""
    inner = cells.flatten()
    source = inner.field("source").dictionary_encode()
    p, p0 = (inner.field(n).to_numpy(zero_copy_only=False) for n in ("p", "p0"))
    size = np.diff(cells.offsets.to_numpy())
    row = np.repeat(np.arange(len(size)), size)
    start, reach = (np.cumsum(size) - size)[row], size[row]
    langs = lang.dictionary_encode()
    code = (langs.indices.to_numpy().astype(np.int64)[row] << 32) | source.indices.to_numpy()
    kinds, kind = np.unique(code, return_inverse=True)
    lang_names, source_names = langs.dictionary.to_pylist(), source.dictionary.to_pylist()
    names = [(lang_names[c >> 32], source_names[c & 0xFFFFFFFF]) for c in kinds.tolist()]
    groups.add(set(names))
    group = np.array([groups.of[n] for n in names], np.int64)[kind]
    upto = np.cumsum(reach)
    first = 0
    while first < len(row):
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + PAIR_CELLS, "right")))
        own = np.arange(first, last)
        a = np.repeat(own, reach[own])
        b = np.arange(len(a)) - np.repeat(upto[own] - reach[own] - before, reach[own]) + start[a]
        a, b = a[a != b], b[a != b]
        extra = divergences(p[a], p[b]) - divergences(p[a], p0[b]) - divergences(p0[a], p[b]) + divergences(p0[a], p0[b])
        yield summed((group[a] << 32) | group[b], extra)
        first = last


def shared_terms(cells: DataFrame) -> DataFrame:
    """(lang, source, item, value): what the terms that both sources have add to the sum of a pair."""
    columns = ["lang", "source", "item", "value"]

    def pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, runs, held = Numbers(), [], 0

        def spill() -> pa.RecordBatch:
            key, value = summed(*[np.concatenate(c) for c in zip(*runs)])
            names = groups.names()
            a, b = [names[i] for i in (key >> 32).tolist()], [names[i] for i in (key & 0xFFFFFFFF).tolist()]
            text = [pa.array(v, pa.string()) for v in ([n[0] for n in a], [n[1] for n in a], [n[1] for n in b])]
            return pa.RecordBatch.from_arrays([*text, pa.array(value)], names=columns)

        for b in batches:
            for run in _shared_in(b.column(0), b.column(1), groups):
                runs.append(run)
                held += len(run[0])
                if held >= SPILL_CELLS:
                    runs = [summed(*[np.concatenate(c) for c in zip(*runs)])]
                    held = len(runs[0][0])
                if held >= SPILL_CELLS // 2:
                    yield spill()
                    groups, runs, held = Numbers(), [], 0
        if held:
            yield spill()

    together = cells.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("cells"))
    return together.where(F.size("cells") > 1).select("lang", "cells").mapInArrow(
        pair_batches, "lang string, source string, item string, value long"
    )


def pair_divergences(cells: DataFrame, totals: DataFrame) -> DataFrame:
    """The sum of f over all kept terms for each ordered pair of sources of a language."""
    one = totals.select("lang", "source", F.col("p0").alias("a0"), "v")
    other = totals.select("lang", F.col("source").alias("item"), F.col("p0").alias("b0"))
    none = divergence_sql("a0", "b0")
    pairs = one.join(other, "lang").where(F.col("source") != F.col("item"))
    nothing = pairs.select("lang", "source", "item", F.expr(f"coalesce(v * ({none}), 0L)").alias("value"))

    # A source has few distinct probabilities, so its terms are counted by them first.
    counted = cells.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("n"))
    of_one = counted.withColumnRenamed("p0", "a0").join(other, "lang").where(F.col("source") != F.col("item"))
    of_other = counted.withColumnsRenamed({"source": "item", "p0": "b0"}).join(one, "lang").where(F.col("source") != F.col("item"))

    def changed(df: DataFrame, p: str, q: str) -> DataFrame:
        value = F.sum(F.expr(f"n * (({divergence_sql(p, q)}) - ({none}))"))
        return df.groupBy("lang", "source", "item").agg(value.alias("value"))

    parts = [nothing, changed(of_one, "p", "b0"), changed(of_other, "a0", "p"), shared_terms(cells)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return ranked(union.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")


def source_divergences(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    *,
    least: int = MIN_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): all pairs of sources, and the ``top`` terms of each source."""
    empty = F.lit("")
    docs = docs.select(F.coalesce(lang, empty).alias("lang"), F.coalesce(source, empty).alias("source"), F.col(text).alias("text"))
    scratch = Scratch(docs.sparkSession, "source-divergence")
    merged = scratch.keep(merged_stripes(stripes(docs, "lang", "source", "text"), least), "merged")
    totals = scratch.keep(group_totals(docs.select("lang", "source").distinct(), merged), "totals")
    cells = scratch.keep(probabilities(merged, totals), "cells")
    scratch.drop("merged")
    return pair_divergences(cells, totals).unionByName(term_divergences(cells, top))
