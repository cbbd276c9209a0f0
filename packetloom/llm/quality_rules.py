"""Quality rules as weak supervision.

Each rule looks at the statistics of one text and votes good, bad or abstains.
Expectation-maximisation over all documents estimates how often each rule
votes what for good and for bad texts; the posterior probability of "good"
then decides, instead of a rule that all must pass. There are at most
3 ** len(RULES) different vote patterns, so what the estimation needs from the
corpus is one small table of counts, whatever its size.

Null and empty texts have no words: all counts are 0 and the text fails. Rows
are independent, repeated rows give repeated results. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import WHITESPACE, batch, blocks, byte_values, fields
from packetloom.session import materialise

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_FROM = 0.5
CONTINUATION = bytes(range(0x80, 0xC0))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_upper", "n_letters"]


# ------------------------------------------------------------ statistics of a text


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    n = len(words)
    if n <= width:
        return 0
    # Equal windows have equal fingerprints, so a text without equal ones is done.
    prints, step = np.fromiter(map(hash, words), np.int64, n).view(np.uint64), 1
    while step < width:
        prints = prints[:-step] * MULTIPLIER + prints[step:] + np.uint64(step)
        step *= 2
    prints.sort()
    if not (prints[1:] == prints[:-1]).any():
        return 0
    number = defaultdict(count().__next__)
    codes, step = np.fromiter(map(number.__getitem__, words), np.int64, n), 1
    while step < width:  # exact: a code stands for the words of one window
        pairs = codes[:-step] * (codes.max() + 1) + codes[step:]
        codes = np.unique(pairs, return_inverse=True)[1]
        step *= 2
    at = np.flatnonzero(np.bincount(codes)[codes] > 1)
    edges = np.zeros(n + 1, np.int64)
    edges[at] += 1
    edges[at + width] -= 1
    return int((np.cumsum(edges[:n]) > 0).sum())


def text_counts(data: bytes) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    words = data.split()
    n_chars = len(data.translate(None, WHITESPACE + CONTINUATION))
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in data.split(b"\n"):
        if line.strip(WHITESPACE):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(data) - len(data.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), n_chars, symbols, n_dup, repeated_words(words), len(set(words)), n_lines, upper, upper + lower


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of COUNTS for each row of ``docs``."""
    schema = T.StructType(fields(docs, key) + [T.StructField(c, T.LongType()) for c in COUNTS])
    arrow = to_arrow_schema(schema)

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in (block for b in batches for block in blocks(b, 1)):
            counts = np.array([text_counts(v) for v in byte_values(own.column(1))], np.int64).reshape(-1, len(COUNTS))
            yield batch(arrow, [own.column(0), *(pa.array(counts[:, i]) for i in range(len(COUNTS)))])

    return docs.select(key, text).mapInArrow(count_batches, schema)


# ----------------------------------------------------------------------- rules


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``value`` lies outside ``usual``, good inside ``ideal`` if there is one, and else abstains."""

    name: str
    value: str
    usual: tuple[float, float]
    ideal: tuple[float, float] | None = None

    def vote(self) -> Column:
        """0 bad, 1 abstain, 2 good; a value that is not defined abstains."""
        v = F.expr(self.value)
        vote = F.when((v < self.usual[0]) | (v > self.usual[1]), 0)
        if self.ideal:
            vote = vote.when(v.between(*self.ideal), 2)
        return F.coalesce(vote, F.lit(1))


BIG = float("inf")
RULES = (
    Rule("length", "n_words", (20, BIG), (50, 1e5)),
    Rule("repeated_windows", "n_repeat_words / nullif(n_words, 0)", (0, 0.3)),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", (0, 0.2)),
    Rule("duplicate_lines", "n_dup_lines / nullif(n_lines, 0)", (0, 0.4)),
    Rule("word_length", "word_chars / nullif(n_words, 0)", (2, 14), (3, 10)),
    Rule("distinct_words", "n_distinct / sqrt(nullif(n_words, 0))", (2, BIG)),
    Rule("capitals", "n_upper / nullif(n_letters, 0)", (0, 0.5)),
)
BAD, ABSTAIN, GOOD = range(3)


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts, and P(vote | good) and P(vote | bad) of each rule, in the order bad, abstain, good."""

    prior: float
    if_good: np.ndarray
    if_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(good) of each vote pattern."""
        rule = np.arange(votes.shape[1])
        gain = np.log(self.if_good[rule, votes] / self.if_bad[rule, votes]).sum(1)
        return 1 / (1 + np.exp(-(gain + np.log(self.prior / (1 - self.prior)))))


# Where the estimation starts: rules seldom call a good text bad, and each finds some of the bad ones.
START_GOOD = np.array([0.001, 0.399, 0.6])
START_BAD = np.array([0.25, 0.25, 0.5])
START_PRIOR = 0.9
START_SHARE = 0.1  # weight of the start, as a share of the documents
# P(bad vote | good) stays below the first and P(bad vote | bad) above the second: the classes cannot swap
# names, and a kind of junk that only one rule knows is not lost among the kinds that many rules know.
MAX_FALSE_ALARM = 0.001
MIN_FOUND = 0.2


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> VoteModel:
    """Expectation-maximisation over vote patterns with their counts."""
    k = votes.shape[1]
    model = VoteModel(START_PRIOR, np.tile(START_GOOD, (k, 1)), np.tile(START_BAD, (k, 1)))
    weight = 1 + START_SHARE * counts.sum()
    for _ in range(rounds):
        p = model.posterior(votes)
        tables = []
        for share, start, own in ((p, START_GOOD, START_PRIOR), (1 - p, START_BAD, 1 - START_PRIOR)):
            cast = np.stack([((votes == v) * (share * counts)[:, None]).sum(0) for v in (BAD, ABSTAIN, GOOD)], 1)
            table = cast + weight * own * start
            tables.append(table / table.sum(1, keepdims=True))
        for table, bad in zip(tables, (np.minimum(tables[0][:, BAD], MAX_FALSE_ALARM), np.maximum(tables[1][:, BAD], MIN_FOUND))):
            table[:, ABSTAIN:] *= ((1 - bad) / table[:, ABSTAIN:].sum(1))[:, None]
            table[:, BAD] = bad
        prior = ((p * counts).sum() + START_PRIOR * weight) / (counts.sum() + weight)
        model = VoteModel(float(np.clip(prior, 0.5, 0.99)), *tables)
    return model


def judged(statistics: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``base_failed``, ``p_good`` and ``kept`` to a table of text statistics that is read twice."""
    spark = statistics.sparkSession
    pattern = sum((r.vote() * 3**i for i, r in enumerate(rules)), F.lit(0))
    coded = statistics.withColumn("_votes", pattern)
    # At most 3 ** len(rules) rows, whatever the number of documents.
    rows = sorted((r[0], r[1]) for r in coded.groupBy("_votes").count().collect())
    codes = np.array([r[0] for r in rows], np.int64)
    votes = codes[:, None] // 3 ** np.arange(len(rules)) % 3
    p_good = estimate(votes, np.array([r[1] for r in rows], float)).posterior(votes) if rows else np.zeros(0)
    verdicts = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, p_good)], "_votes int, p_good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        coded.join(F.broadcast(verdicts), "_votes", "left")
        .drop("_votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM))
    )


def quality_verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics, posterior quality probability and verdict for each row of ``docs``.

    The statistics are written to the shared folder once; the estimation and
    the verdicts read that small table.
    """
    return judged(materialise(text_statistics(docs, key, text), "quality-statistics"))
