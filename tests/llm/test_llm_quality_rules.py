import random
import re
from collections import Counter

import corpus
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from packetloom.llm import quality_rules
from packetloom.llm.quality_rules import BAD, COUNTS, GOOD, RULES, WINDOW

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1))
    repeated = set()
    for i in range(len(words) - WINDOW + 1):
        if windows[tuple(words[i : i + WINDOW])] > 1:
            repeated.update(range(i, i + WINDOW))
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def texts():
    pick, found = random.Random(2), []
    for i in range(80):
        unit = pick.choice(["a b c ", "word ", "é# | ", "\n", "line one\nline one\n", corpus.prose(i, 9, 30) + " "])
        found.append("".join(pick.choices([unit, corpus.prose(i, 12, 40) + "\n", "\x1c \x85 x\xa0y "], k=pick.randrange(1, 30))))
    return found


def test_statistics_equal_brute_force(spark):
    docs = corpus.awkward(spark, texts())
    expected = sorted((str(r.doc_id), *brute(r.text or "")) for r in docs.collect())
    judged = quality_rules.quality_verdicts(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in judged) == expected
    for r in judged:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words(words):
    assert quality_rules.repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_estimation_finds_the_bad_ones():
    """Votes drawn from a known model: a fifth of the texts is bad, each known to one or two rules."""
    pick = np.random.default_rng(1)
    bad = pick.random(4000) < 0.2
    votes = np.where(pick.random((4000, len(RULES))) < 0.7, GOOD, 1)
    known = pick.integers(0, len(RULES), 4000)
    votes[bad, known[bad]] = BAD
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.estimate(patterns, counts.astype(float))
    p = model.posterior(votes)
    assert ((p < 0.5) == bad).mean() > 0.99 and 0.7 < model.prior < 0.95


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.quality_verdicts(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    # Short texts fail by the contract, whatever their label.
    judged = [(r.kept, r.quality == 1) for r in rows if r.n_words >= 20]
    assert sum(a == b for a, b in judged) >= 0.99 * len(judged)


def test_empty_table(spark):
    rows = quality_rules.quality_verdicts(corpus.empty(corpus.awkward(spark, ["a"])))
    assert rows.count() == 0 and set(COUNTS) <= set(rows.columns)
