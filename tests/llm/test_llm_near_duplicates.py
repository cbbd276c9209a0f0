import random
from itertools import combinations

import corpus
import numpy as np

from packetloom.llm import near_duplicates
from packetloom.llm.components import connected_components

SPACE = " \t\n\x0b\x0c\r"


def shingles(text, width=2):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in SPACE else c for c in lower).split(" ")
    words = [w for w in words if w]
    last = max(1, len(words) - width + 1)
    return frozenset(tuple(words[i : i + width]) for i in range(last)) if words else frozenset()


def brute(rows):
    """doc_id -> (size of the set, smallest id reachable)."""
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            group[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def texts():
    pick, found = random.Random(1), []
    for g in range(12):
        words = corpus.words(g, pick.choice([4, 5, 12, 40, 200]), 3000)
        for _ in range(pick.randrange(1, 12)):
            found.append(" ".join(words))
            words = list(words)
            for _ in range(pick.randrange(0, 1 + len(words) // 15)):  # chains of copies of copies
                words[pick.randrange(len(words))] = f"n{pick.randrange(10**6)}"
    return found + ["one", "One", "two words", "TWO  words", "É x", "é x", "a b c d e f", "a b c d e g", "a b c d e"]


def test_equals_brute_force(spark):
    rows = list(enumerate(texts())) + [(5001, None), (5002, " \n"), (5003, "")]
    expected = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs).collect()}
    assert found == expected
    kept = {r.doc_id for r in near_duplicates.one_of_each_group(docs).collect()}
    assert kept == {i for i, (_, c) in expected.items() if i == c}


def test_links_inside_a_crowd_of_unlinked_documents(spark):
    """Many documents that share half their words, and one pair among them that is linked."""
    base = corpus.words(1, 120, 10**6)
    rows = []
    for i in range(40):
        own = corpus.words(100 + i, 50, 10**6)
        rows.append((i, " ".join(base[:70] + own)))
    rows.append((99, rows[33][1] + " end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert found == {i: c for i, (_, c) in brute(rows).items()} and found[99] == 33


def test_awkward_rows(spark):
    docs = corpus.awkward(spark, [corpus.prose(1, 50), corpus.prose(1, 50) + " more", "single"])
    rows = near_duplicates.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert {r.component_id for r in rows if r.doc_id in (0, 1)} == {0}
    kept = near_duplicates.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(0) == 1 and ids.count(1) == 0 and ids.count(2) == 1 and ids.count(None) == 1
    assert near_duplicates.near_duplicates(corpus.empty(docs)).count() == 0
    assert near_duplicates.one_of_each_group(corpus.empty(docs)).count() == 0


def test_densified_slots_agree_as_often_as_sets_do():
    pick = np.random.default_rng(0)
    agree = []
    for _ in range(60):
        both, only = pick.integers(0, 2**63, 40).astype(np.uint64), pick.integers(0, 2**63, 10).astype(np.uint64)
        a = near_duplicates.signature(np.unique(both))
        b = near_duplicates.signature(np.unique(np.concatenate([both, only])))
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 0.8) < 0.03


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    found = {r.v: r.component for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_shingles_of_five_words(spark):
    """Fifteen scattered edits in 500 words: 0.89 at two words, 0.74 at five."""
    words = corpus.words(7, 500, 10**6)
    rows = [(1, " ".join(words)), (3, "a b c d e f g h i j"), (4, "a b c d e f g h i j k"), (5, "x y z"), (6, "x y z"), (7, "x y w")]
    for i in range(15):
        words[20 + 30 * i] = f"n{i}"
    rows.append((2, " ".join(words)))

    def five(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {i: five(t) for i, t in rows}
    expected = {i for i in sets if not any(j < i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in sets)}
    assert expected == {1, 2, 3, 5, 7}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in near_duplicates.one_of_each_group(docs, width=5).collect()} == expected


def test_rows_of_one_group_that_share_their_key(spark):
    """One row of a group stays, whether its rows share key, text or both; rows without words and other groups all stay."""
    text, other, third = (corpus.prose(i, 60, 5000) for i in (5, 6, 7))
    near = text + " one"
    rows = [(1, text), (1, near), (2, text), (None, near), (3, ""), (3, ""), (3, None), (4, other), (1, third), (None, "a b c"), (None, "d e f")]
    for more in ([], [(1, text), (1, near)], [(4, other), (None, "a b c")]):
        docs = spark.createDataFrame(rows + more, "doc_id long, text string")
        kept = [(r.doc_id, r.text or "") for r in near_duplicates.one_of_each_group(docs).collect()]
        assert sum(t in (text, near) for _, t in kept) == 1
        rest = [(i or 0, t) for i, t in kept if t not in (text, near)]
        assert sorted(rest) == sorted([(3, ""), (3, ""), (3, ""), (4, other), (1, third), (0, "a b c"), (0, "d e f")])
