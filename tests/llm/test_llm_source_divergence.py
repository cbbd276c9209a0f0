import random
import re
from collections import Counter, defaultdict

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from packetloom.llm import source_divergence
from packetloom.llm.source_divergence import HashStripes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least=3, top=200):
    """All rows of the result from (lang, source, text) rows, with Python's integers."""
    rows = [(lang or "", source or "", TERM.findall(lower(text))) for lang, source, text in rows]
    found = set()
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        documents = Counter(t for r in own for t in set(r[2]))
        kept = sorted(t for t, n in documents.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if documents[t] >= least)

        def chances(count):
            total = sum(count.values()) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        q = chances(sum(counts.values(), Counter()))
        p = {s: chances(counts[s]) for s in counts}

        def f(a, b):
            return (a - b) ** 2 // b

        for s in p:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in p if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:most])}
    return found


def rows(n=150):
    pick = random.Random(4)
    made = []
    for i in range(n):
        source = pick.choice(["a", "a", "a", "b", "c", None, "", "Ünï"])
        text = pick.choice([corpus.prose(i, 40, 60), corpus.prose(i, 5, 8).upper() + " É_é9x", "", None, "12 34", corpus.prose(3, 30, 50)])
        made.append((pick.choice(["en", "de", None]), source, text))
    made += [("xx", "only", "alone"), ("yy", "p", "one two"), ("yy", "q", None)]
    return made + [("en", "a", "long word " * 50_000)] * 3


@pytest.mark.parametrize("spill", [1 << 20, 64])
def test_equals_brute_force(spark, monkeypatch, spill):
    """Small memories make many spilled stripes and many steps; the result is the same."""
    monkeypatch.setattr(source_divergence, "SPILL_CELLS", spill)
    monkeypatch.setattr(source_divergence, "SPILL_TERMS", spill)
    monkeypatch.setattr(source_divergence, "PAIR_CELLS", 16 if spill == 64 else 1 << 19)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows()], "lang string, source string, text string, value int, rank int").repartition(5)
    found = source_divergence.source_divergences(docs)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in found.collect()} == brute(rows()) and found.count() == len(brute(rows()))
    few = source_divergence.source_divergences(docs, top=2)
    assert {tuple(r) for r in few.collect()} == brute(rows(), top=2)


def test_stripes_spill_and_empty_themselves():
    held = HashStripes()
    held.fold([("en", "a"), ("en", "b"), ("de", "a")], [b"x y x", b"x", b"x"])
    held.fold([("en", "a")], [b"X z"])
    batches = list(held.spill())
    assert not held.held and list(held.spill()) == []
    found = {(r["lang"], r["term"]): (r["documents"], dict(zip(r["sources"], r["counts"]))) for b in batches for r in pa.Table.from_batches([b]).to_pylist()}
    assert found == {
        ("en", "x"): (3, {"a": 3, "b": 1}),
        ("en", "y"): (1, {"a": 1}),
        ("en", "z"): (1, {"a": 1}),
        ("de", "x"): (1, {"a": 1}),
    }


def test_large_counts(spark):
    """Quotients of counts whose product with 10^9 fits no 64 bits."""
    values = [(n, t) for t in (1, 7, 10**6 + 3, 8 * 10**15) for n in (0, t // 3, t - 1)]
    table = spark.createDataFrame(values, "n long, t long")
    sql = source_divergence.probability_sql("n", "t")
    for n, t, p in table.select("n", "t", F.expr(sql)).collect():
        assert p == 1 + 10**9 * (n + 1) // t
    keys, sums = source_divergence.summed(np.array([3, 1, 3]), np.array([2**60, 5, 2**60 + 1]))
    assert keys.tolist() == [1, 3] and sums.tolist() == [5, 2**61 + 1]


def test_empty_table(spark):
    docs = spark.createDataFrame(rows()[:3], "lang string, source string, text string").limit(0)
    assert source_divergence.source_divergences(docs).count() == 0
