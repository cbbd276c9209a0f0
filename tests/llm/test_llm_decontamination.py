import random
import re

import corpus
import pytest

from packetloom.llm import decontamination
from packetloom.llm.decontamination import WINDOW

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(doc, items):
    own, hit, names = words(doc), set(), set()
    for name, text in items:
        w = words(text)
        size = min(WINDOW, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                names.add("" if name is None else str(name))
    return len(own), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(own)


ITEMS = [(i, corpus.prose(i, 10 + 3 * i, 60)) for i in range(15)] + [
    (100, "one"), (101, "two words"), (102, "w1 w2 w3"), (103, ""), (104, None), (None, "a benchmark without id w5 w6"), (20, "É ü ß 12-13"),
    (7, corpus.prose(7, 31, 60)), (7, "another text of item seven"), (21, "w1 " * 40),
]


def documents():
    pick, found = random.Random(6), []
    for i in range(150):
        own = corpus.words(i + 500, pick.randrange(1, 200), 60)
        item = words(pick.choice(ITEMS)[1])
        at = pick.randrange(len(own))
        part = item[pick.randrange(0, 5) :][: pick.randrange(5, 40)]
        found.append("; ".join(own[:at] + [p.upper() for p in part] + own[at:]))
    return found + ["One.", "É ü ß 12_13 x", "w1 " * 13, "w1 " * 12]


@pytest.mark.parametrize("group_words", [decontamination.GROUP_WORDS, 150])
def test_equals_brute_force(spark, group_words):
    docs = corpus.awkward(spark, documents())
    benchmark = spark.createDataFrame([*ITEMS, ITEMS[3]], "item_id long, text string")
    found = decontamination.contaminated_documents(docs, benchmark, group_words=group_words).collect()
    expected = sorted((str(r.doc_id), *brute(r.text, ITEMS)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found) == expected
    assert any(e[4] for e in expected) and not all(e[4] for e in expected)
    kept = decontamination.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not e[4] for e in expected)


def test_empty_tables(spark):
    docs = corpus.awkward(spark, documents()[:5])
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = decontamination.contaminated_documents(docs, benchmark.limit(0))
    assert none.count() == docs.count() and none.where("n_hit > 0 OR contaminated").count() == 0
    assert decontamination.contaminated_documents(docs.limit(0), benchmark).count() == 0


def test_a_rare_shingle_is_the_prefix():
    index = decontamination.WindowIndex.build([("a", b"x x x y z")], window=5)
    window, offset, code = index.shingles()
    frequency = {int(c): 100 if o == 0 else 1 + int(o) for o, c in zip(offset, code)}
    prefix = decontamination.PrefixIndex.build(index, frequency)
    assert prefix.offset.tolist() == [1]
    frequency[int(code[offset == 2][0])] = 0
    assert len(decontamination.PrefixIndex.build(index, frequency).codes) <= 1
