import zlib

import corpus
import numpy as np
import pytest

from packetloom.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def test_held_out_labels_of_the_tables(spark):
    """Precision and recall in the fold whose labels are never read; its labels change no score."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity_scores(docs, labels)
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    known = [(r.toxic, rows[r.doc_id]) for r in labels.collect() if rows[r.doc_id].held_out]
    hit = sum(t and r.predicted for t, r in known)
    assert hit >= 0.85 * sum(t for t, _ in known) and hit >= 0.9 * sum(r.predicted for _, r in known)


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.held_out(labels.doc_id)
    other = labels.withColumn("toxic", (labels.toxic + held.cast("int")) % 2)
    scores = [{r.doc_id: r.score for r in toxicity.toxicity_scores(docs, given).collect()} for given in (labels, other)]
    assert scores[0] == scores[1]


def pairs(n, seed):
    """Toxic is an insult with a group or praise with a rival: no term means anything alone."""
    pick = np.random.default_rng(seed)
    rows, labels = [], []
    for _ in range(n):
        a, b = pick.integers(2, size=2)
        terms = [*(40 + pick.choice(900, 15, replace=False)), a * 10 + pick.integers(10), 20 + b * 10 + pick.integers(10)]
        rows.append(np.unique(terms).astype(np.int32))
        labels.append(int(a == b))
    return rows, labels


def test_pairs_that_additive_weights_miss():
    rows, labels = pairs(3000, 1)
    test_rows, test_labels = pairs(1000, 2)
    right = {}
    for factors in (0, toxicity.FACTORS):
        machine = toxicity.best_machine(rows, labels, [i % 5 == 0 for i in range(len(rows))], factors)
        right[factors] = ((toxicity.margins(machine, test_rows) >= 0) == np.array(test_labels)).mean()
    assert right[0] < 0.6 and right[toxicity.FACTORS] > 0.95


def test_margins_equal_all_pairs():
    pick = np.random.default_rng(0)
    machine = toxicity.Machine(np.arange(3, 300, 3), pick.normal(size=99), pick.normal(size=(99, 4)), 0.3)
    rows = [np.unique(pick.choice(400, n)) for n in (0, 1, 5, 60)]
    for row, margin in zip(rows, toxicity.margins(machine, rows)):
        own = [i // 3 - 1 for i in row if i % 3 == 0 and 3 <= i < 300]
        total = 0.3 + sum(machine.weights[i] for i in own)
        total += sum(machine.factors[i] @ machine.factors[j] for i in own for j in own if i < j)
        assert margin == pytest.approx(total)


def test_terms():
    terms = toxicity.TermBuckets()
    assert terms.of(b"") is not None and len(terms.of(b" 12 _ ")) == 0
    assert terms.of(b"Idiot, idiot-IDIOT").tolist() == terms.of(b"idiot").tolist()
    assert len(terms.of("É é straße".encode())) == 3


@pytest.mark.parametrize("labelled", [True, False])
def test_awkward_rows(spark, labelled):
    # Words of letters alone, since digits part terms.
    prose = [corpus.prose(i, 30).translate(str.maketrans("0123456789", "abcdefghij")) for i in range(200)]
    texts = [p + (" badword" if i % 2 else "") for i, p in enumerate(prose)] + ["badword " * 200_000]
    docs = corpus.awkward(spark, texts)
    labels = [(i, 1, i % 2) for i in range(200)] + [(None, 1, 1), (3, None, None), (5, 1, 1), (77_777, 0, 1)]
    labels = spark.createDataFrame(labels if labelled else [], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9001].score == by_id[9002].score == by_id[9003].score and by_id[None].held_out
    if labelled:
        assert by_id[200].predicted == by_id[5].predicted == 1 and by_id[4].predicted == by_id[9002].predicted == 0
    else:
        assert {r.predicted for r in rows} == {0}
    assert toxicity.toxicity_scores(corpus.empty(docs), labels).count() == 0
