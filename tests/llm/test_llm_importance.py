import random
import tracemalloc
import weakref

import corpus
import numpy as np
import pytest

from packetloom.llm import arrow, importance

FOLDER = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    """Fitted on the documents of even hash among the even ids, judged on the odd ids."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = importance.resampled(docs, labels.where("doc_id % 2 = 0"))
    assert found.count() == docs.count()
    rows = found.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.98 * len(rows)
    assert sum(r.kept for r in rows if r.quality == 1) >= 0.98 * sum(r.quality for r in rows)


def test_weights_equal_a_plain_sum(spark):
    docs = corpus.awkward(spark, [corpus.prose(i, 30) for i in range(20)] + ["UP UP UP!! 1,2 x"])
    ratios = np.random.default_rng(0).normal(size=importance.BUCKETS)
    for r in importance.importance_weights(docs, ratios, ["doc_id", "text"]).collect():
        words = (r.text or "").encode().split()
        codes = [importance.word_code(w) for w in words]
        total, grams = 0.0, 0
        for i, c in enumerate(codes):
            buckets, _ = importance.bucket_stream(importance.WordCodes(), [b" ".join(words[max(0, i - 1) : i + 1])])
            own = [(c >> 10) % importance.WORD_BUCKETS, *buckets[2:].tolist()]  # the word, then pair and shapes with the one before
            total, grams = total + ratios[own].sum(), grams + len(own)
        assert r._n_grams == grams and r._log_weight == pytest.approx(total)


@pytest.mark.parametrize("ties", [0, 50, 100])
def test_kth_largest(spark, monkeypatch, ties):
    monkeypatch.setattr(importance, "SEARCH_BINS", 16)
    pick = random.Random(ties)
    values = [2.5 if pick.randrange(100) < ties else pick.gauss(0, 1e6) for _ in range(3000)]
    table, ordered = spark.createDataFrame([(v,) for v in values], "x double"), sorted(values, reverse=True)
    for k in (1, 2, 17, 1500, 2999, 3000):
        found = importance.kth_largest(table, "x", k)
        assert sum(v >= found for v in values) >= k and (found == ordered[k - 1] or k == 3000)


def test_draws_follow_the_weights(spark, monkeypatch):
    """With the weights as they are, drawing one of two documents takes the heavier one in proportion."""
    monkeypatch.setattr(importance, "POWER", 1.0)
    ratios = np.zeros(importance.BUCKETS)
    heavy, _ = importance.bucket_stream(importance.WordCodes(), [b"heavy"])
    ratios[heavy] = np.log(3)
    docs = spark.createDataFrame([(i, t) for i in range(4000) for t in ("heavy", "light")], "doc_id long, text string")
    rows = importance.importance_weights(docs, ratios, ["doc_id", "text"]).select("doc_id", "text", "_draw").collect()
    draw = {(r.doc_id, r.text): r._draw for r in rows}
    assert np.mean([draw[i, "heavy"] > draw[i, "light"] for i in range(4000)]) == pytest.approx(0.75, abs=0.03)


def test_awkward_rows(spark):
    docs = corpus.awkward(spark, [corpus.prose(i, 60) for i in range(30)] + ["x x x x x x " * 40])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(30, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    none, one_sided = corpus.empty(labels), labels.where("quality = 1")
    for some in (none, one_sided):
        assert importance.drawn_documents(docs, some).count() == docs.count()
    kept = importance.drawn_documents(docs, labels)
    assert kept.columns == docs.columns and set(kept.first().asDict()) == set(docs.columns)
    rows = importance.resampled(docs, labels)
    assert rows.count() == docs.count() and rows.where("n_grams = 0 AND log_weight <> 0").count() == 0
    assert importance.resampled(corpus.empty(docs), labels).count() == 0
    assert importance.drawn_documents(corpus.empty(docs), labels).count() == 0


def test_toxic_rows_are_not_good_for_the_threshold(spark):
    labels = [(i, 1, 0) for i in range(20)] + [(i, 1, 1) for i in range(20, 40)] + [(i, 0, 0) for i in range(40, 60)]
    sample = importance.label_sample(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id", 1000)
    mean = {i: 0.5 if i < 20 else 0.1 if i < 40 else -0.5 for i, *_ in labels}
    means = spark.createDataFrame(list(mean.items()), "doc_id long, _mean double")
    assert 0.1 < importance.threshold(means.join(sample, means.doc_id == sample["_label_key"])) <= 0.5


def test_memory_follows_different_words_not_occurrences():
    text = b" ".join(b"word%d" % (i % 1000) for i in range(600_000))
    tracemalloc.start()
    buckets, owner = importance.bucket_stream(importance.WordCodes(), [text])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(buckets) == len(owner) == 3 * 600_000 - 2
    assert peak < 80e6


def test_white_space_at_the_ends_of_texts():
    some = [b"", b" \t\n", b"\x0b a  b\x0c\r", b"a b", b"\xc2\xa0 c", b"d"]
    alone = [importance.bucket_stream(importance.WordCodes(), [b" ".join(t.split())])[0].tolist() for t in some]
    buckets, owner = importance.bucket_stream(importance.WordCodes(), some)
    assert [sorted(buckets[owner == i].tolist()) for i in range(len(some))] == [sorted(a) for a in alone]


def test_a_worker_keeps_only_the_newest_state():
    first = weakref.ref(arrow.kept(importance.WordCodes))
    assert arrow.kept(importance.WordCodes) is first()
    assert arrow.kept(set, (1, 2)) == {1, 2} and first() is None
    second = weakref.ref(arrow.kept(importance.WordCodes))
    arrow.release()
    assert second() is None
