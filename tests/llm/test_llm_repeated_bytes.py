import hashlib
import random
from collections import Counter

import corpus
from hypothesis import given, settings
from hypothesis import strategies as st

from packetloom.llm import repeated_bytes
from packetloom.llm.repeated_bytes import SPAN, WIDTH


def brute(texts):
    starts = Counter()
    for t in texts:
        starts.update(t[i : i + WIDTH] for i in range(len(t) - WIDTH + 1))
    results = []
    for t in texts:
        covered, end = bytearray(len(t)), 0
        for i in range(len(t) - WIDTH + 1):
            if starts[t[i : i + WIDTH]] > 1:
                first, end = max(i, end), i + WIDTH
                covered[first:end] = b"\1" * (end - first)
        kept = bytes(b for b, c in zip(t, covered) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        results.append((len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return results


def corpus_texts():
    pick = random.Random(3)
    passage, other = corpus.prose(1, 120), corpus.prose(2, 60)
    texts = []
    for i in range(60):
        own = corpus.prose(100 + i, pick.randrange(5, 150), 5000)
        kind = i % 6
        if kind == 0:  # a shared passage at any offset, cut at any length
            at = pick.randrange(0, 300)
            texts.append(own + " " + passage[at : at + pick.randrange(190, 400)] + own[::-1])
        elif kind == 1:  # a near copy
            cut = pick.randrange(len(passage))
            texts.append(passage[:cut] + "é" + passage[cut + 1 :])
        elif kind == 2:
            texts.append(own + other + own)
        elif kind == 3:
            texts.append("ab " * pick.randrange(60, 300))
        else:
            texts.append(own)
    same = corpus.prose(7, 70)
    return texts + [same, same, "x" * 199, "x" * 199, "y" * 200, "y" * 200, "z" * 201, "é" * 400, same[:200], same[1:200]]


def test_equals_brute_force(spark):
    docs = corpus.awkward(spark, corpus_texts())
    rows = docs.collect()
    expected = sorted((str(r.doc_id), *b) for r, b in zip(rows, brute([(r.text or "").encode() for r in rows])))
    found = repeated_bytes.without_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == expected
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_empty_table(spark):
    assert repeated_bytes.without_repeats(corpus.empty(corpus.awkward(spark, ["a"]))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=0, max_size=900), st.integers(1, 5))
def test_every_start_has_its_leftmost_smallest_gram(data, alphabet):
    text = bytes(b % alphabet for b in data)
    position, first, last, gram = repeated_bytes.text_anchors(text)
    if len(text) < WIDTH:
        assert len(position) == 0
        return
    import numpy as np

    hashes = repeated_bytes.gram_hashes(np.frombuffer(text, np.uint8)) >> np.uint64(repeated_bytes.POSITION_BITS)
    owner = {s: int(p) for p, f, e in zip(position, first, last) for s in range(f, e + 1)}
    assert sorted(owner) == list(range(len(text) - WIDTH + 1))
    for s, p in owner.items():
        window = hashes[s : s + SPAN].tolist()
        assert p == s + window.index(min(window))


def test_segments_make_no_difference(monkeypatch):
    text = (corpus.prose(4, 2000) + "a" * 500).encode()
    whole = [x.tolist() for x in repeated_bytes.text_anchors(text)]
    monkeypatch.setattr(repeated_bytes, "SEGMENT", 700)
    assert [x.tolist() for x in repeated_bytes.text_anchors(text)] == whole
