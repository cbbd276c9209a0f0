import hashlib
import random

import corpus
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from packetloom.llm import bpe
from packetloom.llm.chunks import PartMemory, parts_of

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "é", "ñ", "1", "2", "'s", "'ll", "!", "?", "<|endoftext|>", "\x1c", "\x85", "\xa0",
    "\u2003", "日", "本", "😀", "the", "tion", "\r\n", "\u200b",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(bpe.read_ranks(PATH))


def texts():
    pick = random.Random(1)
    return ["".join(pick.choices(PIECES, k=pick.randint(0, 60))) for _ in range(3000)]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_pattern_is_the_given_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_equals_the_library(coder, library):
    some = [*texts(), "a" * 3000, "ab" * 2000, " " * 300, "x" * 63, "y" * 64, "z" * 65, "é" * 100]
    encoded = coder.encode(some)
    assert [ids(e) for e in encoded] == [library.encode_ordinary(t) for t in some]
    assert [coder.decode(e) for e in encoded] == [t.encode() for t in some]


def test_rows_and_single_trees_agree(coder):
    pick = random.Random(3)
    for _ in range(300):
        piece = bytes(pick.choices(b"abthein \xc3\xa9", k=pick.randint(1, 64)))
        tokens = coder.byte_id[list(piece)]
        row = np.full((1, 64), -1)
        row[0, : len(piece)] = tokens
        merged = bpe.merge_rows(row, coder.pairs)[0]
        assert merged[merged >= 0].tolist() == bpe.merge_one(tokens.tolist(), coder.pairs)


def test_every_code_point_is_cut_as_the_library_does(coder, library):
    points = [chr(c) for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    some = [f"a{c}1{c} b{c}" for c in points]
    assert [ids(e) for e in coder.encode(some)] == [library.encode_ordinary(t) for t in some]


def test_forgetting_changes_nothing(coder):
    memory = PartMemory(coder.encode_parts, size=50)
    some = texts()
    assert [i for k in range(0, len(some), 100) for i in memory.ids_of(some[k : k + 100])] == coder.encode(some)


def test_parts_make_the_text_again():
    for t in texts():
        assert " ".join(parts_of(t)) == t


def test_documents(spark, library):
    docs = corpus.awkward(spark, texts()[:300] + ["long " * 30_000])
    rows = bpe.encoded_documents(docs, PATH).collect()
    expected = sorted((str(r.doc_id), library.encode_ordinary(r.text or ""), r.text or "") for r in docs.collect())
    found = sorted((str(r.doc_id), r.ids, r) for r in rows)
    assert [(i, t) for i, t, _ in expected] == [(i, t) for i, t, _ in found]
    by_ids = {(i, tuple(t)): text for i, t, text in expected}
    for i, t, r in found:
        text = by_ids[i, tuple(t)]
        assert r.n_tokens == len(t) and r.ids_sha256 == hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encoded_digests(corpus.empty(docs), PATH).count() == 0
