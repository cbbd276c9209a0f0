import glob
import random
import tracemalloc
import zlib

import corpus
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from packetloom.llm import token_files
from packetloom.session import shared_folder
from test_llm_bpe import PIECES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(n=400):
    pick = random.Random(8)
    return ["".join(pick.choices(PIECES, k=pick.randint(0, 80))) for _ in range(n)]


def test_strings_of_added_tokens_are_these_tokens(library):
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files.LibraryEncoder(f.read())
    added = [t.content for t in library.get_added_tokens_decoder().values()]
    pick = random.Random(3)
    some = ["".join(pick.choices([*PIECES, *added, " " + added[0], added[0][:-1]], k=pick.randint(0, 30))) for _ in range(1000)]
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert np.frombuffer(encoder.encode(["a <|endoftext|> b"])[0], "<u4").tolist() == [64, 220, 50256, 275]


def test_parts_side_by_side_equal_the_library(library):
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files.LibraryEncoder(f.read())
    some = texts(3000)
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_files_read_back(spark, library):
    docs = corpus.awkward(spark, texts() + ["many words " * 20_000], repeat=True).repartition(5)
    folder = shared_folder(spark, "tokens")
    token_files.write_token_files(docs, PATH, folder)
    found = token_files.id_checksums(token_files.read_token_files(spark, folder), "doc_id", "start", "n_tokens").collect()
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    encoded = [(i, np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4")) for i, t in rows]
    expected = sorted((i is not None, i or 0, len(e), zlib.crc32(e.tobytes())) for i, e in encoded)
    in_order = sorted(found, key=lambda r: r.start)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == expected
    ids = [-1 if r.doc_id is None else r.doc_id for r in in_order]
    assert ids == sorted(ids)
    start = 0
    for r in in_order:
        assert r.start == start
        start += r.n_tokens


def test_layout(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts(2000))], "doc_id long, text string")
    folder = shared_folder(spark, "tokens")
    token_files.write_token_files(docs, PATH, folder)
    for path in glob.glob(f"{folder}/ids/*.parquet"):
        file = pq.ParquetFile(path)
        if not file.metadata.num_rows:
            continue
        columns = {file.metadata.row_group(0).column(i).path_in_schema: file.metadata.row_group(0).column(i) for i in range(5)}
        assert all(c.has_column_index and c.has_offset_index for c in columns.values())
        assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings
    numbers = token_files.read_token_files(spark, folder).select("doc_id", "n_tokens").where("doc_id BETWEEN 10 AND 12")
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema: ")[1].split(">")[0] and "PushedFilters: [IsNotNull" in plan
    assert numbers.count() == 3


def test_empty_table(spark):
    folder = shared_folder(spark, "tokens")
    token_files.write_token_files(corpus.empty(corpus.awkward(spark, ["a"])), PATH, folder)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_a_part_that_comes_often_is_looked_up_once(library):
    """Python holds no object per occurrence, and the library gets new parts in groups."""
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files.LibraryEncoder(f.read())
    sizes, encode_plain = [], encoder.memory.encode_plain
    encoder.memory.encode_plain = lambda parts: sizes.append(len(parts)) or encode_plain(parts)
    some = [" ".join(f"w{i % 40_000}" for i in range(k, k + 100_000)) for k in range(0, 600_000, 100_000)]
    tracemalloc.start()
    found = encoder.encode(some)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [np.frombuffer(i, "<u4").tolist() for i in found] == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert sum(sizes) <= 40_000 and max(sizes) <= 16_384
    assert peak < 72e6


def test_odd_texts_keep_their_places(library):
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files.LibraryEncoder(f.read())
    some = ["", " ", "a  b", " a", "a ", "plain words", "a\n", "<|endoftext|> x  y", "b \x1cc", "  ", "plain words", "\n a"]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert encoder.encode([]) == []
