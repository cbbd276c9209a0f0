import importlib
import sys

import corpus
import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from packetloom.llm import decontamination, importance, near_duplicates
from packetloom.llm.queries import ORACLE, QUERIES
from packetloom.session import materialise
from test_llm_decontamination import brute as contaminated
from test_llm_near_duplicates import shingles

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in contract.queries()) == 1 for n in names)
    assert contract.queries()["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5
    assert set(ORACLE) <= set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    difference = oracle.compare(QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), ORACLE[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_covers_its_whole_table(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    assert rows.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = [docs]
    for stage in stages[:-1]:
        kept.append(materialise(stage(spark, kept[-1], FOLDER), "stage"))
        assert kept[-1].columns == docs.columns
    rows = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1 AND toxic = 0").collect()
    assert all(r.doc_id in rows[1] for r in labels)
    # No two documents that stay are near duplicates, and each one that went has a link to another.
    sets = {i: shingles(t, corpus_pipeline.SHINGLE_WORDS) for i, t in rows[1].items()}

    def near(a, b):
        return bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])

    assert not any(near(a, b) for a in rows[2] for b in rows[2] if a < b)
    assert all(any(near(a, b) for b in rows[1] if a != b) for a in rows[1] if a not in rows[2])
    assert set(rows[3]) == {i for i, t in rows[2].items() if not contaminated(t, items)[3]}
    assert set(rows[4]) == set(rows[3])
    last = stages[-1](spark, kept[-1], FOLDER)
    assert last.count() == len(rows[4]) and last.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_documents_pass_all_stages(spark, tmp_path, empty):
    docs = corpus.awkward(spark, [corpus.prose(i, 80, 5000) for i in range(12)] + ["password=abcdef1 " + corpus.prose(50, 60, 5000)])
    docs = corpus.empty(docs) if empty else docs
    for stage in [f for _, f in corpus_pipeline.STAGES]:
        docs = materialise(stage(spark, docs, FOLDER), "stage")
    assert (docs.count() == 0) == empty


def test_the_rest_works_without_the_subpackage(monkeypatch):
    monkeypatch.setattr(contract, "find_spec", lambda name: None)
    assert set(contract.queries()) and not any(q.startswith("op") and q[2].isdigit() for q in contract.queries())
    assert "pipeline" not in contract.queries() and set(contract.oracle_sql()) <= set(contract.queries())


def test_nothing_else_imports_the_subpackage():
    before = set(sys.modules)
    assert importlib.import_module("packetloom.plans.jobs") and before
    import pathlib

    package = pathlib.Path(contract.__file__).parent / "packetloom"
    for path in package.rglob("*.py"):
        if "llm" not in path.relative_to(package).parts:
            assert "packetloom.llm" not in path.read_text()
    assert corpus_pipeline.SHINGLE_WORDS == 5 and near_duplicates.SIMILAR == 80 and decontamination.WINDOW == 13 and importance.LABEL_ROWS == 50_000
