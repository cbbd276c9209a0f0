"""The library from a copy that lacks the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

from packetloom.plans.queries import ORACLE, QUERIES

REPOSITORY = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql())); import packetloom.plans.jobs"


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_core_queries_without_the_subpackage(tmp_path, with_pipeline):
    shutil.copytree(f"{REPOSITORY}/packetloom", tmp_path / "packetloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPOSITORY}/__spark_entry__.py", tmp_path)
    if with_pipeline and os.path.exists(f"{REPOSITORY}/corpus_pipeline.py"):
        shutil.copy(f"{REPOSITORY}/corpus_pipeline.py", tmp_path)
    asked = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert asked.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))], asked.stderr
