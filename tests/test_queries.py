"""Every query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
import oracle
from packetloom.plans.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = {"train_and_score", "feature_importance"}


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


def test_contract_keys():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, connection, name):
    difference = oracle.compare(QUERIES[name](spark, FOLDER), connection, ORACLE[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
