"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as contract
from lakevault.oracles import ORACLES
from lakevault.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert compare.difference(df, con, contract.oracle_sql()[name]) is None
