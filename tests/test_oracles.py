"""Every registered query against independent SQL in DuckDB."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from plumbline.plans import all_oracles, all_queries

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_matches_sql(spark, con, name):
    problem, _, _ = compare(spark, con, name, SF_DIR)
    assert problem is None


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    # corpus queries, where installed, may have none: those are tested against brute force
    assert all_queries().keys() <= entry.queries().keys()
    assert entry.queries().keys() - entry.oracle_sql().keys() <= entry.CORPUS_QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 1
