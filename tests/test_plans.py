"""Shapes of physical plans that must hold at any size."""

from __future__ import annotations

import os
import re

import pytest
from helpers import plan

from plumbline.operators import compare, consolidate, leave, lineage, profile, quality
from plumbline.plans import all_queries
from plumbline.plans.registry import Inputs

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def tables(spark):
    return Inputs(spark, SF_DIR)


def scans(text):
    return len(re.findall(r"FileScan parquet", text))


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_reconciliation_is_one_scan_per_side_and_one_shuffle(tables):
    text = plan(compare.key_reconcile(tables.orders, tables.env_dev, "o_orderkey"))
    assert (scans(text), exchanges(text)) == (2, 1) and "Join" not in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
    text = plan(compare.row_compare(tables.orders_old, tables.orders_new, "m"))
    assert (scans(text), exchanges(text)) == (3, 1) and "Join" not in text
    chain = {"dev": tables.env_dev, "test": tables.env_test, "prod": tables.orders}
    text = plan(compare.env_chain_compare(chain, "m", ["o_orderkey"]))
    assert (scans(text), exchanges(text)) == (3, 1) and "Join" not in text


def test_consolidation_is_one_scan_per_table(tables):
    sources = {"f": tables.src_f, "o": tables.src_o, "p": tables.src_p}
    for df in (
        consolidate.consolidation_check(sources, tables.cons_target, "o_orderkey"),
        consolidate.consolidation_missing_union(sources, tables.cons_target, "o_orderkey"),
    ):
        text = plan(df)
        assert (scans(text), exchanges(text)) == (4, 1) and "Join" not in text


def test_counts_read_no_column(tables):
    text = plan(compare.ab_row_count(tables.orders, tables.lineitem))
    assert text.count("ReadSchema: struct<>") == 2


def test_unique_keys_join_once(tables):
    text = plan(compare.column_compare(tables.orders, tables.env_dev, "o_orderkey"))
    assert text.count("FullOuter") == 1 and "NestedLoop" not in text


def test_profile_scans(tables):
    plain = plan(profile.profile_dataset(tables.lineitem, ["l_quantity"], approx=True))
    assert scans(plain) == 1 and "ReadSchema: struct<l_quantity:double>" in plain
    assert scans(plan(profile.analyze_nulls(tables.lineitem, "m"))) == 1
    assert scans(plan(quality.check_not_null(tables.lineitem, ["l_tax", "l_quantity"]))) == 1


def test_top_values_are_limited_before_the_shuffle(tables):
    text = plan(profile.profile_dataset(tables.lineitem, ["l_returnflag"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_date_expansion_joins_by_equality(tables):
    loa = leave.dim_loa(leave.typed_loa(tables.raw_leave), leave.stage_employee(tables.employee))
    assert "NestedLoop" not in plan(leave.expand_leave_days(loa, tables.date_dim))


def test_anti_joins(tables):
    assert "LeftAnti" in plan(lineage.vestigial_relations(tables.inventory, tables.expected))
    assert "LeftAnti" in plan(compare.missing_key_sample(tables.orders, tables.env_dev, "o_orderkey"))


NO_PRODUCT = [n for n in all_queries() if n not in ("ingest_stream", "merge_stream", "merge_stream_watermark")]


@pytest.mark.parametrize("name", NO_PRODUCT)
def test_no_query_multiplies_rows(spark, name):
    text = plan(all_queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
