from __future__ import annotations

import pytest
from helpers import final_plan, plan, rows
from pyspark.sql import functions as F

from plumbline.operators import lineage as L

NODES = [(1, "raw"), (2, "left"), (3, "right"), (4, "mart"), (5, "alone"), (6, "deep")]
EDGES = [(1, 2), (1, 3), (2, 4), (3, 4), (4, 6), (1, 4)]


@pytest.fixture
def graph(spark):
    nodes = spark.createDataFrame([(i, n, "source" if n == "raw" else "model", f"select {n}_col from x") for i, n in NODES], "node_id int, model_name string, resource_type string, model_sql string")
    return nodes, spark.createDataFrame(EDGES, "upstream_id int, downstream_id int")


def test_upstream_with_diamond(graph):
    got = rows(L.upstream_closure(*graph, "mart"), "name", "referenced_by", "depth")
    assert got == sorted(
        [("mart", None, 0), ("left", "mart", 1), ("right", "mart", 1), ("raw", "mart", 1), ("raw", "left", 2), ("raw", "right", 2)],
        key=repr,
    )
    paths = rows(L.upstream_closure(*graph, "deep", dedupe="paths"), "name", "depth")
    assert paths.count(("raw", 3)) == 2 and paths.count(("raw", 2)) == 1
    first = rows(L.upstream_closure(*graph, "deep", dedupe="first"), "name", "depth")
    assert [r for r in first if r[0] == "raw"] == [("raw", 2)]
    assert rows(L.upstream_closure(*graph, "alone"), "name", "depth") == [("alone", 0)]


def test_bounds(graph):
    assert rows(L.upstream_bounded(*graph, "deep", 1), "name", "resource_type", "depth") == [("deep", "model", 0), ("mart", "model", 1)]
    assert rows(L.downstream_impact(*graph, "raw", 1), "name") == [("left",), ("mart",), ("right",)]
    assert rows(L.downstream_impact(*graph, "raw", 3), "name", "depth") == [("deep", 2), ("deep", 3), ("left", 1), ("mart", 1), ("mart", 2), ("right", 1)]
    assert rows(L.immediate_children(*graph, "left"), "name") == [("mart",)]
    assert rows(L.impact_by_level(L.downstream_impact(*graph, "raw", None))) == [("raw", 1, 3, 6), ("raw", 2, 2, 6), ("raw", 3, 1, 6)]
    assert rows(L.subgraph_edges(*graph, "mart", 1), "source_name", "target_name") == [("left", "mart"), ("raw", "left"), ("raw", "mart"), ("raw", "right"), ("right", "mart")]


def test_several_starts(spark, graph):
    starts = spark.createDataFrame([("left",), ("right",), ("left",)], "name string")
    assert rows(L.upstream_closure(*graph, starts), "start_name", "name") == [("left", "left"), ("left", "raw"), ("right", "raw"), ("right", "right")]


def test_cycles(spark, graph, monkeypatch):
    nodes, edges = graph
    cyclic = edges.union(spark.createDataFrame([(4, 2)], "a int, b int"))
    monkeypatch.setattr(L, "FIRST_CHECK", 1)
    with pytest.raises(RuntimeError):
        L.upstream_closure(nodes, cyclic, "mart")
    first = rows(L.upstream_closure(nodes, cyclic, "mart", dedupe="first"), "name", "depth")
    assert first == [("left", 1), ("mart", 0), ("raw", 1), ("right", 1)]
    # at level 2 "left" is reached through the cycle, from "mart" at depth 0
    bounded = rows(L.upstream_bounded(nodes, cyclic, "mart", 3), "name", "depth")
    assert ("mart", 2) in bounded and max(d for _, d in bounded) == 3


def test_a_chain_through_all_models_is_no_cycle(spark, monkeypatch):
    monkeypatch.setattr(L, "FIRST_CHECK", 1)
    nodes = spark.createDataFrame([(k, f"m{k}", "model") for k in range(7)], "node_id int, model_name string, resource_type string")
    edges = spark.createDataFrame([(k + 1, k) for k in range(6)], "downstream_id int, upstream_id int")
    assert rows(L.upstream_closure(nodes, edges, "m6"), "depth") == [(k,) for k in range(7)]


def test_column_lineage(graph):
    nodes, edges = graph
    assert rows(L.column_lineage(nodes, edges, "mart", "RAW_COL"), "name", "in_select", "depth") == [("raw", True, 1), ("raw", True, 2), ("raw", True, 2)]


def test_references(spark):
    files = spark.createDataFrame(
        [("a.sql", "x {{ ref('m') }}"), ("b.sql", 'y {{ REF("M") }} {{ ref("m") }}'), ("c.sql", None), ("d.md", "ref('m')"), ("e.sql", "ref('mm')")],
        "file_path string, file_content string",
    )
    assert rows(L.find_references(files, "M")) == [("a.sql",), ("b.sql",)]
    assert rows(L.reference_edges(files)) == [("a.sql", "m", 1), ("b.sql", "M", 1), ("b.sql", "m", 1), ("e.sql", "mm", 1)]


def test_vestigial(spark):
    inventory = spark.createDataFrame([("s", "a", "table"), ("s", "old", "view"), ("s", "kept", "view"), ("t", "x", "table"), ("u", "y", "table")], "schema_name string, ref_name string, ref_type string")
    expected = spark.createDataFrame([("s", "a"), ("u", "z")], "schema_name string, ref_name string")
    assert rows(L.vestigial_relations(inventory, expected, "u", ["s.kept"])) == [("s", "old", "view")]


def test_levels_are_computed_once(graph):
    nodes, edges = graph
    assert final_plan(L.upstream_bounded(nodes, edges, "mart", 3)).count("Join") <= 2 * 6  # initial and final plan


def test_walks_broadcast_nothing_that_grows_with_the_graph(graph, monkeypatch):
    plans = []
    cut = L.cut_lineage
    monkeypatch.setattr(L, "cut_lineage", lambda df: plans.append(plan(df)) or cut(df))
    plans.append(plan(L.upstream_closure(*graph, "mart")))
    assert len(plans) > 4 and not any("Broadcast" in p for p in plans)


def test_column_lineage_broadcasts_nothing_that_grows_with_the_graph(graph):
    nodes, edges = graph
    nodes = nodes.withColumn("model_sql", F.lit("select raw_col from t"))
    assert "Broadcast" not in plan(L.column_lineage(nodes, edges, "mart", "RAW_COL"))
