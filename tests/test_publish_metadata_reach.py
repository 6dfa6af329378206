"""Loads checked while written, footers and catalogs, reach of all models at once."""

from __future__ import annotations

import random

import pytest
from helpers import final_plan, one, plan, rows
from pyspark.sql import functions as F

from plumbline.operators import reach
from plumbline.operators.compare import ab_row_count
from plumbline.operators.lineage import vestigial_relations
from plumbline.operators.reach import reach_counts
from plumbline.operators.schema_history import column_catalog
from plumbline.sources import metadata as M
from plumbline.sources import publish as P

ROW = "k int, kind string, n int"


def load(spark, items):
    return spark.createDataFrame(items, ROW)


def checks(spark):
    parents = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id int")
    return {
        "not_null": ["k"],
        "accepted": {"kind": ["a", "b"]},
        "relationships": {"n": (parents, "id")},
        "conditions": {"n below 9": F.col("n") < 9},
        "unique": ["k", ["kind", "n"]],
    }


def test_a_refused_load_leaves_the_table_as_it_was(spark, tmp_path):
    table = str(tmp_path / "t")
    first = P.publish_checked(load(spark, [(1, "a", 1), (2, "b", 2)]), table, **checks(spark))
    assert first.accepted and (first.version, first.n_rows, first.n_failing) == (1, 2, 0)
    bad = load(spark, [(3, "a", 3), (None, "a", 1), (4, "z", 9), (3, "b", 1), (5, None, None)])
    refused = P.publish_checked(bad, table, **checks(spark))
    assert not refused.accepted and (refused.version, refused.n_rows, refused.n_failing) == (1, 5, 3)
    assert rows(refused.report, "check_name", "column_name", "n_failing", "passed") == sorted([
        ("not_null", "k", 1, False), ("accepted_values", "kind", 1, False), ("relationship", "n", 1, False),
        ("condition", "n below 9", 2, False), ("unique", "k", 1, False), ("unique", "kind, n", 0, True),
    ], key=repr)
    failing = {r["k"]: set(r[P.FAILED]) for r in refused.rejected.collect()}
    assert failing == {None: {"not_null(k)"}, 4: {"accepted_values(kind)", "relationship(n)", "condition(n below 9)"}, 5: {"condition(n below 9)"}}
    assert rows(P.published_table(spark, table)) == [(1, "a", 1), (2, "b", 2)]


def test_an_accepted_load_publishes_its_good_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    allowed = {"accepted_values(kind)": 1, "unique(k)": 1}
    got = P.publish_checked(load(spark, [(1, "a", 1), (1, "b", 1), (2, "z", 1)]), table, accepted={"kind": ["a", "b"]}, unique=["k"], allowed=allowed)
    assert got.accepted and rows(P.published_table(spark, table)) == [(1, "a", 1), (1, "b", 1)]
    assert P.publish_checked(load(spark, []), table, **checks(spark)).version == 2
    P.publish_checked(load(spark, [(7, "a", 1)]).withColumn("more", F.lit(True)), table)
    assert rows(P.published_table(spark, table)) == [(1, "a", 1, None), (1, "b", 1, None), (7, "a", 1, True)]
    assert P.publish_checked(load(spark, [(9, "b", 2)]), table, replace=True).version == 4
    assert rows(P.published_table(spark, table)) == [(9, "b", 2)]
    assert rows(P.published_table(spark, table, 1)) == [(1, "a", 1), (1, "b", 1)]
    with pytest.raises(ValueError, match="no check"):
        P.publish_checked(load(spark, []), table, allowed={"not_null(q)": 1})
    with pytest.raises(ValueError, match="no version"):
        P.published_table(spark, str(tmp_path / "none"))


def test_a_crash_before_publishing_leaves_the_table(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    P.publish_checked(load(spark, [(1, "a", 1)]), table)
    with monkeypatch.context() as m:
        m.setattr(P._Folder, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            P.publish_checked(load(spark, [(2, "a", 1)]), table)
    assert rows(P.published_table(spark, table)) == [(1, "a", 1)]


def test_the_load_is_read_once(spark, tmp_path):
    """Checks of rows and the write share one pass over the load: an accumulator counts the rows that are computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = load(spark, [(i, "a" if i % 3 else "z", i % 4) for i in range(100)]).mapInArrow(count, ROW)
    parents = spark.createDataFrame([(0,), (1,), (2,)], "id int")
    got = P.publish_checked(df, str(tmp_path / "t"), not_null=["k"], accepted={"kind": ["a"]}, relationships={"n": (parents, "id")}, unique=["k"])
    assert not got.accepted and got.n_failing == 50 and seen.value == 100


# ---- footers and catalogs


def test_footer_statistics_equal_a_scan(spark, tmp_path, monkeypatch):
    df = spark.range(1000).selectExpr(
        "id", "if(id % 7 = 0, null, cast(id % 90 as double) / 4) x", "if(id = 3, null, concat('t', id)) s", "date_add(date'2024-01-01', cast(id % 40 as int)) d",
        "id % 2 = 0 b", "timestamp'2024-01-01' t", "cast(null as int) none", "array(id) l",
    )
    path = str(tmp_path / "t")
    df.repartition(3).write.parquet(path)
    scanned = M._rows(spark.read.parquet(path), "t").collect()
    assert M.footer_statistics(spark, {"t": path}).collect() == scanned  # "none" has no bounds: scanned
    other = str(tmp_path / "u")
    df.drop("none").repartition(2).write.parquet(other)
    calls = []
    monkeypatch.setattr(M, "_rows", lambda d, t, f=M._rows: calls.append(t) or f(d, t))
    assert M.footer_statistics(spark, {"u": other}).count() == 7 and calls == ["u"]  # no second, scanning way
    got = {r["column_name"]: r for r in M.footer_statistics(spark, {"t": path}).collect()}
    exact = one(df.agg(*[F.count(c).alias(c) for c in df.columns]))
    assert list(got) == df.columns and all(r["row_count"] == 1000 for r in got.values())
    assert {c: r["null_count"] for c, r in got.items() if c != "l"} == {c: 1000 - exact[c] for c in df.columns if c != "l"}
    assert got["l"]["null_count"] is None
    assert [(got[c]["min_value"], got[c]["max_value"]) for c in ("id", "x", "d", "b", "none", "s")] == [
        ("0", "999"), ("0.0", "22.25"), ("2024-01-01", "2024-02-09"), ("false", "true"), (None, None), (None, None)
    ]
    plain = {r["column_name"]: (r["data_type"], r["is_nullable"], r["ordinal"]) for r in column_catalog({"t": df}, measure=True).collect()}
    assert {r["column_name"]: (r["data_type"], r["is_nullable"], r["ordinal"]) for r in M.footer_catalog(spark, {"t": path}).filter("column_name <> 'l'").collect()} == {c: v for c, v in plain.items() if c != "l"}


def test_footer_counts_read_no_rows(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(50).write.parquet(a)
    spark.range(60).write.parquet(b)
    assert one(M.footer_row_counts(spark, a, b)) == one(ab_row_count(spark.read.parquet(a), spark.read.parquet(b)))
    with M._footers(spark):
        text = plan(M._aggregated(spark.read.parquet(a)))
    assert "PushedAggregation: [COUNT(*), COUNT(id), MIN(id), MAX(id)]" in text
    assert "PushedAggregation" not in plan(M._aggregated(spark.read.parquet(a)))


def test_inventory_of_the_catalog(spark, tmp_path):
    spark.sql(f"create database plumb_a location '{tmp_path / 'db'}'")
    try:
        spark.range(3).write.saveAsTable("plumb_a.kept")
        spark.range(3).write.saveAsTable("plumb_a.lost")
        spark.sql("create view plumb_a.seen as select * from plumb_a.kept")
        found = M.catalog_inventory(spark, ["plumb_a"])
        assert rows(found) == [("plumb_a", "kept", "table"), ("plumb_a", "lost", "table"), ("plumb_a", "seen", "view")]
        assert ("plumb_a", "lost", "table") in rows(M.catalog_inventory(spark))
        expected = spark.createDataFrame([("plumb_a", "kept"), ("plumb_a", "seen")], "schema_name string, ref_name string")
        assert rows(vestigial_relations(found, expected)) == [("plumb_a", "lost", "table")]
    finally:
        spark.sql("drop database plumb_a cascade")


# ---- reach


def reached(edges, start):
    found, todo = set(), [start]
    while todo:
        for a, b in edges:
            if a == todo[0] and b not in found:
                found.add(b)
                todo.append(b)
        todo.pop(0)
    return found


@pytest.mark.parametrize("seed", range(2))
def test_reach_of_graphs_with_cycles(spark, seed):
    rng = random.Random(seed)
    ids = list(range(30))
    edges = [(rng.randrange(24), rng.randrange(24)) for _ in range(22)] + [(29, 29), (24, 25), (25, 26), (26, 24)] + [(0, i) for i in range(10, 20)]
    nodes = spark.createDataFrame([(i, f"m{i}") for i in ids], "node_id long, model_name string")
    found = reach_counts(nodes, spark.createDataFrame([*edges, (3, 999), (998, 2)], "upstream_id long, downstream_id long"))
    back = [(b, a) for a, b in edges]
    want = []
    for i in ids:
        down, up = reached(edges, i), reached(back, i)
        want.append((f"m{i}", len(up - {i}), len(down - {i}), i in down))
    assert rows(found) == sorted(want, key=repr)


def test_reach_beyond_the_exact_bound_is_estimated(spark):
    """A chain of hubs over 20,000 models: estimates within 5 % and never a row per start and model."""
    n = 20_000
    nodes = spark.range(n).selectExpr("id node_id", "concat('m', id) model_name")
    edges = spark.range(1, n).selectExpr("id div 50 upstream_id", "id downstream_id")
    found = {r["model_name"]: r for r in reach_counts(nodes, edges, entries=10).filter("model_name in ('m0', 'm7', 'm19999')").collect()}
    assert abs(found["m0"]["downstream_models"] - (n - 1)) < 0.1 * n
    assert found["m7"]["downstream_models"] == pytest.approx(50 + 2500, rel=0.1)
    assert (found["m19999"]["upstream_models"], found["m19999"]["downstream_models"], found["m19999"]["in_cycle"]) == (3, 0, False)


def test_reach_without_edges(spark):
    nodes = spark.createDataFrame([(1, "a")], "node_id long, model_name string")
    assert rows(reach_counts(nodes, spark.createDataFrame([], "upstream_id long, downstream_id long"))) == [("a", 0, 0, False)]


def test_reach_sends_no_side_of_a_join_to_the_driver(spark, monkeypatch):
    nodes = spark.range(40).selectExpr("id node_id", "concat('m', id) model_name")
    edges = spark.range(1, 40).selectExpr("id div 3 upstream_id", "id downstream_id")
    plans = []

    def stored(df, purpose):
        found = keep(df, purpose)
        plans.append(final_plan(df))
        return found

    keep = reach.stored
    monkeypatch.setattr(reach, "stored", stored)
    plans.append(final_plan(reach_counts(nodes, edges)))
    joins = [line for p in plans for line in p.split("\n") if "Join" in line]
    assert len(plans) > 8 and len(joins) > 12 and all("SortMergeJoin" in line for line in joins)
    assert not any("Broadcast" in p for p in plans)
