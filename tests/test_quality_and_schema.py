from __future__ import annotations

import datetime as dt

from helpers import one, rows

from plumbline.operators import quality as Q
from plumbline.operators import schema_history as H


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b"), (None, "b")], "k int, s string")
    assert rows(Q.check_not_null(df, ["k", "s"])) == [("not_null", "k", 2), ("not_null", "s", 1)]
    assert rows(Q.check_unique(df, ["k", "s"])) == [("unique", "k", 1), ("unique", "s", 2)]
    assert one(Q.check_unique_combination(df, ["k", "s"]))["n_failing"] == 0
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    got = one(Q.check_relationship(df, "k", parent, "id"))
    assert (got["n_failing"], got["n_failing_values"]) == (1, 1)
    assert rows(Q.check_accepted_values(df, "s", ["a"])) == [("accepted_values", "s", "b", 2)]
    declared = Q.declared_checks({"t": (df, {"not_null": ["k"], "unique": ["k"], "combinations": [["k", "s"]]})})
    assert declared.count() == 3 and set(declared.columns) == {"model_name", "check_name", "column_name", "n_failing"}


def test_suggestions(spark):
    df = spark.createDataFrame([(i, i % 9, i % 10, i % 2 == 0) for i in range(30)], "id int, Parent_ID int, ten int, b boolean")
    got = {(r["column_name"], r["check_name"]): r for r in Q.suggest_checks(df).collect()}
    assert got["Parent_ID", "accepted_values"]["args"] == "0, 1, 2, 3, 4, 5, 6, 7, 8"
    assert ("ten", "accepted_values") not in got and got["b", "accepted_values"]["args"] == "false, true"
    assert got["id", "unique"]["n_failing"] == 0 and ("ten", "unique") not in got
    assert ("Parent_ID", "relationships") in got and ("id", "relationships") not in got


def test_health_counts_known_neighbours_only(spark):
    nodes = spark.createDataFrame([(1, "a"), (2, "b")], "node_id int, model_name string")
    edges = spark.createDataFrame([(1, 2), (9, 2), (2, 8)], "upstream_id int, downstream_id int")
    now = dt.datetime(2024, 2, 1)
    runs = spark.createDataFrame([("b", now, 2.0), ("b", dt.datetime(2023, 1, 1), 9.0)], "model_name string, created_at timestamp_ntz, execution_time double")
    tests = spark.createDataFrame([("b", now, "fail"), ("b", now, "pass")], "model_name string, created_at timestamp_ntz, status string")
    stats = spark.createDataFrame([("b", 7)], "model_name string, row_count bigint")
    catalog = spark.createDataFrame([("b", "pk_x"), ("b", "y_id"), ("b", "yXid")], "model_name string, column_name string")
    got = {r["model_name"]: r for r in Q.model_health(nodes, edges, runs, tests, stats, catalog, "2024-02-01").collect()}
    assert (got["b"]["upstream_dependencies"], got["b"]["downstream_dependencies"]) == (1, 0)
    assert (got["b"]["max_execution_time"], got["b"]["total_tests"], got["b"]["failed_tests"]) == (2.0, 2, 1)
    assert (got["b"]["column_count"], got["b"]["key_column_count"]) == (3, 2)
    assert got["a"]["downstream_dependencies"] == 1 and got["a"]["row_count"] is None


CATALOG = "model_name string, column_name string, data_type string, char_len bigint, is_nullable boolean, ordinal bigint"


def test_schema_diff(spark):
    old = spark.createDataFrame([("m", "a", "int", None, True, 1), ("m", "b", "text", 5, True, 2), ("m", "c", "int", None, False, 3)], CATALOG)
    new = spark.createDataFrame([("m", "a", "int", None, True, 1), ("m", "b", "text", 9, True, 2), ("m", "d", "int", None, False, 3)], CATALOG)
    assert {r[1]: r[2] for r in rows(H.schema_diff(old, new))} == {"b": "changed", "c": "removed", "d": "added"}
    assert {r[1]: r[2] for r in rows(H.migration_columns(old, new))} == {"c": "removed", "d": "added"}
    assert rows(H.schema_diff_types(old, new)) == [("m", 2, 1, 1, 0)]
    assert H.schema_diff(old, old).count() == 0


def test_semantic_versions(spark):
    steps = {
        1: [("a", "int", True), ("b", "int", False)],
        2: [("a", "int", True), ("b", "int", False)],  # unchanged: patch
        3: [("a", "int", True), ("b", "int", False), ("c", "int", True)],  # added: minor
        4: [("a", "int", True), ("b", "int", True), ("c", "int", True)],  # relaxed: minor
        5: [("a", "int", True), ("b", "int", False), ("c", "int", True)],  # tightened: major
        6: [("a", "text", True), ("b", "int", False), ("c", "int", True)],  # retyped: major
        7: [("a", "text", True), ("c", "int", True)],  # removed: major
        9: [("a", "text", True), ("c", "int", True)],  # nothing to compare with: minor
    }
    history = [("m", v, c, t, n, i) for v, columns in steps.items() for i, (c, t, n) in enumerate(columns)]
    df = spark.createDataFrame(history, "model_name string, version_no int, column_name string, data_type string, is_nullable boolean, ordinal int")
    got = {r["version_no"]: r["version"] for r in H.semantic_version(df).collect()}
    assert got == {1: "1.0.0", 2: "1.0.1", 3: "1.1.0", 4: "1.2.0", 5: "2.0.0", 6: "3.0.0", 7: "4.0.0", 9: "4.1.0"}


def test_snapshots_and_log(spark, tmp_path):
    from plumbline.sources.tables import append_history

    frames = {"m": spark.createDataFrame([(1, "a")], "k int, s string")}
    path = str(tmp_path / "history")
    for day, models in (("2024-01-01", frames), ("2024-01-02", frames), ("2024-01-03", {"m": frames["m"].withColumnRenamed("s", "t")})):
        append_history(H.schema_snapshot(H.column_catalog(models), None, day), path)
    log = H.schema_change_log(spark.read.parquet(path)).collect()
    assert [r["snapshot_date"] for r in log] == [dt.date(2024, 1, 3)]
    import hashlib

    first = spark.read.parquet(path).orderBy("snapshot_date").first()
    assert first["hash_value"] == hashlib.md5(b'["k:int","s:string"]').hexdigest()


def test_measured_catalog(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    got = {r["column_name"]: r for r in H.column_catalog({"m": df}, measure=True).collect()}
    assert (got["s"]["char_len"], got["s"]["is_nullable"], got["n"]["is_nullable"]) == (3, True, False)
    assert H.column_catalog({"m": df}).count() == 2


def test_migration_impact(spark):
    nodes = spark.createDataFrame([(1, "a", "model"), (2, "b", "model"), (3, "c", "source"), (4, "d", "model"), (5, "e", "model")], "node_id int, model_name string, resource_type string")
    edges = spark.createDataFrame([(1, 2), (2, 4), (1, 3), (3, 5)], "upstream_id int, downstream_id int")
    old = spark.createDataFrame([("a", "x", "int", None, True, 1), ("b", "y", "int", None, True, 1)], CATALOG)
    new = spark.createDataFrame([("b", "y", "text", None, True, 1)], CATALOG)
    assert rows(H.migration_impact(nodes, edges, old, new)) == [
        ("a", "b", "a", 1, "High"),
        ("a", "d", "b", 2, "High"),
        ("b", "d", "b", 1, "Medium"),
    ]


def test_content_hash_ignores_order_but_not_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("", None), (None, 2)], "s string, n int")
    whole = H.content_hash(df).first()
    assert H.content_hash(df.orderBy("n").repartition(3)).first() == whole
    assert H.content_hash(df.distinct()).first()["content_hash"] != whole["content_hash"]
    assert H.content_hash(df.fillna("")).first()["content_hash"] != whole["content_hash"]
    assert tuple(H.content_hash(df.filter("false")).first()) == (0, "0")
