from __future__ import annotations

from helpers import one, rows

from plumbline.operators import consolidate as K
from plumbline.operators.schema_history import column_catalog


def setup(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (2, "y", 2), (None, "n", 3)], "user_id int, name string, extra int")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "user_id int, name string")
    target = spark.createDataFrame([(1, "x"), (None, "n")], "user_id int, name string")
    return {"a": a, "b": b}, target


def test_check(spark):
    sources, target = setup(spark)
    got = one(K.consolidation_check(sources, target, "user_id", "t"))
    assert (got["target_row_count"], got["union_row_count"]) == (2, 3)
    assert (got["a_missing_count"], got["b_missing_count"]) == (3, 2)
    assert got["validation_status"] == "WARNING: Target has fewer rows than union of sources"


def test_missing_rows_modes(spark):
    sources, target = setup(spark)
    # as a set NULL equals NULL and copies count once; row by row NULL never matches
    assert rows(K.consolidation_missing_rows(sources, target, "user_id")) == [("a", 1), ("b", 2)]
    assert rows(K.consolidation_missing_rows(sources, target, "user_id", "rows")) == [("a", 3), ("b", 2)]
    assert one(K.consolidation_missing_union(sources, target, ["user_id"]))["missing_union_count"] == 2
    assert rows(K.consolidation_missing_union(sources, target, "user_id", sample=1)) == [(2,)]


def test_sample(spark):
    sources, target = setup(spark)
    got = K.consolidation_missing_sample(sources, target, "user_id", 2)
    assert got.filter("source_model = 'a'").count() == 2 and got.filter("source_model = 'b'").count() == 2


def test_columns_and_summary(spark):
    sources, target = setup(spark)
    catalog = column_catalog(sources)
    assert rows(K.consolidation_missing_columns(catalog, column_catalog({"t": target}))) == [("extra", "int", "a")]
    got = {r["model_name"]: r for r in K.consolidation_summary(sources, target, "t").collect()}
    assert (got["a"]["column_count"], got["a"]["common_columns"], got["a"]["missing_columns"]) == (3, 2, 1)
    assert got["t"]["common_columns"] is None and got["t"]["row_count"] == 2


def test_keys(spark):
    sources, target = setup(spark)
    assert K.key_columns_by_name(sources, target) == ["user_id"]
    renamed = {k: v.toDF(*["c%d" % i for i in range(len(v.columns))]) for k, v in sources.items()}
    plain = target.toDF("c0", "c1")
    assert K.key_columns_by_name(renamed, plain) == ["c0", "c1"]
    assert K.key_columns_by_name(renamed, plain, fallback="first") == ["c0"]
    got = {r["column_name"]: r["is_key"] for r in K.infer_keys(sources, target).collect()}
    assert got == {"user_id": False, "name": False}  # one id is NULL


def test_confirm_keys_counts_nulls_and_pairs(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (None, 1, "z")], "a_id int, b_id int, v string")
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "x")], "a_id int, b_id int, v string")
    got = {(r["relation_name"], r["key_columns"]): (r["distinct_count"], r["is_key"], r["confirmed"]) for r in K.confirm_keys({"a": a}, b).collect()}
    assert got[("a", "v")] == (3, True, False) and got[("target", "v")] == (1, False, False)
    assert got[("a", "a_id, b_id")] == (2, False, False) and got[("target", "a_id, b_id")] == (2, True, False)
    empty = b.filter("false")
    assert all(r["confirmed"] for r in K.confirm_keys({"a": empty}, empty).collect())
