from __future__ import annotations

import pytest
from helpers import one, plan, rows
from pyspark.sql import functions as F

from plumbline.operators import compare as C

SCHEMA = "k int, a string, b double"


def frames(spark, old, new, schema=SCHEMA):
    return spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)


def by_join(old, new, keys, columns):
    """Counters from the plain full outer join, pair by pair."""
    o = old.select(*keys, *[F.col(c).alias("o_" + c) for c in columns])
    n = new.select(*keys, *[F.col(c).alias("n_" + c) for c in columns])
    joined = o.join(n, keys, "full_outer")
    aggregates = []
    for c in columns:
        a, b = F.col("o_" + c), F.col("n_" + c)
        aggregates += [
            F.count_if(a.eqNullSafe(b)).alias(c + "_same_count"),
            F.count_if(a != b).alias(c + "_diff_count"),
            F.count_if(a.isNull() & b.isNotNull()).alias(c + "_null_to_value_count"),
            F.count_if(a.isNotNull() & b.isNull()).alias(c + "_value_to_null_count"),
        ]
    return one(joined.agg(*aggregates))


def test_column_compare_labels(spark):
    old, new = frames(
        spark,
        [(1, "x", 1.0), (2, None, 2.0), (3, "z", 3.0), (4, None, 4.0), (5, None, None)],
        [(1, "x", 9.0), (2, "y", 2.0), (3, None, 3.0), (4, None, 4.0), (6, "n", None)],
    )
    got = one(C.column_compare(old, new, "k", row_status=True))
    assert got["comparison_name"] == "old vs new"
    # key 5 exists only in old with a NULL, key 6 only in new: a NULL facing nothing counts as same
    assert (got["a_same_count"], got["a_diff_count"]) == (3, 0)
    assert (got["a_null_to_value_count"], got["a_value_to_null_count"]) == (2, 1)
    assert (got["b_same_count"], got["b_diff_count"]) == (5, 1)
    assert (got["only_in_old"], got["only_in_new"]) == (1, 1)
    labels = dict(rows(C.column_compare_rows(old, new, "k", ["a"])))
    assert labels == {1: "SAME", 2: "NULL→VALUE", 3: "VALUE→NULL", 4: "SAME", 5: "SAME", 6: "NULL→VALUE"}


def test_column_compare_null_and_repeated_keys(spark):
    old, new = frames(
        spark,
        [(None, "x", 1.0), (None, None, 2.0), (1, "p", 1.0), (1, "q", 1.0), (1, None, None), (2, "r", 5.0), (3, "s", 1.0), (3, "s", 1.0)],
        [(None, "x", 1.0), (1, "p", 1.0), (1, None, 2.0), (2, "r", 5.0), (4, "t", None), (4, "u", 1.0)],
    )
    columns = ["a", "b"]
    got = one(C.column_compare(old, new, "k", row_status=True))
    want = by_join(old, new, ["k"], columns)
    assert {c: got[c] for c in want} == want
    assert (got["only_in_old"], got["only_in_new"]) == (4, 3)
    labelled = C.column_compare_rows(old, new, "k")
    assert labelled.count() == 4 + 3 + 6 + 1
    for c in columns:
        found = dict(rows(labelled.groupBy(f"{c}_comparison").count()))
        assert found.get("SAME", 0) == want[c + "_same_count"]
        assert found.get("NULL→VALUE", 0) == want[c + "_null_to_value_count"]


def test_pairs_are_counted_not_listed(spark):
    old, new = frames(spark, [(1, "x", 1.0)] * 40 + [(2, None, 1.0), (None, "n", 1.0)], [(1, "x", 2.0)] * 30 + [(1, "y", 1.0), (None, "n", 1.0)])
    with pytest.raises(ValueError, match="1240 pairs"):
        C.column_compare_rows(old, new, "k", max_pairs=1000)
    assert C.column_compare_rows(old, new, "k").count() == 1240 + 1 + 2
    got = {tuple(r)[:2]: tuple(r)[2:] for r in C.column_compare_by_key(old, new, "k").collect()}
    assert got[1, "a"] == (1200, 40, 0, 0) and got[1, "b"] == (40, 1200, 0, 0)
    assert got[2, "a"] == (1, 0, 0, 0) and got[2, "b"] == (0, 0, 0, 1) and got[None, "a"] == (0, 0, 1, 1)


@pytest.mark.parametrize("broadcast", [0, 3, 10**6])
def test_repeated_keys_beyond_the_broadcast(spark, monkeypatch, broadcast):
    monkeypatch.setattr(C, "BROADCAST_KEYS", broadcast)
    old = spark.range(3000).selectExpr("cast(if(id % 3 = 0, 7, id % 50) as int) k", "cast(id % 4 as string) a", "cast(id % 5 as double) b")
    new = spark.range(2000).selectExpr("cast(if(id % 3 = 0, 7, id % 60) as int) k", "nullif(cast(id % 3 as string), '2') a", "cast(id % 7 as double) b")
    got = one(C.column_compare(old, new, "k"))
    want = by_join(old, new, ["k"], ["a", "b"])
    assert {c: got[c] for c in want} == want


def test_changed_types_and_columns(spark):
    old = spark.createDataFrame([(1, 5, "x"), (2, 7, "y")], "k int, v int, gone string")
    new = spark.createDataFrame([(1, "5", 1.0), (2, "n/a", 1.0)], "k bigint, v string, came double")
    got = one(C.column_compare(old, new, "k"))
    assert (got["v_same_count"], got["v_diff_count"]) == (1, 1) and len(got) == 5
    wider = new.selectExpr("k", "cast(5 as bigint) v")
    assert one(C.column_compare(old, wider, "k"))["v_same_count"] == 1


def test_composite_key(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, None, 3)], "k int, l string, v int")
    got = one(C.column_compare(old, old, ["k", "l"], row_status=True))
    assert (got["v_same_count"], got["v_value_to_null_count"], got["v_null_to_value_count"]) == (2, 1, 1)
    assert one(C.key_reconcile(old, old, ["k", "l"]))["records_in_old_not_in_new"] == 1


def test_identity_and_swap(spark):
    a = spark.range(100).selectExpr("id k", "id % 7 v", "nullif(id % 3, 0) w")
    b = a.filter("k % 5 <> 0").withColumn("v", F.col("v") + F.when(F.col("k") % 2 == 0, 1).otherwise(0))
    same = one(C.column_compare(a, a, "k"))
    assert same["v_same_count"] == 100 and same["w_diff_count"] == 0
    there, back = one(C.column_compare(a, b, "k")), one(C.column_compare(b, a, "k"))
    assert there["w_null_to_value_count"] == back["w_value_to_null_count"]
    assert there["v_diff_count"] == back["v_diff_count"]
    assert sum(v for c, v in there.items() if c.startswith("v_")) == 100
    assert one(C.key_reconcile(a, b, "k"))["records_in_old_not_in_new"] == one(C.key_reconcile(b, a, "k"))["records_in_new_not_in_old"]
    assert one(C.row_compare(a, a, "m"))["rows_in_main_not_current"] == 0


def test_key_reconcile_empty_sides(spark):
    old, new = frames(spark, [], [(1, "x", 1.0)])
    got = one(C.key_reconcile(old, new, "k"))
    assert (got["old_record_count"], got["new_record_count"], got["percentage_change"]) == (0, 1, None)
    assert one(C.key_reconcile(old, old, "k"))["records_in_old_not_in_new"] == 0
    assert one(C.ab_row_count(old, new))["pct_diff"] is None


def test_null_keys_never_match(spark):
    old, new = frames(spark, [(None, "x", 1.0), (1, "x", 1.0), (1, "y", 1.0)], [(None, "x", 1.0), (2, "x", 1.0)])
    got = one(C.key_reconcile_min(old, new, "k"))
    assert (got["keys_missing_in_new"], got["keys_missing_in_old"]) == (3, 2)
    # whole rows compare NULLs as equal
    got = one(C.row_compare(old, new, "m"))
    assert (got["rows_in_main_not_current"], got["rows_in_current_not_main"]) == (2, 1)


def test_row_compare_multiset_and_types(spark):
    old, new = frames(spark, [(1, "x", 1.0)] * 3, [(1, "x", 1.0)])
    assert one(C.row_compare(old, new, "m"))["rows_in_main_not_current"] == 0
    assert one(C.row_compare(old, new, "m", multiset=True))["rows_in_main_not_current"] == 2
    retyped = new.withColumn("k", F.col("k").cast("bigint")).withColumnRenamed("a", "A")
    assert C.same_type_columns(old, retyped) == ["b"]
    got = one(C.row_compare(None, new, "m"))
    assert (got["main_row_count"], got["current_row_count"], got["rows_in_main_not_current"]) == (None, 1, None)


def test_env_chain(spark):
    a, b = frames(spark, [(1, "x", 1.0), (2, "x", 1.0), (2, "y", 1.0)], [(2, "x", 1.0), (None, "z", 1.0)])
    got = [r.asDict() for r in C.env_chain_compare({"dev": a, "test": b, "prod": None}, "m", ["k"]).collect()]
    assert got[0]["absolute_diff"] == -1 and got[0]["percent_diff"] == -33.33
    assert (got[0]["rows_in_baseline_not_compare"], got[0]["rows_in_compare_not_baseline"]) == (1, 1)
    assert (got[1]["baseline_rows"], got[1]["compare_rows"], got[1]["absolute_diff"]) == (2, None, None)
    assert got[1]["rows_in_baseline_not_compare"] is None
    assert len(C.env_chain_compare({"dev": a, "test": b}, "m").columns) == 7


def test_stat_compare_ignores_case(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "K int, v string")
    b = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, extra double")
    got = one(C.stat_compare(a, b))
    assert (got["columns_removed"], got["columns_added"]) == ("v", "extra")
    assert (got["main_K_distinct"], got["current_K_distinct"], got["row_difference"]) == (2, 1, 0)
    approx = one(C.stat_compare(a, b, approx=True))
    assert approx == got


def test_ab_quality(spark):
    a, b = frames(spark, [(1, None, 1.0), (2, "x", 1.0)], [(1, "x", float("nan"))])
    got = {r[0]: r[1:] for r in rows(C.ab_data_quality(a, b))}
    assert got["a"] == (1, 0, -1, 1, 1, 0)
    assert got["b"] == (0, 0, 0, 1, 1, 0)


@pytest.mark.parametrize(("rows_new", "fails"), [(110, False), (111, True), (89, True), (90, False)])
def test_gate_is_strict(spark, rows_new, fails):
    assert (C.row_count_gate(spark.range(100), spark.range(rows_new)).count() == 1) is fails


def test_gate_of_empty_old(spark):
    assert C.row_count_gate(spark.range(0), spark.range(5)).count() == 0


def test_missing_sample_is_limited(spark):
    got = C.missing_key_sample(spark.range(20).toDF("k"), spark.range(3).toDF("k"), "k")
    assert rows(got) == [("missing_in_new", k) for k in range(3, 8)]


@pytest.mark.parametrize("repeated", [False, True])
def test_map_cells_are_compared_by_their_entries(spark, repeated):
    """Whatever the order of the entries, at any depth; with unique and with repeated keys, and row by row."""

    def side(*cells):
        parts = [f"select {k} as k, {m} as m, array(named_struct('x', {m})) as deep" for k, m in enumerate(cells)]
        return spark.sql(" union all ".join([*parts, *parts] if repeated else parts))

    old = side("map('a', 1, 'b', 2)", "map('a', 1)", "map('a', 1)", "cast(null as map<string, int>)")
    new = side("map('b', 2, 'a', 1)", "map('a', 2)", "cast(map() as map<string, int>)", "map('a', cast(null as int))")
    times = 4 if repeated else 1
    got = one(C.column_compare(old, new, "k"))
    assert [got[f"m_{c}"] // times for c in C._COUNTERS] == [1, 2, 1, 0]
    assert [got[f"deep_{c}"] // times for c in C._COUNTERS] == [1, 3, 0, 0]
    labels = C.column_compare_rows(old, new, "k").select("k", "m_comparison").distinct()
    assert rows(labels, "k", "m_comparison") == [(0, C.SAME), (1, C.DIFFERENT), (2, C.DIFFERENT), (3, C.NULL_TO_VALUE)]
    by_key = C.column_compare_by_key(old, new, "k").filter("column_name = 'm' and k = 0")
    assert one(by_key)["same_count"] == times


def test_missing_keys_are_sought_by_keys_alone(spark):
    old = spark.createDataFrame([(None, "a"), (None, "b"), (3, "d"), (3, "c"), (1, "x"), (7, "y"), (8, "z")], "k int, wide string").repartition(3)
    new = spark.createDataFrame([(1, "x"), (None, "c")], "k int, wide string")
    got = C.missing_key_sample(old, new, "k", 4)
    lines = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [next((i for i, ch in enumerate(line) if ch.isalnum()), 0) for line in lines]
    for at in (i for i, line in enumerate(lines) if "LeftAnti" in line):
        below = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
        assert not any(line.strip(" :+-").startswith("Project") and "wide" in line for line in lines[at + 1 : below])
    found = [tuple(r) for r in got.collect()]
    assert found[:4] == [("missing_in_new", None, "a"), ("missing_in_new", None, "b"), ("missing_in_new", 3, "c"), ("missing_in_new", 3, "d")]
    assert found[4:] == [("missing_in_old", None, "c")]


def test_rows_are_not_sorted_to_look_up_many_repeated_keys(spark, monkeypatch):
    rows_ = [(i % 40, i % 7) for i in range(200)] + [(i, i) for i in range(100, 130)]
    old = spark.createDataFrame([*rows_, (None, 1)], "k int, v int")
    new = spark.createDataFrame([(k, v + (k % 5 == 0)) for k, v in rows_[20:]], "k int, v int")
    want = one(C.column_compare(old, new, "k", row_status=True))
    monkeypatch.setattr(C, "BROADCAST_KEYS", 3)
    got = C.column_compare(old, new, "k", row_status=True)
    lookups = [line for line in plan(got).split("\n") if "LeftAnti" in line or "LeftSemi" in line]
    assert any("ShuffledHashJoin" in line for line in lookups) and not any("SortMergeJoin" in line for line in lookups)
    assert one(got) == want
