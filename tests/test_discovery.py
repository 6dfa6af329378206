"""Checksum trees, relationships, key lattices and sketches against plain Python and exact results."""

from __future__ import annotations

import random
from decimal import Decimal
from itertools import combinations

import pytest
from helpers import one, plan, rows
from pyspark.sql import functions as F

from plumbline.operators import checksum as C
from plumbline.operators import drift as D
from plumbline.operators import keys as K
from plumbline.operators import relationships as R
from plumbline.operators import sketches as S
from plumbline.operators.compare import row_compare
from plumbline.plans import all_queries

# ---- checksum tree


def versions(spark):
    old = spark.range(20_000).selectExpr("id", "if(id % 7 = 0, null, id % 100) a", "cast(id % 50 as double) / 3 x", "repeat(cast(id as string), 20) s")
    new = old.selectExpr("id", "if(id in (11, 12000), a + 1, a) a", "x", "s").filter("id <> 500").union(old.filter("id < 3"))
    return old, new


@pytest.mark.parametrize("multiset", [False, True])
@pytest.mark.parametrize("bucket_rows", [1, 10_000])
def test_checksum_tree_equals_row_compare(spark, multiset, bucket_rows):
    old, new = versions(spark)
    pairs = [(old, new)] if bucket_rows == 1 else [(new, old), (old, old.filter("id < 0")), (old, old.selectExpr("-id id", "a", "x", "s"))]
    for a, b in pairs:
        want = one(row_compare(a, b, "m", multiset=multiset))
        assert one(C.checksum_compare(a, b, "m", multiset=multiset, bucket_rows=bucket_rows)) == want


def test_equal_tables_shuffle_digests_only(spark, monkeypatch):
    old, _ = versions(spark)
    shuffled = old.repartition(5, "a").select("s", "x", "a", "id")
    rows_compared = []
    monkeypatch.setattr(C, "row_compare", lambda *a: rows_compared.append(a))
    got = one(C.checksum_compare(old, shuffled, "m"))
    assert not rows_compared and got["main_row_count"] == got["current_row_count"] == 20_000
    assert got["rows_in_main_not_current"] == got["rows_in_current_not_main"] == 0
    text = plan(C.table_digests(old))
    assert text.count("Exchange") == 1 and "partial_sum" in text  # after digests have been summed up in the tasks


def test_few_differences_compare_few_rows(spark, monkeypatch):
    """Of 20,000 rows a side, those of a handful of buckets are compared; stored digests stand for a side."""
    old, new = versions(spark)
    compared = []
    original = C.row_compare
    monkeypatch.setattr(C, "row_compare", lambda a, b, *rest: compared.append(a.count() + b.count()) or original(a, b, *rest))
    held = C.table_digests(old)
    got = one(C.checksum_compare(old, new, "m", main_digests=held, bucket_rows=1))
    assert (got["rows_in_main_not_current"], got["rows_in_current_not_main"]) == (3, 2)
    assert compared[0] < 40


def test_checksums_tell_nulls_and_copies_apart(spark):
    schema = "a int, b int"
    pairs = [([(1, None)], [(None, 1)]), ([(1, 1), (1, 1), (2, 2)], [(1, 1), (2, 2), (2, 2)]), ([(0, 0)], []), ([], [])]
    for left, right in pairs:
        a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
        for multiset in (False, True):
            assert one(C.checksum_compare(a, b, "m", multiset=multiset)) == one(row_compare(a, b, "m", multiset=multiset))
    zeros = spark.sql("select 0.0D x union all select double('NaN')"), spark.sql("select -0.0D x union all select double('NaN')")
    assert one(C.checksum_compare(*zeros, "m"))["rows_in_main_not_current"] == 0


# ---- relationships


def test_inclusions_match_plain_sets(spark):
    rng = random.Random(4)
    long = "long text that both hold " * 10
    a = [(i, float(i % 5), rng.choice(["x", "y", None, long]), Decimal(i % 3).quantize(Decimal("0.01")), i % 2 == 0, None) for i in range(40)]
    b = [(i * 2, i / 2, rng.choice(["x", "y", "z", long]), Decimal("1.50")) for i in range(30)]
    tables = {
        "a": spark.createDataFrame(a, "id int, f double, s string, d decimal(9,2), b boolean, nothing string"),
        "b": spark.createDataFrame(b, "k long, half double, s string, d decimal(9,2)"),
        "c": spark.createDataFrame([(["nested"], 1)], "l array<string>, one long"),
    }
    columns = {}
    for t, df in tables.items():
        for c, kind in df.dtypes:
            values = [r[0] for r in df.select(c).collect() if r[0] is not None]
            if values and kind != "array<string>":
                family = "s" if kind == "string" else "b" if kind == "boolean" else "n"
                columns[t, c] = ({(family, float(v) if family == "n" else v) for v in values}, len(values))
    for share in (1.0, 0.4):
        want = []
        for p, (x, _) in columns.items():
            for q, (y, n) in columns.items():
                common = len(x & y)
                if p != q and common and common >= share * len(x):
                    want.append((*p, *q, len(x), common, common / len(x), len(y) == n))
        assert rows(R.inclusion_dependencies(tables, share)) == sorted(want, key=repr)
    assert {r[1] for r in rows(R.inclusion_dependencies(tables, 0.01, {"a": ["id"], "b": ["k"], "c": []}))} == {"id", "k"}


def test_inclusions_of_more_columns_than_a_word(spark):
    wide = spark.range(20).select(*[F.when(F.col("id") < 20 - i % 7, F.col("id")).alias(f"c{i}") for i in range(130)])
    found = R.inclusion_dependencies({"w": wide})
    want = sum(1 for i in range(130) for j in range(130) if i != j and 20 - i % 7 <= 20 - j % 7)
    assert found.count() == want
    assert found.filter("not in_column_is_unique").count() == 0


def test_inclusions_take_one_shuffle_of_values(spark, monkeypatch):
    df = spark.range(10).selectExpr("id", "id % 3 m", "cast(id as string) s")
    plans = []
    original = R.stored
    monkeypatch.setattr(R, "stored", lambda d, purpose: plans.append(plan(d)) or original(d, purpose))
    plans.append(plan(R.inclusion_dependencies({"a": df, "b": df})))
    assert "".join(plans).count("Exchange hashpartitioning(kind") == 1 and "BroadcastNestedLoop" not in "".join(plans)


def test_the_other_order_of_equal_tables_is_dealt_by_size(spark, tmp_path, monkeypatch):
    spark.range(500).selectExpr("id l_orderkey", "id % 2 l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    given = []
    compare = C.checksum_compare
    monkeypatch.setattr(C, "checksum_compare", lambda a, b, *rest, **more: given.append(plan(b)) or compare(a, b, *rest, **more))
    found = one(all_queries()["checksum_compare_equal"](spark, str(tmp_path)))
    assert "REBALANCE_PARTITIONS_BY_COL" in given[0] and "REPARTITION_BY_NUM" not in given[0]
    assert (found["main_row_count"], found["current_row_count"], found["rows_in_main_not_current"], found["rows_in_current_not_main"]) == (500, 500, 0, 0)


# ---- keys


def keys_by_loops(data, names, size):
    found = []
    for k in range(1, size + 1):
        for s in combinations(range(len(names)), k):
            if any(set(f) <= set(s) for f in found):
                continue
            cells = [tuple(r[i] for i in s) for r in data]
            if all(None not in c for c in cells) and len(set(cells)) == len(cells):
                found.append(s)
    return sorted(", ".join(names[i] for i in s) for s in found)


@pytest.mark.parametrize("seed", range(3))
def test_minimal_keys_match_plain_loops(spark, seed, monkeypatch):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "e", "f"]
    data = [tuple(rng.randrange(m) for m in (3, 9, 4, 30, 12, 60)) for _ in range(60)]
    data = [(*r[:5], None if seed == 2 and i == 7 else r[5]) for i, r in enumerate(dict.fromkeys(data))]
    df = spark.createDataFrame(data, ", ".join(f"{n} int" for n in names)).repartition(3)
    monkeypatch.setattr(K, "SAMPLE", 25)  # most sets have to be counted
    found = K.minimal_keys(df, 5)
    assert sorted(r["key_columns"] for r in found.keys.collect()) == keys_by_loops(data, names, 5)
    levels = found.levels.orderBy("size").collect()
    assert [r["size"] for r in levels] == [1, 2, 3, 4, 5]
    assert all(r["candidates"] == r["by_bound"] + r["by_agreement"] + r["counted"] for r in levels)
    assert all(r["keys"] <= r["counted"] for r in levels)


@pytest.mark.parametrize("group", [2_000, 1])
def test_pairs_of_rows_settle_sets_without_counting_them(spark, monkeypatch, group):
    rng = random.Random(5)
    names = ["a", "b", "c", "d", "e"]
    data = list(dict.fromkeys(tuple(rng.randrange(m) for m in (40, 5, 9, 50, 12)) for _ in range(120)))
    data += [(1000, *r[1:]) for r in data[:2]] + [(1001, *r[1:]) for r in data[:2]]
    df = spark.createDataFrame(data, ", ".join(f"{n} int" for n in names)).repartition(3)
    monkeypatch.setattr(K, "SAMPLE", 10)
    monkeypatch.setattr(K, "GROUP", group)
    counted = []
    unique = K._unique
    monkeypatch.setattr(K, "_unique", lambda *a: counted.append(a[-1]) or unique(*a))
    assert sorted(r["key_columns"] for r in K.minimal_keys(df, 4).keys.collect()) == keys_by_loops(data, names, 4)
    assert bool(counted) == (group == 1)  # a pivot whose rows are too many is not taken


def test_agreeing_rows_rule_out_most_sets(spark):
    df = spark.range(3000).selectExpr("id div 4 o", "id % 4 n", *[f"pmod(hash(id, {k}), {m}) c{k}" for k, m in enumerate((2, 3, 50, 7))], "1 k")
    found = K.minimal_keys(df, 3)
    assert [r["key_columns"] for r in found.keys.collect()] == ["o, n"]
    counted = {r["size"]: (r["candidates"], r["counted"]) for r in found.levels.collect()}
    assert counted[2][1] <= 3 and counted[3][1] <= 6 and counted[3][0] == 16


def test_keys_of_small_tables(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert sorted(r["key_columns"] for r in K.minimal_keys(empty).keys.collect()) == ["a", "b"]
    assert K.minimal_keys(spark.createDataFrame([(1, 2)] * 3, "a int, b int")).keys.count() == 0
    assert [r[0] for r in K.minimal_keys(spark.createDataFrame([(1, None)], "a int, b int")).keys.collect()] == ["a"]
    assert K.minimal_keys(spark.createDataFrame([(1, None), (2, 3), (2, 3)], "a int, b int")).keys.count() == 0
    with pytest.raises(ValueError, match="62"):
        K.minimal_keys(spark.range(1).select(*[F.lit(i).alias(f"c{i}") for i in range(63)]))


# ---- sketches


def events(spark):
    # one day holds most rows, one value a third of them
    return spark.range(30_000).selectExpr(
        "timestamp '2024-01-01' + make_dt_interval(if(id % 2 = 0, 9, cast(id % 20 as int))) ts",
        "case when id % 3 = 0 then 7 when id % 31 = 0 then null else id * id % 9973 end v",
        "if(id % 13 = 0, null, concat('user', id % 4000)) u",
        "cast(null as double) n",
    )


def test_states_merge_to_the_state_of_the_whole(spark, tmp_path):
    df, folder = events(spark), str(tmp_path / "state")
    for k in range(3):
        S.add_batch(S.sketch_state(df.filter(f"pmod(hash(v, u), 3) = {k}"), "ts"), folder, k)
    S.add_batch(S.sketch_state(df.filter("pmod(hash(v, u), 3) = 1"), "ts"), folder, 1)  # delivered again
    S.compact_state(spark, folder, str(tmp_path / "compact"))
    exact = one(df.agg(F.count("v").alias("n"), F.avg("v").alias("a"), F.stddev_samp("v").alias("s"), F.count_distinct("v").alias("d"), F.count_distinct("u").alias("u"), F.min("v").alias("low"), F.max("v").alias("high")))
    share = {p: df.agg(F.percentile("v", [max(p - 0.03, 0.0), min(p + 0.03, 1.0)])).first()[0] for p in S.QUANTILES.values()}
    for state in (S.stored_state(spark, folder), S.stored_state(spark, str(tmp_path / "compact")), S.sketch_state(df, "ts")):
        found = {r["column_name"]: r for r in S.figures(S.merged_state(state)).collect()}
        v, u, n = found["v"], found["u"], found["n"]
        assert v["n_rows"] == 30_000 and v["n_values"] == exact["n"] and (v["min_value"], v["max_value"]) == (exact["low"], exact["high"])
        assert v["avg"] == pytest.approx(exact["a"], rel=1e-9) and v["stddev"] == pytest.approx(exact["s"], rel=1e-9)
        assert abs(v["distinct_values"] - exact["d"]) <= 0.06 * exact["d"] and abs(u["distinct_values"] - exact["u"]) <= 0.06 * exact["u"]
        for name, p in S.QUANTILES.items():
            assert share[p][0] <= v[name] <= share[p][1]
        assert (n["n_values"], n["avg"], n["stddev"], n["p50"], n["distinct_values"]) == (0, None, None, None, 0)
    assert S.stored_state(spark, str(tmp_path / "compact")).count() == 10 * 3  # days with rows, columns
    one_day = S.figures(S.window_state(S.stored_state(spark, folder), "2024-01-04", "2024-01-05")).filter("column_name = 'v'").first()
    want = df.filter("date(ts) = '2024-01-04'").agg(F.count("*").alias("r"), F.avg("v").alias("a")).first()
    assert one_day["n_rows"] == want["r"] and one_day["avg"] == pytest.approx(want["a"])


def test_sketched_drift_equals_drift_of_the_rows(spark, tmp_path):
    df = events(spark)
    state = S.sketch_state(df, "ts", ["v", "u"])
    names = ("column_name", "metric", "recent_value", "comparison_value", "pct_change", "drift_severity")
    exact = {r[:2]: r for r in rows(D.detect_drift(df, "ts", "10 day", "10 day", "2024-01-21", only_drifted=False), *names)}
    got = {r[:2]: r for r in rows(S.sketched_drift(state, "10 day", "10 day", "2024-01-21", only_drifted=False), *names)}
    for key in (("v", "avg"), ("v", "stddev"), ("v", "null_rate"), ("u", "null_rate")):
        assert got[key][2:4] == exact[key][2:4] and got[key][4] == pytest.approx(exact[key][4], abs=0.02)
    assert abs(int(got["u", "distinct_count"][2]) - int(exact["u", "distinct_count"][2])) <= 0.06 * int(exact["u", "distinct_count"][2])
    assert ("u", "value_overlap") in got
    assert "FileScan" not in plan(S.sketched_drift(state.limit(0), as_of="2024-01-21"))
    with pytest.raises(ValueError, match="days"):
        S.sketched_drift(state, "3 hour")


def test_drift_of_one_sided_windows(spark):
    state = S.sketch_state(events(spark).filter("ts >= '2024-01-11'"), "ts", ["u"])
    got = {r["metric"]: r for r in S.sketched_drift(state, "10 day", "10 day", "2024-01-21", only_drifted=False).collect()}
    assert got["distinct_count"]["comparison_value"] is None and got["value_overlap"]["pct_change"] is None
    assert S.sketched_drift(state, "1 day", "1 day", "2030-01-01", only_drifted=False).count() == 0
