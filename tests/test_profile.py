from __future__ import annotations

import datetime as dt

import pytest
from helpers import one, plan, rows
from pyspark.sql import functions as F

from plumbline.functions import values as V
from plumbline.functions import percentiles
from plumbline.functions.percentiles import exact_percentiles
from plumbline.operators import drift as D
from plumbline.operators import profile as P
from plumbline.operators.samples import exact_sample, merged_samples


def metrics(df):
    return {(r["column_name"], r["metric"]): r["metric_value"] for r in df.collect()}


def test_profile_of_empty_and_null_columns(spark):
    schema = "n int, s string, d date, b boolean"
    empty = metrics(P.profile_dataset(spark.createDataFrame([], schema)))
    assert empty["n", "count"] == "0" and empty["n", "null_pct"] is None and empty["n", "p50"] is None
    assert empty["s", "distinct_values"] == "0" and empty["s", "top_5_values"] is None
    assert empty["b", "true_pct"] is None and empty["d", "date_range_days"] is None
    nulls = metrics(P.profile_dataset(spark.createDataFrame([(None, None, None, None)] * 2, schema)))
    assert nulls["n", "null_pct"] == "100.00" and nulls["n", "stddev"] is None
    assert nulls["b", "true_count"] == "0" and nulls["b", "true_pct"] is None
    single = metrics(P.profile_dataset(spark.createDataFrame([(5, "ab", dt.date(2024, 1, 2), True)], schema)))
    assert single["n", "p95"] == "5.0000" and single["n", "stddev"] is None and single["b", "true_pct"] == "100.00"


def test_profile_families(spark):
    texts = spark.createDataFrame([("a", "b")], "x string, y string")
    assert {r["data_type"] for r in P.profile_dataset(texts).collect()} == {"string"}
    nested = texts.withColumn("z", F.array("x", "y"))
    other = [r for r in P.profile_dataset(nested).collect() if r["data_type"] == "other"]
    assert {r["metric"] for r in other} == {"count", "null_count", "null_pct"}
    order = [(r[0], r[1], r[2]) for r in P.profile_dataset(nested).collect()]
    assert order == sorted(order)


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "ffeeddccbbaaa"], "s string")
    assert metrics(P.profile_dataset(df))["s", "top_5_values"] == "a (3), b (2), c (2), d (2), e (2)"


def test_approx_profile_has_the_same_rows(spark):
    df = spark.range(500).selectExpr("id n", "cast(id % 9 as string) s", "date_add(date'2024-01-01', cast(id % 50 as int)) d", "id % 2 = 0 b")
    exact, approx = metrics(P.profile_dataset(df)), metrics(P.profile_dataset(df, approx=True))
    assert exact.keys() == approx.keys()
    assert exact["s", "top_5_values"] == approx["s", "top_5_values"]


def test_sample(spark):
    df = spark.range(20000).toDF("id")
    chosen = exact_sample(df, 1000, by="id")
    assert chosen.count() == 1000 and chosen.columns == ["id"]
    assert rows(chosen) == rows(exact_sample(df.repartition(7), 1000, by="id"))
    assert exact_sample(df, 50000, by="id").count() == 20000
    assert exact_sample(df, 1000).count() == 1000
    assert rows(exact_sample(df, 1000)) != rows(exact_sample(df, 1000, seed=1))
    assert exact_sample(df.filter("id < 0"), 10).count() == 0
    parts = [exact_sample(df.filter(f"id % 3 = {k}"), 1000, "id", keep_draw=True) for k in range(3)]
    assert rows(merged_samples(parts, 1000)) == rows(chosen)
    assert "TakeOrderedAndProject" in plan(chosen)


def test_sample_of_every_group(spark):
    df = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 1000 = 1, null, cast(id % 50 as string))) g", "map(1, id) m")
    chosen = exact_sample(df, 7, groups="g")
    sizes = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert {r["g"]: r["n"] for r in chosen.groupBy("g").agg(F.count("*").alias("n")).collect()} == {g: min(n, 7) for g, n in sizes.items()}
    assert "WindowGroupLimit" in plan(chosen)
    parts = [exact_sample(df.filter(f"id % 2 = {k}"), 7, groups="g", keep_draw=True) for k in range(2)]
    assert rows(merged_samples(parts, 7, "g"), "id") == rows(chosen, "id")
    same = spark.range(100).selectExpr("1 x")  # rows that nothing tells apart
    assert exact_sample(same, 10).count() == 10


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_percentiles_of_large_and_small_groups(spark, partitions):
    # one group holds most rows, one value holds a third of them
    df = spark.range(60000).selectExpr(
        "if(id % 10 < 8, 'hot', if(id % 10 = 8, 'cold', null)) g",
        "case when id % 3 = 0 then 42.0 when id % 29 = 0 then null else pow((id * 7919) % 60000, 2) / 977 end x",
        "cast((id * 31) % 1000 as int) y",
    ).repartition(13)
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    want = {
        r["g"]: r for r in df.groupBy("g").agg(F.percentile("x", probs).alias("x"), F.percentile("y", probs).alias("y")).collect()
    }
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many slices as partitions
    try:
        got = exact_percentiles(df, ["x", "y"], probs, ["g"]).collect()
        ungrouped = exact_percentiles(df, ["x"], probs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 3 * 2 * 6
    for r in got:
        assert r["value"] == pytest.approx(want[r["g"]][r["column_name"]][probs.index(r["prob"])], rel=1e-9)
    whole = df.agg(F.percentile("x", probs).alias("x")).collect()[0]["x"]
    assert len(ungrouped) == 6
    for r in ungrouped:
        assert r["value"] == pytest.approx(whole[probs.index(r["prob"])], rel=1e-9)


def test_percentiles_ignore_null_only_columns(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {r["column_name"]: r["value"] for r in exact_percentiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {"a": 2.0}
    assert exact_percentiles(df.filter("a < 0"), ["a", "b"], [0.5]).count() == 0


def test_percentiles_read_only_the_slices_that_hold_a_rank(spark):
    """40 slices, one column, one percentile: the ranked rows are those of at most two slices; a value held by a third is one row."""
    df = spark.range(80_000, numPartitions=8).selectExpr("cast(if(id % 3 = 0, 1000, id) as double) x")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = []
        original = percentiles._pick
        percentiles._pick = lambda p, *a: placed.append(p.count()) or original(p, *a)
        got = exact_percentiles(df, ["x"], [0.5]).collect()
    finally:
        percentiles._pick = original
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["value"] for r in got] == [df.agg(F.percentile("x", 0.5)).first()[0]]
    assert 0 < placed[0] < 53_334 / 40 * 2 * 2


def test_value_ledger_types(spark):
    df = spark.createDataFrame([(1, 0.0, "x", True, dt.date(2024, 1, 1)), (1, -0.0, None, False, None)], "i int, f double, s string, b boolean, d date")
    totals = {r["column_name"]: (r["rows"], r["non_null"], r["distinct"]) for r in V.named(V.ledger_totals(V.value_ledger(df, df.columns)), df.columns).collect()}
    assert totals == {"i": (2, 2, 1), "f": (2, 2, 1), "s": (2, 1, 1), "b": (2, 2, 2), "d": (2, 1, 1)}


def test_tied_long_texts_rank_by_value(spark):
    start = "same beginning " * 10
    items = [(start + e, i % 2) for i in range(2) for e in "hgfedcba"] + [("z" * 64, 0), (start[:64], 0), (None, 0), ("", 1)]
    df = spark.createDataFrame(items, "s string, w int").repartition(5)
    metrics = {r["metric"]: r["metric_value"] for r in P.profile_dataset(df).collect() if r["column_name"] == "s"}
    assert metrics["top_5_values"] == ", ".join(f"{start}{e} (2)" for e in "abcde")
    assert metrics["distinct_values"] == "11"
    ledger = V.value_ledger(df, ["s"], F.col("w"), nulls=False)
    best = V.most_frequent(df, ["s"], ledger, 2, F.col("w")).collect()
    assert sorted((r["w"], r["__rank"], r[V.V_TEXT]) for r in best) == [
        (0, 1, start[:64]), (0, 2, start + "a"), (1, 1, ""), (1, 2, start + "a")
    ]


def test_profile_columns_subset_of_families(spark):
    got = one(P.profile_columns(spark.createDataFrame([("ab",), (None,)], "s string"), ["s:varchar"]))
    assert (got["min_length"], got["distinct_values"], got["min_value"], got["null_percentage"]) == (2, 1, None, 50.0)


def test_summarize(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 3, None), (None, 5, 2.0)], "g string, x int, y double")
    got = one(P.summarize(df, "m"))
    assert (got["x_median"], got["y_null_count"], got["model_name"]) == (3.0, 1, "m")
    grouped = {r["g"]: r for r in P.summarize(df, "m", "g").collect()}
    assert grouped[None]["x_median"] == 5.0 and grouped["a"]["y_null_percentage"] == 50.0
    assert "g_min" not in grouped["a"].asDict()
    assert P.summarize(df, "m", ["g"], approx=True).count() == 2


def test_aggregate_measure(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 9.0), ("b", None), (None, 1.0)], "g string, v double")
    got = P.aggregate_measure(df, "g", "v", ["sum", "median", "count_distinct"]).collect()
    assert [r["g"] for r in got] == ["b", "a", None]
    assert [r["median_value"] for r in got] == [9.0, 2.0, 1.0] and got[0]["null_percentage"] == 50.0
    assert [r["g"] for r in P.aggregate_measure(df, "g", "v", ["count"]).collect()] == ["a", "b", None]
    with pytest.raises(ValueError):
        P.aggregate_measure(df, "g", "v", ["mode"])


def test_date_distribution(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 9),), (dt.date(2024, 5, 1),), (None,)], "d date")
    got = P.date_distribution(df, "m", "d", "quarter").collect()
    assert [r["date_granularity"] for r in got] == ["quarter", "2024-1", "2024-2"]
    assert got[0]["total_records"] == 3 and got[0]["avg_period_count"] == 1.5
    per_bucket = sum(r["total_records"] for r in P.date_distribution(df, "m", "d", "day").collect()[1:])
    assert per_bucket == 3
    with pytest.raises(ValueError):
        P.date_distribution(df, "m", "d", "hour")


def test_incremental_counts(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 2, 4)], "d date")
    assert [tuple(r)[1:] for r in P.incremental_counts(df, "m", "d", 3).collect()] == [
        (dt.date(2024, 1, 4), 4),
        (dt.date(2024, 1, 3), 3),
        (dt.date(2024, 1, 2), 3),
    ]
    assert rows(P.incremental_counts(df.filter("d is null"), "m", "d", 3, as_of="2024-02-01")) == [("m", dt.date(2024, 2, 1), 0)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (2, None), (3, "c")], "k int, l string")
    got = one(P.find_duplicates(df, "m", ["k", "l"]))
    assert (got["duplicate_key_count"], got["total_duplicate_rows"], got["max_occurrences"]) == (2, 5, 3)
    assert [tuple(r) for r in P.duplicate_examples(df, "k", 1).collect()] == [("2", 3)]


def drifted(spark, recent, earlier, schema="v double, c string", **options):
    rows_of = [(dt.datetime(2024, 1, 25), *r) for r in recent] + [(dt.datetime(2024, 1, 15), *r) for r in earlier]
    df = spark.createDataFrame(rows_of, "t timestamp_ntz, " + schema)
    found = D.detect_drift(df, "t", "10 day", "10 day", "2024-01-31", only_drifted=False, **options)
    return {(r["column_name"], r["metric"]): r for r in found.collect()}


def test_drift_ties_and_missing_windows(spark):
    got = drifted(spark, [(1.0, "b"), (1.0, "a")], [(1.0, "a"), (1.0, "z")])
    assert got["c", "top_category_change"]["pct_change"] == 0.0  # tie goes to the smaller value
    got = drifted(spark, [(1.0, None)], [(1.0, "a")])
    assert got["c", "top_category_change"]["pct_change"] == 100.0
    assert got["c", "null_rate"]["drift_severity"] == "High"


def test_drift_baselines(spark):
    got = drifted(spark, [(-20.0, "a")], [(-10.0, "a")])
    assert got["v", "avg"]["pct_change"] == -100.0 and got["v", "avg"]["drift_severity"] == "Normal"
    got = drifted(spark, [(-20.0, "a")], [(-10.0, "a")], abs_baseline=True)
    assert got["v", "avg"]["drift_severity"] == "High"
    got = drifted(spark, [(5.0, "a")], [(0.0, "a")])
    assert got["v", "avg"]["pct_change"] is None and got["v", "avg"]["drift_severity"] == "Normal"


def test_drift_windows(spark):
    times = [dt.datetime(2024, 1, 10, 23), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 20, 23), dt.datetime(2024, 1, 21)]
    df = spark.createDataFrame([(t, float(i)) for i, t in enumerate(times)], "t timestamp_ntz, v double")
    got = {r["metric"]: r for r in D.detect_drift(df, "t", "10 day", "10 day", "2024-01-31", only_drifted=False).collect()}
    assert (got["avg"]["recent_value"], got["avg"]["comparison_value"]) == ("3.00", "1.50")
    with pytest.raises(ValueError):
        D.window_interval("3 fortnights")
    for text in ("1 month", "2 weeks", "6 hours", "1 quarter", "1 year"):
        assert D.detect_drift(df, "t", text, text, "2024-01-31").columns[-1] == "drift_severity"


def test_long_texts_are_counted_and_shown_whole(spark):
    long_a, long_b = "a" * 500, "a" * 499 + "b"
    df = spark.createDataFrame([(long_a,), (long_a,), (long_b,), ("short",), (None,)], "s string")
    got = metrics(P.profile_dataset(df))
    assert got["s", "distinct_values"] == "3"
    assert got["s", "top_5_values"].startswith(f"{long_a} (2), ") and f"{long_b} (1)" in got["s", "top_5_values"]


def test_drift_shows_long_texts(spark):
    got = drifted(spark, [(1.0, "x" * 200)], [(1.0, "y" * 200)])
    assert got["c", "top_category_change"]["recent_value"] == "x" * 200
