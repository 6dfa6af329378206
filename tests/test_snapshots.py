"""Tables merged by key in place: same result as a batch merge, bounded work, crashes, versions."""

from __future__ import annotations

import json
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators.leave import merge_latest
from plumbline.sources import snapshots as S
from plumbline.streaming import ingest

ROW = "k string, day string, at long, v string"


def made(spark, items):
    return spark.createDataFrame(items, ROW)


def some(rng, n, days, first):
    return [(f"{d}|{rng.randrange(9)}", d, first + rng.randrange(6), rng.choice("abc")) for d in rng.choices(days, k=n)]


def folders_read(monkeypatch):
    """Paths of every read of the table's data."""
    read = []
    original = S._frame
    monkeypatch.setattr(S, "_frame", lambda spark, folder, paths, schema: read.append(list(paths)) or original(spark, folder, paths, schema))
    return read


@pytest.mark.parametrize("late", ["upsert", "drop"])
@pytest.mark.parametrize("partition", ["day", None])
def test_batches_equal_one_merge_after_the_other(spark, tmp_path, late, partition):
    rng = random.Random(7)
    table, target = str(tmp_path / "t"), None
    for k in range(7):
        batch = made(spark, some(rng, 12, ["d1", "d2", "d3"], 5 * k) + [(None, "d1", 5 * k + 9, "no key"), (f"d1|{k}", "d1", None, "no time")])
        S.merge_batch(batch, table, "k", "at", partition, late, batch_id=k, fold=3)
        mark = target.agg(F.max("at")).first()[0] if target is not None else None
        kept = batch if late == "upsert" or mark is None else batch.filter(F.col("at") > mark)
        target = spark.createDataFrame(merge_latest(target, kept, "k", "at").collect(), ROW)
        assert rows(S.snapshot(spark, table), "k", "day", "at", "v") == rows(target, "k", "day", "at", "v")
    assert S.current_version(spark, table) == 7
    assert S.versions(spark, table).agg(F.max("widest")).first()[0] <= 3


def test_a_batch_reads_and_writes_what_it_touches(spark, tmp_path, monkeypatch):
    """40 days of history; batches of one day read nothing, or once in FOLD the folders of that day."""
    table = str(tmp_path / "t")
    S.merge_batch(made(spark, [(f"d{d}|{i}", f"d{d}", d, "old") for d in range(40) for i in range(5)]), table, "k", "at", "day")
    read = folders_read(monkeypatch)
    for k in range(20):
        S.merge_batch(made(spark, [("d39|1", "d39", 100 + k, str(k))]), table, "k", "at", "day", batch_id=k, fold=4)
    assert [len(p) for p in read] == [4] * 6  # of 20 batches: every third folds what it found with the two since
    assert all("_part=d39" in f for p in read for f in p)
    state = json.loads((tmp_path / "t" / "versions" / "000000000021.json").read_text())
    assert len(state["parts"]) == 40 and sum(len(p) for p in state["parts"].values()) <= 43
    assert state["mark"] == "119" and state["applied"] == {"batch": 19}
    assert S.snapshot(spark, table).count() == 200
    assert [r["v"] for r in S.snapshot(spark, table).filter("k = 'd39|1'").collect()] == ["19"]


@pytest.mark.parametrize("step", ["_written", "_folded", "publish"])
def test_a_crash_leaves_the_old_table_and_a_retry_the_new_one(spark, tmp_path, monkeypatch, step):
    table = str(tmp_path / "t")
    for k in range(2):
        S.merge_batch(made(spark, [("d1|1", "d1", k, str(k))]), table, "k", "at", "day", batch_id=k, fold=3)
    before = rows(S.snapshot(spark, table))

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        original = S._written
        if step == "_written":  # after the files are there
            m.setattr(S, "_written", lambda *a: original(*a) and crash())
        else:
            m.setattr(*((S._Folder, "publish") if step == "publish" else (S, "_folded")), crash)
        with pytest.raises(KeyboardInterrupt):
            S.merge_batch(made(spark, [("d1|1", "d1", 9, "new")]), table, "k", "at", "day", batch_id=2, fold=3)
    assert rows(S.snapshot(spark, table)) == before and S.current_version(spark, table) == 2
    for _ in range(2):  # the second time changes nothing
        assert S.merge_batch(made(spark, [("d1|1", "d1", 9, "new")]), table, "k", "at", "day", batch_id=2, fold=3) == 3
    assert rows(S.snapshot(spark, table)) == [("d1|1", "d1", 9, "new")]
    assert S.expire_versions(spark, table, keep=1) >= 3
    assert rows(S.snapshot(spark, table)) == [("d1|1", "d1", 9, "new")]
    assert len(list((tmp_path / "t" / "data").glob("*/_part=*"))) == 1


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    S.merge_batch(made(spark, [("d1|1", "d1", 1, "a")]), table, "k", "at", "day")
    original = S._written

    def overtaken(*a):
        monkeypatch.setattr(S, "_written", original)
        S.merge_batch(made(spark, [("d1|2", "d1", 2, "first")]), table, "k", "at", "day")
        return original(*a)

    monkeypatch.setattr(S, "_written", overtaken)
    with pytest.raises(S.Conflict):
        S.merge_batch(made(spark, [("d1|3", "d1", 3, "second")]), table, "k", "at", "day")
    assert rows(S.snapshot(spark, table), "k") == [("d1|1",), ("d1|2",)]


def test_versions_stay_readable_and_columns_are_added(spark, tmp_path):
    table = str(tmp_path / "t")
    S.merge_batch(made(spark, [("d1|1", "d1", 1, "a"), ("x/y=1 %|2", "x/y=1 %", 1, "a"), ("n|1", None, 1, "no day")]), table, "k", "at", "day")
    wider = made(spark, [("d1|1", "d1", 2, "b")]).withColumn("extra", F.lit(5))
    S.merge_batch(wider.drop("v"), table, "k", "at", "day")
    S.merge_batch(made(spark, []), table, "k", "at", "day")
    assert rows(S.snapshot(spark, table)) == [("d1|1", "d1", 2, None, 5), ("n|1", None, 1, "no day", None), ("x/y=1 %|2", "x/y=1 %", 1, "a", None)]
    assert rows(S.snapshot(spark, table, 1), "k", "v") == [("d1|1", "a"), ("n|1", "no day"), ("x/y=1 %|2", "a")]
    assert S.high_water_mark(spark, table) == "2"
    with pytest.raises(ValueError, match="extra"):
        S.merge_batch(wider.withColumn("extra", F.lit("text")), table, "k", "at", "day")
    with pytest.raises(ValueError, match="merged by"):
        S.merge_batch(made(spark, []), table, "v", "at", "day")
    with pytest.raises(ValueError, match="no version 9"):
        S.snapshot(spark, table, 9)


def test_a_new_stream_starts_over_and_a_restarted_one_goes_on(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "t")

    def run(checkpoint):
        updates = spark.readStream.schema(ROW).parquet(source)
        ingest.merge_stream(updates, table, str(tmp_path / checkpoint), "k", lambda b: b, "at", "upsert", "day").awaitTermination()
        return S.current_version(spark, table)

    made(spark, [("d1|1", "d1", 1, "a")]).write.mode("append").parquet(source)
    assert run("one") == 1
    assert run("one") == 1
    made(spark, [("d1|2", "d1", 2, "b")]).write.mode("append").parquet(source)
    assert run("one") == 2
    assert run("two") == 3  # reads everything again, and changes no row
    assert rows(ingest.merged_table(spark, table)) == [("d1|1", "d1", 1, "a"), ("d1|2", "d1", 2, "b")]


def test_a_table_without_a_version(spark, tmp_path):
    assert S.current_version(spark, str(tmp_path / "none")) == 0
    with pytest.raises(ValueError, match="no version"):
        S.snapshot(spark, str(tmp_path / "none"))


def test_late_rows_go_by_the_watermark_across_restarts(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "t")
    schema = ROW + ", seen timestamp"

    def deliver(*items):
        rows_ = spark.createDataFrame([(k, "d", at, v, 0) for k, at, v in items], ROW + ", x int").drop("x")
        rows_.withColumn("seen", F.timestamp_seconds("at")).coalesce(1).write.mode("append").parquet(source)
        updates = spark.readStream.schema(schema).parquet(source)
        ingest.merge_stream(updates, table, str(tmp_path / "cp"), "k", lambda b: b.drop("seen"), "at", "watermark", "day", 8, "seen", "10 seconds").awaitTermination()
        return rows(ingest.merged_table(spark, table), "k", "at", "v")

    assert deliver(("a", 100, "1"), ("b", 50, "1")) == [("a", 100, "1"), ("b", 50, "1")]  # no watermark yet
    # 95 is late but within the delay, 80 is not; the repeated row is dropped by the state
    assert deliver(("c", 95, "2"), ("d", 80, "2"), ("a", 100, "2"), ("b", 101, "2")) == [("a", 100, "1"), ("b", 101, "2"), ("c", 95, "2")]
    assert deliver(("a", 92, "3"), ("e", 90, "3")) == [("a", 100, "1"), ("b", 101, "2"), ("c", 95, "2")]
    with pytest.raises(ValueError, match="go together"):
        ingest.merge_stream(spark.readStream.schema(schema).parquet(source), table, "cp", "k", lambda b: b, late="watermark")
