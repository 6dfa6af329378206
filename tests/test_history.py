"""Histories kept by increments: same rows as all loads at once, repeats, ties, null keys, bounded reading."""

from __future__ import annotations

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.sources import snapshots as S
from plumbline.sources.history import END, extend_history, read_history

ROW = "k string, n int, v string, loaded_at timestamp_ntz, valid_to string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def made(spark, items):
    return spark.createDataFrame([(k, n, v, None if at is None else day(at), "x") for k, n, v, at in items], ROW)


def told(df):
    assert not {"_slot", "_changed_at"} & set(df.columns)
    return collections.Counter((r["k"], r["n"], r["v"], r["valid_from"], r["valid_to"], r["is_current"]) for r in df.collect())


def expected(items, changes_only):
    """By definition, key by key."""
    found, by_key = collections.Counter(), collections.defaultdict(dict)
    for k, n, v, at in items:
        if at is None:
            continue
        if k is None:
            found[(k, n, v, day(at), None, True)] += 1
        else:
            low = (n is not None, n or 0, v is not None, v or "")
            by_key[k][at] = max(by_key[k].get(at, (low, n, v)), (low, n, v))
    for k, moments in by_key.items():
        kept = []
        for at in sorted(moments):
            if not (changes_only and kept and kept[-1][1:] == moments[at][1:]):
                kept.append((at, *moments[at][1:]))
        for i, (at, n, v) in enumerate(kept):
            to = day(kept[i + 1][0]) if i + 1 < len(kept) else None
            found[(k, n, v, day(at), to, to is None)] += 1
    return found


@pytest.mark.parametrize("changes_only", [False, True])
def test_increments_equal_all_loads_at_once(spark, tmp_path, changes_only):
    rng = random.Random(5)
    table, seen = str(tmp_path / "t"), []
    for step in range(5):
        moments = [20 * step, 20 * step + 7]
        load = [(rng.choice(["a", "b", "c", "d", "hot", "hot", "hot"]), rng.choice([1, 2, None]), rng.choice(["x", None]), rng.choice(moments)) for _ in range(12)]
        if not changes_only:  # ties of a moment: the greatest row; a row left out as a repeat could have been one of them
            load += load[:2]
        else:
            load = list({(k, at): (k, n, v, at) for k, n, v, at in load}.values())
        load += [(None, step, "own", moments[0]), ("a", 9, "no time", None)]
        seen += load
        extend_history(made(spark, load), table, "k", changes_only=changes_only, fold=3)
        extend_history(made(spark, load), table, "k", changes_only=changes_only, fold=3, batch_id=step)
        want = expected(seen, changes_only)
        assert told(read_history(spark, table)) == want
    current = read_history(spark, table, current=True)
    assert told(current) == collections.Counter({r: n for r, n in want.items() if r[-1]})
    moment = day(47)
    valid = {r: n for r, n in want.items() if r[3] <= moment and (r[4] is None or r[4] > moment)}
    assert told(read_history(spark, table, at=moment)) == collections.Counter(valid)
    assert all(S.snapshot(spark, table).filter(F.col("_slot") == F.lit(END).cast("timestamp_ntz")).select(F.col("valid_to").isNull()).distinct().toPandas().iloc[:, 0])


def test_a_load_reads_open_rows_only(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    for step in range(3):
        extend_history(made(spark, [(f"k{i}", step, "v", 40 * step) for i in range(20)]), table, "k", fold=100)
    read, original = [], S._frame
    monkeypatch.setattr(S, "_frame", lambda spark, folder, paths, schema: read.extend(paths) or original(spark, folder, paths, schema))
    extend_history(made(spark, [("k1", 7, "v", 200)]), table, "k", fold=100)
    assert read and all("_part=open-" in p for p in read)


def test_empty_loads_new_columns_and_old_versions(spark, tmp_path):
    table = str(tmp_path / "t")
    extend_history(made(spark, []), table, "k")
    assert read_history(spark, table).count() == 0
    first = extend_history(made(spark, [("a", 1, "x", 0)]), table, "k")
    extend_history(made(spark, [("a", 2, "y", 1), ("a", 1, "late", 0)]).withColumn("more", F.lit(5)), table, "k")
    got = read_history(spark, table)
    assert sorted((r["n"], r["v"], r["more"], r["is_current"]) for r in got.collect()) == [(1, "x", None, False), (2, "y", 5, True)]
    assert read_history(spark, table, version=first).filter("is_current and n = 1").count() == 1
