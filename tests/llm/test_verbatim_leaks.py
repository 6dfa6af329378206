"""No word-for-word copy of a benchmark item is missed, wherever it stands."""

from __future__ import annotations

import random
import re

import pytest

from plumbline.llm.decontamination import leaked_items, without_leaks

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")


def items():
    rng = random.Random(12)
    words = "name the eight largest moons of that planet please Alice Bruno miles hours km NATO 7 12.5 where who Berlin train x".split()
    found = []
    for n in range(3, 21):
        for first in ("Name", "miles", "7", "NATO", "name"):
            body = [first, *(rng.choice(words) for _ in range(n - 1))]
            mark = rng.choice(["", "?", "."])
            found.append(" ".join(body) + mark)
    return list(dict.fromkeys(found))


@pytest.mark.parametrize("before", ["", "x ", "1 ", ". ", "Some Words ", "(", "NATO ", "3 miles "])
def test_every_item_is_found_behind_any_word(spark, before):
    bench = [(i, t) for i, t in enumerate(items())]
    docs = [(i, f"{before}{t} and then more follows") for i, t in bench]
    docs += [(1000 + i, f"{before}{t}") for i, t in bench]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaked_items(df, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    missed = [(d, t) for d, t in docs if (d, d % 1000) not in got]
    assert not missed


def test_found_short_items_are_in_the_text(spark):
    """Items of fewer than eight tokens are met by their words alone: whatever is told holds them one after the other."""
    bench = [(i, t) for i, t in enumerate(items()) if len(TOKEN.findall(t)) < 8]
    rng = random.Random(4)
    pool = [w for _, t in bench for w in t.split()]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 2, 3, 6, 300])))) for i in range(120)]
    found = leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    want = set()
    for d, text in docs:
        have = [w.lower() for w in TOKEN.findall(text)]
        for i, t in bench:
            asked = [w.lower() for w in TOKEN.findall(t)]
            if any(have[k : k + len(asked)] == asked for k in range(len(have) - len(asked) + 1)):
                want.add((d, i))
    assert got == want and want


def test_clashing_columns_survive(spark):
    schema = "doc_id long, text string, _leaked_id string, _LEAKED_TAG int, id int, tag int"
    docs = spark.createDataFrame([(1, "Name the eight largest moons of that planet please", "a", 1, 2, 3), (2, "other", "b", 4, 5, 6)], schema)
    bench = spark.createDataFrame([(1, "Name the eight largest moons of that planet please")], "item_id long, text string")
    left = without_leaks(docs, bench)
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(2, "other", "b", 4, 5, 6)]
