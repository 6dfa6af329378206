"""Near-dedup in buckets of many tiles: one component that fills most of a bucket, and members that link with nothing."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from plumbline.llm import near_dedup


def shingled(text, size=4):
    words = text.split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def components_by_loops(texts):
    sets = {i: shingled(t) for i, t in texts}
    low = {i: i for i in sets}
    links = defaultdict(set)
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y:
                both = len(sets[x] & sets[y])
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    links[x].add(y)
                    links[y].add(x)
    for i in ids:
        todo = [i]
        while todo:
            for j in links[todo.pop()]:
                if low[j] > i:
                    low[j] = i
                    todo.append(j)
    return low


@pytest.mark.parametrize("edits", [(1, 6), (4, 7)])  # most variants link, or few do
def test_large_buckets_lose_no_link(spark, monkeypatch, edits):
    monkeypatch.setattr(near_dedup, "TILE", 8)
    rng = random.Random(31)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = []
    for i in range(140):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    texts += [(200 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))) for i in range(10)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, size=4).collect()}
    want = components_by_loops(texts)
    assert got == want
    assert len(set(want.values())) >= 11


def test_members_of_the_largest_component_are_sent_once_per_slice_of_the_others(spark, monkeypatch):
    """One bucket of 400, of which 395 are linked: 395 + 5 * (1 + 50) rows instead of 400 * 50."""
    monkeypatch.setattr(near_dedup, "TILE", 8)
    rest = spark.range(400).selectExpr(
        "1L bucket", "id cls", "0 band", "if(id < 395, 0L, id) root", "400L size", "0L top", "395L top_size"
    )
    classes = spark.range(400).selectExpr("id cls", "unhex(repeat('0001', 128)) regs")
    sets = spark.range(400).selectExpr("id cls", "20L n", "unhex(repeat('0001', 1024)) estimating")
    sent = []
    original = near_dedup._tiles
    monkeypatch.setattr(near_dedup, "_tiles", lambda *a: sent.append(a) or original(*a))
    found = near_dedup._likely_in_tiles(rest, classes, sets, 80, None)
    pairs = {(r["a"], r["b"]) for r in found.collect()}
    assert pairs == {(a, b) for a in range(400) for b in range(395, 400) if a < b}  # equal registers, across components
    dealt = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in dealt and sent
