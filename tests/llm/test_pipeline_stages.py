"""Rows of every pipeline stage against plain loops, on small tables with shared ids, null ids and clashing columns."""

from __future__ import annotations

import collections
import random
import re

import pytest

import corpus_pipeline
from plumbline.llm.toxicity import toxic_passages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = SCHEMA + ", _id int, _tag int, _gone_id int, _GONE_TAG int, _again_id int, _leaked_id int, id int, tag int, row int"


def docs_of(spark, rows):
    full = [(i, t, "en", "s", None if t is None else len(t), 1, 2, 3, 4, 5, 6, 7, 8, 9) for i, t in rows]
    return spark.createDataFrame(full, EXTRA).repartition(3)


def told(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())


def sentences(rng, n):
    return " ".join(" ".join(f"w{rng.randrange(4000)}" for _ in range(9)) + "." for _ in range(n))


def rows_with_copies():
    rng = random.Random(8)
    base, other = sentences(rng, 12), sentences(rng, 12)
    near = base.replace("w", "W", 1).rsplit(" ", 2)[0] + " changed end."
    nameless = sentences(rng, 10)
    return [
        (1, base), (2, near), (2, other),  # a unique text that shares the id of a copy
        (None, base), (None, nameless), (None, nameless), (None, nameless.rsplit(" ", 1)[0]),  # copies without an id
        (7, "one short text"), (8, "one short text"), (8, "one short text"), (9, None), (9, None), (10, ""), (11, " \n "),
        (12, sentences(rng, 5)), (12, sentences(rng, 6)),
    ]


def near_dedup_by_loops(rows, size=5):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])

    unique = list(dict.fromkeys(rows))
    sets = [shingles(t) for _, t in unique]
    group = list(range(len(unique)))
    for a in range(len(unique)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return unique, sets, group


def test_near_dedup_keeps_one_document_of_each_group(spark):
    rows = rows_with_copies()
    docs = docs_of(spark, rows)
    left = corpus_pipeline.near_dedup(spark, docs, "unused")
    assert left.columns == docs.columns
    got = told(left)
    unique, sets, group = near_dedup_by_loops(rows)
    assert all(n == 1 for (_, t), n in got.items() if (t or "").split())
    for g in set(group):
        members = [unique[k] for k in range(len(unique)) if group[k] == g and sets[k]]
        if members:
            kept = [m for m in members if m in got]
            ids = [m[0] for m in members if m[0] is not None]
            assert len(kept) == 1 and kept[0][0] == (min(ids) if ids else None)
    wordless = collections.Counter(r for r in rows if not (r[1] or "").split())
    assert {k: n for k, n in got.items() if k in wordless} == dict(wordless)


def test_other_stages_by_loops(spark, tmp_path):
    rng = random.Random(9)
    item = " ".join(f"question{k}x" for k in "abcdefghijklmnopqrst") + "?"
    passage = sentences(rng, 8)
    rows = rows_with_copies()
    rows += [(20, f"Before. {item} After."), (21, item.upper()), (None, f"x {item}"), (30, passage + " " + sentences(rng, 3)), (31, sentences(rng, 3) + " " + passage)]
    toxic_words = ["vile", "scum", "filth"]
    labelled = [(100 + k, sentences(rng, 4) if k % 2 else sentences(rng, 2) + " " + " ".join(rng.choices(toxic_words, k=12)) + ".") for k in range(60)]
    rows += labelled
    docs = docs_of(spark, rows)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(i, 1, 0 if i % 2 else 1) for i, _ in labelled]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    asked = re.findall(r"\w+", item.lower())
    want = [r for r in rows if " ".join(asked) not in " ".join(re.findall(r"\w+", (r[1] or "").lower()))]
    assert left.columns == docs.columns and told(left) == collections.Counter(want) and len(want) == len(rows) - 3

    scored = toxic_passages(docs, spark.read.parquet(str(tmp_path / "labels.parquet")), corpus_pipeline.F.expr(corpus_pipeline.TRAIN), keep_tag=True)
    rejected = {(r["doc_id"], r["tag"]) for r in scored.collect() if r["predicted"] == 1}
    left = corpus_pipeline.toxicity(spark, docs, str(tmp_path))
    tagged = docs.select("doc_id", "text", corpus_pipeline.fingerprint(docs["text"]).alias("t")).collect()
    assert left.columns == docs.columns and told(left) == collections.Counter((r["doc_id"], r["text"]) for r in tagged if (r["doc_id"], r["t"]) not in rejected)
    gone = {i for i, _ in rows} - {r["doc_id"] for r in left.collect()}
    assert gone == {i for i, t in labelled if "vile" in t or "scum" in t or "filth" in t}

    left = corpus_pipeline.substring_dedup(spark, docs, str(tmp_path))
    assert left.columns == docs.columns and left.count() == len(rows)
    texts = {r["doc_id"]: r for r in left.collect()}
    assert passage in texts[30]["text"] and passage not in texts[31]["text"] and texts[31]["n_chars"] == len(texts[31]["text"])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, name, tmp_path):
    for table, schema in (("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, spark.createDataFrame([], SCHEMA), str(tmp_path)).count() == 0
