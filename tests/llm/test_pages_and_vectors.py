"""WARC round trips, embeddings against all pairs, components, and the pipeline on the small tables."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import embedding_dedup, warc
from plumbline.llm.common import components
from plumbline.llm.embedding_dedup import embedding_near_duplicates


def test_archives_round_trip(spark, tmp_path):
    long = "".join(random.Random(1).choices("abcdefghij<>\r\n", k=17 << 20))  # over 16 MiB: followed by an empty member
    rows = [
        (1, "http://a/ b", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "u", "same"), (5, "u", "same"), (4, "u\r\nx: y", "same"),
        (6, "u", ""), (7, "u", long), (None, "u", "same"), (None, "u", "alone"),
    ]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    base = str(tmp_path)
    warc.write_archives(pages, f"{base}/stream")
    warc.normalise_archives(spark, f"{base}/stream", f"{base}/members")
    index = warc.index_archives(spark, f"{base}/members", f"{base}/index").collect()
    assert len(index) == len(rows)
    got = {(r["page_id"], r["payload_digest"]): r for r in index}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        r = got[page_id, base64.b32encode(hashlib.sha1(raw).digest()).decode()]
        assert r["payload_bytes"] == len(raw)
        best = max((i for i, _, h in rows if (h or "") == (html or "") and i is not None), default=None)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page_id == best else ("revisit", best))
        with open(r["archive"].removeprefix("file:"), "rb") as file:
            content = file.read()
        record = warc.record_at(content, r["offset"], r["length"])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert r["record_type"] == "revisit" or record[: -len(warc.END)].endswith(raw)
        assert gzip.decompress(content).count(b"WARC-Record-ID: ") == sum(x["archive"] == r["archive"] for x in index)
    assert len({r["record_id"] for r in index}) == len(rows)
    least = warc.archived(pages, least_revisit=1)
    assert least.where("page_id in (2, 6) and record_type = 'response'").count() == 2
    assert warc.archived(pages.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [4_096, 8])
def test_embeddings_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    draw = np.random.default_rng(2)
    rows = []
    for label in (0, 1, None):
        for group in range(6):
            centre = draw.standard_normal(16)
            for _ in range(8):
                rows.append((len(rows), (centre + draw.standard_normal(16) * draw.choice([0.05, 0.2, 0.3])).astype(np.float32).tolist(), label))
    rows += [(900 + k, rows[0][1], 0) for k in range(30)] + [(950, rows[0][1], 1), (None, rows[0][1], 0)]
    rows += [(960, None, 0), (961, [], 0), (962, [0.0] * 16, 0), (963, [float("nan")] * 16, 0), (964, [None] + [1.0] * 15, 0), (965, [1.0, 2.0], 0), (966, [float("inf")] * 16, 0)]
    rows += [(967, [2.0, 4.0], 0), (3, rows[3][1], 0)]
    x = []
    for _, v, label in rows:
        ok = label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= 0.93:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    want = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        low = min(ids, default=None) if x[i] is not None else vec_id
        want.append((vec_id, n[i], low, vec_id is not None and vec_id == low))
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, cls int")
    got = [tuple(r) for r in embedding_near_duplicates(table).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert embedding_near_duplicates(table.limit(0)).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300), (None, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), **dict.fromkeys((200, 201, 202), 200)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_on_the_smallest_tables(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    docs, before = documents, documents.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == documents.columns, name
        kept = docs.count()
        assert 0 < kept <= before
        before = kept
    packed = corpus_pipeline.run(spark, sf)
    assert packed.select("doc_id").distinct().count() == before
    nothing = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], documents.schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        odd = stage(spark, odd, sf)
    assert odd.count() == 3


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROWS_PER_FILE", 4)
    monkeypatch.setattr(warc, "ROW_BYTES", 400_000)
    html = F.concat(F.lit("é"), F.expr("repeat('x', 200000)"), F.col("id"))
    pages = spark.range(0, 40, 1, 2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    warc.write_archives(pages, f"{tmp_path}/stream")
    files = [gzip.decompress(p.read_bytes()) for p in (tmp_path / "stream").glob("*.gz")]
    assert len(files) > 4 and max(map(len, files)) <= 4 * 400_000 + 16
    assert sum(f.count(b"WARC-Record-ID: ") for f in files) == 40
    warc.normalise_archives(spark, f"{tmp_path}/stream", f"{tmp_path}/members")
    index = warc.index_archives(spark, f"{tmp_path}/members", f"{tmp_path}/index")
    assert index.where("payload_bytes between 200002 and 200005").select("page_id").distinct().count() == 40
