"""Toxic passages: maximal-scoring segments over token log-odds, calibrated by extreme-value statistics.

Tokens fall into a fixed number of hashed buckets, so that the model has a fixed size. A bucket's score is the log-odds
of toxic against clean texts under a Dirichlet prior with the frequencies of both, drawn to zero by its standard
error, less a small drift. All maximal segments of positive sum are found in one pass over a text. By
Karlin-Altschul, K n exp(-lambda S) segments of a score of S or more are expected in n clean tokens; a text's
evidence is the sum of what its significant segments exceed this by, and
a monotone table made from the labelled texts turns evidence into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import fingerprint, small_or_shuffled, stored, text_chunks
from plumbline.llm.words import find_words

BUCKET_BITS = 18
PRIOR_SHARE = 0.01  # the prior weighs as much as this share of all labelled tokens
CONFIDENCE = 1.96  # standard errors taken off a log-odds
DRIFT = 0.1  # per token
BINS, BIN_WIDTH = 64, 0.5  # of evidence, in the calibration table

#: letters, digits, apostrophe and all bytes of non-ASCII characters make up tokens
_GAP = np.ones(256, bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x27, *range(0x80, 0x100)]] = False


class Model(NamedTuple):
    scores: np.ndarray  # of each bucket, less the drift
    scale: float  # lambda
    log_k: float


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = find_words(texts, space=_GAP)
    return (words.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), words.first


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (toxic, text) to (bucket, clean, toxic) counts of this task."""
    counts = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for at, texts in text_chunks(batch.column(1)):
            buckets, first = _buckets(texts)
            of_word = np.repeat(labels[at : at + len(texts)], np.diff(first))
            for label in (0, 1):
                counts[label] += np.bincount(buckets[of_word == label], minlength=1 << BUCKET_BITS)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(c[used]) for c in counts)], names=["bucket", "clean", "toxic"])


def fit(labelled: DataFrame) -> Model:
    """Bucket scores from (toxic int, text); at most 2**BUCKET_BITS rows of counts reach the driver."""
    counts = labelled.mapInArrow(_count_tokens, "bucket long, clean long, toxic long")
    sums = counts.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    seen = np.zeros((2, 1 << BUCKET_BITS))
    seen[:, sums["bucket"].to_numpy(np.int64)] = sums[["clean", "toxic"]].to_numpy(float).T
    totals = seen.sum(axis=1)
    if not totals.all():
        return Model(np.full(1 << BUCKET_BITS, -DRIFT), 1.0, 0.0)
    prior = PRIOR_SHARE * seen.sum(axis=0)
    smoothed = np.maximum(seen + prior, 1e-9)
    share = smoothed / (totals * (1 + PRIOR_SHARE * totals.sum() / totals))[:, None]
    odds = np.log(share[1] / (1 - share[1])) - np.log(share[0] / (1 - share[0]))
    error = np.sqrt((1 / smoothed).sum(axis=0))
    scores = np.sign(odds) * np.maximum(np.abs(odds) - CONFIDENCE * error, 0) - DRIFT
    return Model(scores, _scale(scores, seen[0] / totals[0]), 0.0)


def _scale(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(p exp(lambda s)) = 1; 1 if the clean tokens have no positive score."""
    used = weights > 0
    scores, weights = scores[used], weights[used]
    if scores.max() <= 0 or (scores * weights).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (weights * np.exp(high * scores)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (weights * np.exp(middle * scores)).sum() < 1 else (low, middle)
    return (low + high) / 2


def maximal_segments(left: list[float], right: list[float]) -> list[tuple[int, int, float]]:
    """(first, last, sum) of all maximal segments, from cumulative sums before and after each positive token."""
    found: list[tuple[float, float, int, int, int]] = []  # left, right, first, last, nearest one before with a lower left
    for k, (low, high) in enumerate(zip(left, right, strict=True)):
        first, j = k, len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= high:
                found.append((low, high, first, k, j))
                break
            low, first, before = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = before
    return [(first, last, high - low) for low, high, first, last, _ in found]


def _scan(model: Model):
    """Batches of (id, tag, text) to evidence and passages."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_chunks(batch.column(2)):
                buckets, first = _buckets(texts)
                gains = model.scores[buckets]
                sums = np.concatenate(([0.0], np.cumsum(gains)))
                n = np.diff(first)
                best, evidence = np.zeros(len(texts)), np.zeros(len(texts))
                passages: list[list[dict]] = [[] for _ in range(len(texts))]
                positive = np.flatnonzero(gains > 0)
                bounds = np.searchsorted(positive, first)
                for i in np.flatnonzero(np.diff(bounds)):
                    tokens = positive[bounds[i] : bounds[i + 1]]
                    segments = maximal_segments(sums[tokens].tolist(), sums[tokens + 1].tolist())
                    floor = model.log_k + np.log(n[i])
                    for a, b, total in segments:
                        beyond = model.scale * total - floor
                        if beyond > 0:
                            evidence[i] += beyond
                            begin = int(tokens[a] - first[i])
                            passages[i].append({"start": begin, "length": int(tokens[b] - tokens[a] + 1), "expected": float(np.exp(-beyond))})
                    best[i] = max(total for _, _, total in segments)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("expected", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(at, len(texts)) for k in (0, 1)),
                        pa.array(n), pa.array(best), pa.array(evidence), pa.array(passages, kind),
                    ],
                    names=["id", "tag", "n_tokens", "best", "evidence", "passages"],
                )

    return go


def _fit_k(labelled: DataFrame, model: Model) -> Model:
    """K from how many clean texts exceed the score that one in a hundred tokens' worth of texts should."""
    level = float(np.log(100.0)) / model.scale
    row = labelled.where("toxic = 0").agg(
        F.sum(F.when(F.col("best") >= level, 1).otherwise(0)).alias("over"), F.sum("n_tokens").alias("n")
    ).first()
    if not row["n"]:
        return model
    return model._replace(log_k=float(np.log(max(row["over"], 1) / (row["n"] / 100.0))))


def _table(labelled: DataFrame, evidence: Column) -> list[float]:
    """Share of toxic texts at each bin edge, made monotone by pooling neighbours that disagree."""
    bin_ = F.least(F.floor(evidence / BIN_WIDTH), F.lit(BINS)).cast("int")
    seen = {r["bin"]: (r["n"], r["toxic"]) for r in labelled.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()}
    pools: list[list[float]] = []
    for k in range(BINS + 1):
        n, toxic = seen.get(k, (0, 0))
        pools.append([n, toxic, 1])
        while len(pools) > 1 and (pools[-1][0] == 0 or pools[-2][0] == 0 or pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]):
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    values = [(toxic + 0.5) / (n + 1) if n else 0.0 for n, toxic, bins in pools for _ in range(int(bins))]
    return [float(v) for v in np.maximum.accumulate(values)]


def toxic_passages(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", keep_tag: bool = False) -> DataFrame:
    """(id, score, predicted, n_tokens, passages) of every row of ``docs``; with ``keep_tag`` also a fingerprint ``tag`` of its text.

    ``train`` is a condition over a column ``id``: the rows whose labels (doc_id, toxic 0/1) may be used. Of equal labelled texts one
    is learnt, with the label most of them have (a tie counts as toxic). Null labels are left out. Null, empty and
    tokenless texts have no passages and the score of texts without evidence. Without labelled texts of both kinds every score is the
    share of toxic ones. ``passages`` lists start and length in tokens and the number of such
    passages expected in a clean text of that length. Rows keep their multiplicity; ids may be null or repeated; other
    columns are not read.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    given = docs.select(F.col(f"`{doc_id}`").alias("id"), fingerprint(F.col(f"`{text}`")).alias("tag"), F.col(f"`{text}`").alias("text"))
    marks = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(train)
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    learnt = given.select("id", "tag").join(marks, "id").groupBy("tag").agg(F.min("id").alias("id"), F.avg("toxic").alias("share"))
    learnt = stored(learnt.select("id", "tag", F.when(F.col("share") >= 0.5, 1).otherwise(0).alias("toxic")), "learnt")
    model = fit(given.join(small_or_shuffled(learnt), ["id", "tag"]).select("toxic", "text"))

    kind = "array<struct<start:long,length:long,expected:double>>"
    schema = f"id {id_type}, tag long, n_tokens long, best double, evidence double, passages {kind}"
    # a first K of one in a hundred; evidence is linear in log K only where it is positive, so K is fitted on the best segment
    sums = given.join(small_or_shuffled(learnt), ["id", "tag"]).select("id", "tag", "text", "toxic")
    best = sums.select("id", "tag", "text").mapInArrow(_scan(model), schema).select("id", "tag", "n_tokens", "best")
    best = stored(best.join(learnt, ["id", "tag"]), "best")
    model = _fit_k(best, model)
    scanned = stored(given.mapInArrow(_scan(model), schema), "scanned")
    table = _table(scanned.join(small_or_shuffled(learnt), ["id", "tag"]), F.col("evidence"))

    cells = F.array(*[F.lit(v) for v in table])
    place = F.least(F.col("evidence") / BIN_WIDTH, F.lit(float(BINS)))
    low = F.floor(place).cast("int")
    here, then = F.element_at(cells, low + 1), F.element_at(cells, F.least(low + 2, F.lit(BINS + 1)))
    score = here + (then - here) * (place - low)
    return scanned.withColumn("score", score).select(
        F.col("id").alias(doc_id), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_tokens", "passages", *(["tag"] if keep_tag else [])
    )
