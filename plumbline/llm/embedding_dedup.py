"""Near duplicates among embeddings by a subspace pigeonhole join.

Unit vectors of cosine c are 2 - 2c apart in squared distance. Rotated to principal axes and dealt into blocks of few
axes, a linked pair stays within its share of that distance, proportional to the block's
variance, in at least one block. Each block is joined by range on a grid over its first axes; the union of what the blocks
let through is verified by the cosine of the full vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import components, small_or_shuffled, stored

BLOCK = 8  # axes of a block
GRID = 2  # axes of a block that its grid cuts; cells are twice the block's range wide
TILE = 4_096  # rows of a cell that one task compares at a time; larger cells are split into tiles
BROADCAST_BYTES = 64 << 20  # vectors of up to so many counted bytes are broadcast to verify pairs


def _stack(column: pa.Array, dim: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in column), kind).reshape(-1, dim)


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id, label, vector) to (id, label, dim, cls, vec); dim is null for what links with nothing."""
    for batch in batches:
        dims, classes, raws = [], [], []
        labels = batch.column(1).to_pylist()
        for label, vector in zip(labels, batch.column(2), strict=True):
            values = vector.values
            ok = label is not None and vector.is_valid and len(values) > 0 and values.null_count == 0
            x = np.asarray(values.to_numpy(zero_copy_only=False), np.float64) if ok else None
            ok = ok and bool(np.isfinite(x).all()) and bool(x.any()) and np.isfinite(x @ x) and x @ x > 0
            raw = x.tobytes() if ok else None
            dims.append(len(x) if ok else None)
            raws.append(raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())], names=["id", "label", "dim", "vec"]
        )


def _units(column: pa.Array, dim: int) -> np.ndarray:
    x = _stack(column, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _moments(dim: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, outer = np.zeros(dim), 0, np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                x = _units(batch.column(0), dim)
                total, n, outer = total + x.sum(axis=0), n + len(x), outer + x.T @ x
        # rows of the moment matrix, bordered by the sums and the count
        whole = np.block([[outer, total[:, None]], [total[None, :], np.array([[float(n)]])]])
        place = np.arange(whole.size)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(whole.ravel())], names=["place", "value"])

    return go


def principal_axes(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(axes as columns, variances), largest first, of all unit vectors; (dim + 1)**2 numbers reach the driver."""
    sums = vectors.mapInArrow(_moments(dim), "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    whole = np.zeros((dim + 1) ** 2)
    for row in sums.collect():
        whole[row["place"]] = row["value"]
    whole = whole.reshape(dim + 1, dim + 1)
    n = max(whole[-1, -1], 1.0)
    mean = whole[-1, :-1] / n
    variances, axes = np.linalg.eigh(whole[:-1, :-1] / n - np.outer(mean, mean))
    return axes[:, ::-1], np.maximum(variances[::-1], 1e-12)


def _cells(dim: int, axes: np.ndarray, blocks: list[np.ndarray], budgets: np.ndarray, home: bool):
    """Batches of (cls, label, vec) to (label, block, cell, cls, part): a row per block, or per cell within range."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            turned = _units(batch.column(2), dim) @ axes
            for b, chosen in enumerate(blocks):
                part = np.ascontiguousarray(turned[:, chosen])
                reach = math.sqrt(budgets[b])
                grid = part[:, :GRID]
                low, high = np.floor((grid - reach) / (2 * reach)).astype(np.int64), np.floor((grid + reach) / (2 * reach)).astype(np.int64)
                if home:
                    corners = [np.floor(grid / (2 * reach)).astype(np.int64)]
                    used = [np.ones(len(part), bool)]
                else:  # all combinations of the lower and the upper cell of each grid axis, equal ones once
                    corners, used = [], []
                    for mask in range(1 << grid.shape[1]):
                        upper = np.array([(mask >> k) & 1 for k in range(grid.shape[1])], bool)
                        corners.append(np.where(upper, high, low))
                        used.append(~((high == low) & upper).any(axis=1))
                for corner, use in zip(corners, used, strict=True):
                    rows = np.flatnonzero(use)
                    cell = np.zeros(len(rows), np.int64)
                    for k in range(corner.shape[1]):
                        cell = cell * 1_000_003 + corner[rows, k]
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(1).take(take), pa.array(np.full(len(rows), b, np.int32)), pa.array(cell), batch.column(0).take(take),
                            pa.array([part[r].tobytes() for r in rows], pa.binary()),
                        ],
                        names=["label", "block", "cell", "cls", "part"],
                    )

    return go


def _close(blocks: list[np.ndarray], budgets: np.ndarray):
    """Pairs of one tile whose parts lie within the block's budget, the smaller class on the home side."""

    def go(key: tuple, home: pa.Table, probe: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        if home.num_rows and probe.num_rows:
            b = key[1].as_py()
            width, limit = len(blocks[b]), budgets[b] * (1 + 1e-9) + 1e-12
            x, y = (_stack(t.column("part").combine_chunks(), width) for t in (home, probe))
            a_ids, b_ids = (t.column("cls").to_numpy() for t in (home, probe))
            far = (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None, :] - 2 * (x @ y.T)
            i, j = np.nonzero((far <= limit) & (a_ids[:, None] < b_ids[None, :]))
            found = [a_ids[i], b_ids[j]]
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return go


def _cosine(threshold: float):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            dim = len(batch.column(2)[0].as_buffer()) // 8
            x, y = _stack(batch.column(2), dim), _stack(batch.column(3), dim)
            cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            pairs = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
            yield pairs.filter(pa.array(cosine >= threshold))

    return go


def _in_tiles(rows: DataFrame, sizes: DataFrame, own: str, other: str) -> DataFrame:
    """Each row with the tiles it takes part in: one slice of its own side against all slices of the other."""
    key = ["label", "block", "cell"]
    cut = rows.join(sizes, key, "left").fillna({own: 1, other: 1})
    mine = F.pmod(F.xxhash64("cls"), F.col(own)).alias(f"{own}_slice")
    theirs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(f"{other}_slice")
    return cut.select(*key, "cls", "part", mine, theirs)


def candidate_pairs(vectors: DataFrame, dim: int, threshold: float) -> DataFrame:
    """Distinct (a, b), a < b, of classes (cls, label, vec) of one dimension that agree in some block."""
    axes, variances = principal_axes(vectors.select("vec"), dim)
    n_blocks = max(1, dim // BLOCK)
    # axes are dealt back and forth, so that the blocks' variances come near each other
    turns = [k if (i // n_blocks) % 2 == 0 else n_blocks - 1 - k for i in range(0, dim, n_blocks) for k in range(n_blocks)][:dim]
    blocks = [np.array([i for i in range(dim) if turns[i] == b]) for b in range(n_blocks)]
    of_block = np.array([variances[chosen].sum() for chosen in blocks])
    budgets = max(2 - 2 * threshold, 1e-9) * of_block / of_block.sum()

    kind = vectors.schema["label"].dataType.simpleString()
    schema = f"label {kind}, block int, cell long, cls long, part binary"
    sides = [stored(vectors.select("cls", "label", "vec").mapInArrow(_cells(dim, axes, blocks, budgets, h), schema), "cells") for h in (True, False)]
    key = ["label", "block", "cell"]
    counts = [s.groupBy(*key).agg(F.ceil(F.count("*") / TILE).alias(name)) for s, name in zip(sides, ("home", "probe"), strict=True)]
    sizes = stored(counts[0].join(counts[1], key).where("home > 1 or probe > 1"), "cell-sizes")
    tiled = [_in_tiles(s, small_or_shuffled(sizes), *names) for s, names in zip(sides, (("home", "probe"), ("probe", "home")), strict=True)]
    tile = [*key, "home_slice", "probe_slice"]
    pairs = tiled[0].groupBy(*tile).cogroup(tiled[1].groupBy(*tile)).applyInArrow(_close(blocks, budgets), "a long, b long")
    return pairs.distinct()


def embedding_near_duplicates(
    embeddings: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; links join equal, non-null labels at cosine >= threshold.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with
    nothing; neither do vectors of different lengths. Equal vectors of a label are one class, whose members all link.
    ``component_id`` is the smallest id reachable (null if no member has one) and ``kept`` says whether the row has it. Ids may repeat.
    """
    kinds = {c: embeddings.schema[c].dataType.simpleString() for c in (vec_id, label)}
    given = embeddings.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
    rows = given.mapInArrow(_usable, f"id {kinds[vec_id]}, label {kinds[label]}, dim int, vec binary")
    rows = stored(rows.withColumn("cls", F.when(F.col("dim").isNotNull(), F.xxhash64("label", "dim", "vec"))), "vectors")
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("dim").alias("dim"), F.any_value("vec").alias("vec")
    )
    classes = stored(classes, "classes")
    links = None
    for dim, n in sorted((r["dim"], r["count"]) for r in classes.groupBy("dim").count().collect()):  # lengths in use
        own = classes.where(F.col("dim") == dim)
        pairs = stored(candidate_pairs(own, dim, threshold), "candidates")
        side = own.select("cls", "vec")
        side = F.broadcast(side) if n * dim * 8 <= BROADCAST_BYTES else side
        full = pairs.join(side.toDF("a", "vec_a"), "a").join(side.toDF("b", "vec_b"), "b").select("a", "b", "vec_a", "vec_b")
        found = stored(full.mapInArrow(_cosine(threshold), "a long, b long"), "links")
        links = found if links is None else links.union(found)
    if links is None:
        links = embeddings.sparkSession.createDataFrame([], "a long, b long")

    roots = components(links)
    both = links.union(links.select("b", "a")).toDF("cls", "other")
    degree = both.join(classes.select(F.col("cls").alias("other"), "copies"), "other").groupBy("cls").agg(F.sum("copies").alias("others"))
    joined = classes.select("cls", "id", "copies").join(roots.toDF("cls", "root"), "cls", "left").join(degree, "cls", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cls"))
    smallest = joined.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = joined.join(smallest, "root").select(
        "cls", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    result = rows.select("id", "cls").join(of_class, "cls", "left")
    component = F.when(F.col("cls").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return result.select(
        F.col("id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
