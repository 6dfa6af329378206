"""Near duplicates by SetSketch registers: banded, estimated by likelihood, verified on full sets.

A document's set is its distinct word shingles. Each element draws one exponential value per register, small
ones first and each register once, so that a register holds the minimum over the set; it is
kept as ``floor(1 - log_b(minimum))``, cut to 0 .. q + 1. Registers of a union are the larger ones
of both, and two sets agree in a register with a probability of about their similarity.

Documents of equal sets are one class from the start. Classes that agree in a whole band of
registers meet in a bucket. A bucket is not expanded into pairs: its members meet its leader, and confirmed links are
joined into components. Members of different components are then compared by their registers, in tiles of bounded size: first only the
likeliest links of each member leave the tile, and after they have joined components, all pairs that likelihood lets through. So no
candidate of the bands is left out, and few pairs that tell nothing new are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import components, fingerprint, small_or_shuffled, stored, text_chunks
from plumbline.llm.words import GOLDEN, find_words, mix, shingles

REGISTERS, BAND = 128, 4  # 32 bands of 4 registers: a pair of similarity 0.8 is missed with probability 5e-8
ESTIMATING = 1_024  # further registers of documents that share a bucket, for the likelihood
LOG_BASE, RATE, TOP = np.log(1.02), 20.0, 4094  # b, a and q of the sketch
ESTIMATE_SLACK = 0.057  # below the threshold by four and a half standard errors: not verified
LEADERS = 1  # of a bucket
NEAREST = 2  # likely links of a member that are confirmed before all others
TILE = 1_024  # members of a bucket compared with as many others at a time


def registers(hashes: np.ndarray, offsets: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Register values (texts x m, unsigned 16 bit) of the sets hashes[offsets[i]:offsets[i+1]].

    Round r gives every element a uniform value in [r/m, (r+1)/m) at one register it has not met; a text is
    done once all its registers are filled, since later values are larger.
    """
    n = len(offsets) - 1
    least = np.full(n * m, np.inf)
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(n), counts)
    start, stride = mix(hashes ^ GOLDEN), mix(hashes + GOLDEN) | np.uint64(1)
    open_texts = counts > 0
    live = np.arange(len(hashes))
    for r in range(m):
        keep = open_texts[owner[live]]
        if not keep.all():
            live = live[keep]
        if len(live) == 0:
            break
        step = np.uint64(r)
        at = ((start[live] + step * stride[live]) & np.uint64(m - 1)).astype(np.int64)
        drawn = (mix(hashes[live] * np.uint64(2 * r + 3)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(least, owner[live] * m + at, (r + drawn) / m)
        open_texts &= np.isinf(least.reshape(n, m)).any(axis=1)
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(-np.log1p(-np.clip(least, 2.0**-60, 1 - 2.0**-53)) / RATE) / LOG_BASE)
    found = np.clip(value, 0, TOP + 1).astype(np.uint16).reshape(n, m)
    found[counts == 0] = 0
    return found


def sketcher(size: int):
    """Batches of (id, text fingerprint, text) to (id, fingerprint, class, n_shingles, registers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch.column(2)):
                found, offsets = shingles(find_words(texts), size)
                n = len(texts)
                counts = np.diff(offsets)
                sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(found ^ GOLDEN), dtype=np.uint64)))
                of_set = mix(sums[offsets[1:]] - sums[offsets[:-1]] + counts.astype(np.uint64)).view(np.int64)
                rows = registers(found, offsets)
                blob = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(2 * rows.shape[1]), n, [None, pa.py_buffer(rows.tobytes())]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(begin, n) for k in (0, 1)), pa.array(of_set), pa.array(counts), blob],
                    names=["id", "fp", "cls", "n", "regs"],
                )

    return run


def set_maker(size: int):
    """Batches of (class, text) to (class, n_shingles, estimating registers, the sorted hashes of its set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch.column(1)):
                found, offsets = shingles(find_words(texts), size)
                blobs = [found[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
                more = [row.tobytes() for row in registers(mix(found), offsets, ESTIMATING)]  # unlike the banded ones
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), pa.array(np.diff(offsets)), pa.array(more, pa.binary()), pa.array(blobs, pa.binary())],
                    names=["cls", "n", "estimating", "members"],
                )

    return run


def likeliest(n_a: np.ndarray, n_b: np.ndarray, regs_a: np.ndarray, regs_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from set sizes and the registers where a is above, below or equal."""
    above, below = (regs_a > regs_b).sum(axis=1), (regs_a < regs_b).sum(axis=1)
    equal = regs_a.shape[1] - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    base = np.exp(LOG_BASE)

    def p(x):
        return -np.log1p(-x * (base - 1) / base) / LOG_BASE

    def gain(j):
        up, down = p(np.maximum(u - v * j, 1e-12)), p(np.maximum(v - u * j, 1e-12))
        same = np.maximum(1 - up - down, 1e-12)
        return above * np.log(np.maximum(up, 1e-300)) + below * np.log(np.maximum(down, 1e-300)) + equal * np.log(same)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(25):  # the likelihood is concave: narrow to its top
        left, right = low + (high - low) / 3, high - (high - low) / 3
        lower = gain(left) < gain(right)
        low, high = np.where(lower, left, low), np.where(lower, high, right)
    return (low + high) / 2


def _estimated(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            regs = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16) for k in (4, 5)]
            regs = [x.reshape(batch.num_rows, -1) for x in regs]
            n_a, n_b = (batch.column(k).to_numpy().astype(np.float64) for k in (2, 3))
            keep = likeliest(n_a, n_b, *regs) >= threshold / 100 - ESTIMATE_SLACK
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _verified(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
                shared = int((b[at] == a).sum()) if len(b) else 0
                keep.append(100 * shared >= threshold * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_())
            )

    return run


def _likely(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs of classes (a, b) of fitting sizes that likelihood lets through."""
    side = sets.select("cls", "n", "estimating")
    known = pairs.join(side.toDF("a", "n_a", "regs_a"), "a").join(side.toDF("b", "n_b", "regs_b"), "b")
    sized = known.where(f"100 * least(n_a, n_b) >= {threshold} * greatest(n_a, n_b)")
    return sized.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(_estimated(threshold), "a long, b long")


def _confirm(likely: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs of classes (a, b) whose full sets are similar."""
    likely = stored(likely, "likely")
    side = sets.select("cls", "members")
    full = likely.join(side.toDF("a", "set_a"), "a").join(side.toDF("b", "set_b"), "b")
    links = full.select("a", "b", "set_a", "set_b").mapInArrow(_verified(threshold), "a long, b long")
    return stored(links, "links")


def _tiles(threshold: int, nearest: int | None):
    """Sorted rows (bucket, first, second, side, band, cls, root, n, registers) to likely pairs between components.

    A pair that meets in several bands is told by the first of them only. With ``nearest``, only pairs that are
    among the likeliest of one of their ends are told.
    """

    def likeliest_of_each(end: np.ndarray, value: np.ndarray) -> np.ndarray:
        order = np.lexsort((-value, end))
        begins = np.flatnonzero(np.append(True, end[order][1:] != end[order][:-1]))
        rank = np.arange(len(end)) - np.repeat(begins, np.diff(np.append(begins, len(end))))
        keep = np.zeros(len(end), bool)
        keep[order[rank < nearest]] = True
        return keep

    def compare(tile: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        side, cls, root, n = (tile.column(k).to_numpy() for k in ("side", "cls", "root", "n"))
        band = tile.column("band")[0].as_py()
        regs, more = (np.frombuffer(b"".join(tile.column(k).to_pylist()), np.uint16).reshape(len(cls), -1) for k in ("regs", "estimating"))
        here = np.flatnonzero(side == 0)
        there = np.flatnonzero(side == 1) if (side == 1).any() else here
        found = []
        for at in range(0, len(here), 64):
            x = here[at : at + 64]
            fits = (root[x][:, None] != root[there][None, :]) & (
                100 * np.minimum(n[x][:, None], n[there][None, :]) >= threshold * np.maximum(n[x][:, None], n[there][None, :])
            )
            if there is here:
                fits &= cls[x][:, None] < cls[there][None, :]
            i, j = np.nonzero(fits)
            for part in range(0, len(i), 1 << 14):  # bounds what is compared at once
                a, b = x[i[part : part + (1 << 14)]], there[j[part : part + (1 << 14)]]
                equal = (regs[a] == regs[b]).reshape(len(a), -1, BAND).all(axis=2)
                new = equal.argmax(axis=1) == band
                a, b = a[new], b[new]
                if len(a):
                    value = likeliest(n[a].astype(float), n[b].astype(float), more[a], more[b])
                    good = value >= threshold / 100 - ESTIMATE_SLACK
                    found.append((a[good], b[good], value[good]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b, value = (np.concatenate([f[k] for f in found]) for k in range(3))
        if nearest is not None and len(a):
            keep = likeliest_of_each(a, value) | likeliest_of_each(b, value)
            a, b = a[keep], b[keep]
        return cls[a], cls[b]

    def told(tiles: list[pa.Table]) -> pa.RecordBatch:
        pairs = [compare(t) for t in tiles]
        ends = [np.concatenate([p[k] for p in pairs]) for k in (0, 1)]
        low, high = np.minimum(*ends), np.maximum(*ends)
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            keys = [table.column(k).to_numpy() for k in ("bucket", "first", "second")]
            edges = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            bounds = [0, *edges.tolist()]
            whole = [table.slice(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]
            held = table.slice(bounds[-1])
            if whole:
                yield told(whole)
        if held is not None:
            yield told([held])

    return go


def _likely_in_tiles(rest: DataFrame, classes: DataFrame, sets: DataFrame, threshold: int, nearest: int | None) -> DataFrame:
    """Likely pairs (a, b) between components among the members (bucket, cls, band, root, size, top, top_size) of split buckets.

    A bucket of up to TILE members is one tile. In a larger one, members of its largest component ``top`` are not compared with each other: they meet
    the slices of the other members, which meet all slices. So one component of many members costs a row of each, for as many tiles as the
    others fill, and only members that belong to no common component are sent in proportion to their number of slices.
    """
    small, at_top = F.col("size") <= TILE, F.col("root") == F.col("top")
    others = F.ceil((F.col("size") - F.col("top_size")) / TILE)  # slices of the members outside the largest component
    slices = others + F.ceil(F.col("top_size") / TILE)
    drawn = F.xxhash64("cls")
    own = F.when(small, 0).when(at_top, others + F.pmod(drawn, slices - others)).otherwise(F.pmod(drawn, others))
    last = F.when(small, 0).when(at_top, others - 1).otherwise(slices - 1)
    rows = rest.withColumn("own", own.cast("bigint")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
    sketch = classes.select("cls", "regs").join(sets.select("cls", "n", "estimating"), "cls")
    rows = rows.join(sketch, "cls").select(
        "bucket", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "band", "cls", "root", "n", "regs", "estimating",
    )
    dealt = rows.repartition("bucket", "first", "second").sortWithinPartitions("bucket", "first", "second")
    return dealt.mapInArrow(_tiles(threshold, nearest), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, size: int = 5, threshold: int = 80, doc_id: str = "doc_id", text: str = "text", keep_tag: bool = False
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; ``threshold`` is a similarity in percent.

    Links join documents with 100 * shared >= threshold * united distinct shingles of ``size`` words (A-Z
    lower-cased, words between ASCII white space). A null or wordless text has an empty set and links
    with nothing. ``component_id`` is the smallest id reachable; a component without any non-null id has
    null. ``kept`` says whether the row has that id. Repeated rows are one class; rows that share an id but not
    the text are documents of their own. Other columns of ``docs`` are not read. ``keep_tag`` adds a fingerprint ``tag`` of the text, which with the
    id tells documents apart, and ``chosen``: true for one document of each component (that of the smallest id and then tag, null ids
    last, all its repeated rows) and for texts without words. A very long text is a set like any other, made by one task.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    given = docs.select(F.col(f"`{doc_id}`").alias("id"), fingerprint(F.col(f"`{text}`")).alias("fp"), F.col(f"`{text}`").alias("text"))
    sketches = given.mapInArrow(sketcher(size), f"id {id_type}, fp long, cls long, n long, regs binary")
    sketches = stored(sketches, "sketches")
    row = F.min(F.struct(F.isnull("id").alias("last"), "id", "fp", "n", "regs")).alias("row")
    classes = sketches.where("n > 0").groupBy("cls").agg(row).select("cls", "row.id", "row.fp", "row.n", "row.regs")
    classes = stored(classes, "classes")

    width = 4 * BAND  # hexadecimal digits of a band
    digits = F.hex("regs")
    bands = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda k: F.substring(digits, k * width + 1, width))
    members = classes.select("cls", F.posexplode(bands).alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), F.col("band"), "cls"
    )
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(shared, "bucket"), "members")

    sets = _sets_of(given, sketches, classes.join(members.select("cls").distinct(), "cls"), size)

    leaders = members.groupBy("bucket").agg(*[F.min_by("cls", F.xxhash64("cls", F.lit(k))).alias(f"led_{k}") for k in range(LEADERS)])
    led = leaders.select("bucket", F.explode(F.array_distinct(F.array(*[f"led_{k}" for k in range(LEADERS)]))).alias("leader"))
    pairs = members.join(led, "bucket").where("cls <> leader").select(F.least("cls", "leader").alias("a"), F.greatest("cls", "leader").alias("b"))
    tried = stored(_likely(pairs.distinct(), sets, threshold), "likely")
    links = _confirm(tried, sets, threshold)

    for nearest in (NEAREST, None):
        roots = components(links)
        # the only pair of a bucket of two has met
        placed = members.where("size > 2").join(roots.toDF("cls", "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        counted = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
        split = counted.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
        split = split.select("bucket", F.col("most.root").alias("top"), F.col("most.n").alias("top_size"))
        rest = stored(placed.join(split, "bucket"), "rest")
        if rest.isEmpty():
            break
        more = _likely_in_tiles(rest, classes, sets, threshold, nearest)
        more = stored(more.join(tried, ["a", "b"], "left_anti"), "likely")  # no pair is verified twice
        tried = tried.union(more)
        links = stored(links.union(_confirm(more, sets, threshold)), "links")
    else:
        roots = components(links)

    joined = classes.select("cls", "id", "fp").join(roots.toDF("cls", "root"), "cls", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cls"))
    first = F.min(F.struct(F.isnull("id").alias("last"), "id", "fp")).alias("first")
    smallest = joined.groupBy("root").agg(first).select("root", F.col("first.id").alias("component_id"), F.col("first.fp").alias("first_fp"))
    of_class = joined.join(smallest, "root").select("cls", "component_id", "first_fp")
    result = sketches.select("id", "fp", "cls", "n").join(of_class, "cls", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    chosen = (F.col("n") == 0) | (F.col("id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("first_fp")))
    return result.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        *([F.col("fp").alias("tag"), chosen.alias("chosen")] if keep_tag else []),
    )


def _sets_of(given: DataFrame, sketches: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Full sets (cls, n, estimating, members) of the wanted classes (cls, id, fp), from one row of each."""
    rows = stored(wanted.select("cls", F.col("id").alias("of_id"), F.col("fp").alias("of_fp")), "wanted")
    found = given.join(small_or_shuffled(rows), F.expr("id <=> of_id and fp = of_fp")).select("cls", "text")
    made = found.mapInArrow(set_maker(size), "cls long, n long, estimating binary, members binary")
    repeated = sketches.groupBy("id", "fp").count().where("count > 1")
    if not repeated.join(rows, F.expr("id <=> of_id and fp = of_fp"), "left_semi").isEmpty():
        made = made.dropDuplicates(["cls"])
    return stored(made, "sets")
