"""Stored intermediate tables, text-safe Arrow batches and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.session import scratch_dir

SMALL_SIDE_ROWS = 1_000_000  # a counted side of up to so many short rows may be broadcast
ROW_GROUP_BYTES = 32 << 20  # of stored tables: what a writing task holds in memory
CHUNK_BYTES = 2 << 20  # text handled by one vectorised step inside a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and no longer lost with an executor.

    The folder stays until whoever owns ``spark.checkpoint.dir`` clears it, since the result
    of an operator is lazy and may still read it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    writer = df.write.option("parquet.block.size", ROW_GROUP_BYTES)
    writer.parquet(path, compression=codec)  # the session's codec if none is given
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """A stored table of short rows, hinted for broadcast if its counted rows are few.

    Beyond the bound it is the build side of a shuffled hash join, so that a wide other side
    need not be sorted.
    """
    return F.broadcast(df) if df.count() <= rows else df.hint("shuffle_hash")


def fingerprint(text: Column) -> Column:
    """Tells rows apart that share an id (or have none) but differ in their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of about ``limit`` bytes; a longer text is a slice of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = _offsets(texts)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield begin, texts.slice(begin, end - begin)
        begin = end


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    found = np.frombuffer(texts.buffers()[1], kind) if texts.buffers()[1] is not None else np.zeros(1, kind)
    return found[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts in them) of an array without nulls."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(texts)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b); root is the smallest node reachable.

    Alternates the large-star and small-star steps until the stars stay as they are. Each step
    is a count per node and a join, so a node with very many neighbours is one row of
    the reduced side; no group is gathered. Self-loops and null ends are ignored.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = stored(now.distinct(), "edges")
    state = None
    while True:
        both = now.union(now.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
        )
        now = stored(small.distinct(), "edges")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == state:
            break
        state = seen
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
