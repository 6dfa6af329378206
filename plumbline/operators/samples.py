"""Samples of an exact size: the rows of the smallest hashes, the same for any partitioning, and mergeable."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.columns import as_list, col

DRAW = ("_draw", "_tie")


def _draws(df: DataFrame, by: str | Sequence[str] | None, seed: int) -> list[Column]:
    """Order of a row, by the hash of some columns or of the whole row (maps left out), and by the whole row where that ties."""
    whole = F.xxhash64(F.lit(seed), *[col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    if by is None:
        return [whole.cast("string").alias(DRAW[0]), whole.alias(DRAW[1])]
    text = F.concat_ws("|", *[col(b).cast("string") for b in as_list(by)])
    return [F.md5(text).alias(DRAW[0]), whole.alias(DRAW[1])]


def _smallest(drawn: DataFrame, size: int, groups: Sequence[str]) -> DataFrame:
    if not groups:
        return drawn.orderBy(*DRAW).limit(size)  # a heap of ``size`` rows per task, merged
    rank = F.row_number().over(Window.partitionBy(*[col(g) for g in groups]).orderBy(*DRAW))
    return drawn.withColumn("_rank", rank).filter(F.col("_rank") <= size).drop("_rank")  # cut inside each task first


def exact_sample(
    df: DataFrame,
    size: int,
    by: str | Sequence[str] | None = None,
    groups: str | Sequence[str] = (),
    seed: int = 0,
    keep_draw: bool = False,
) -> DataFrame:
    """min(size, rows) rows, of the table or of every group.

    With ``by`` the choice follows from the MD5 of those columns, the same on any engine; otherwise from a seeded hash of the whole
    row. Partitioning and order of the input don't matter. ``keep_draw`` keeps the columns that :func:`merged_samples` needs.
    """
    found = _smallest(df.select("*", *_draws(df, by, seed)), size, as_list(groups))
    return found if keep_draw else found.drop(*DRAW)


def merged_samples(samples: Sequence[DataFrame], size: int, groups: str | Sequence[str] = (), keep_draw: bool = False) -> DataFrame:
    """The sample of the tables behind several samples (of at least this size, the same ``by`` and seed, draws kept)."""
    found = _smallest(reduce(DataFrame.unionByName, samples), size, as_list(groups))
    return found if keep_draw else found.drop(*DRAW)
