"""Key tallies: how often each key occurs on each of several sides.

Every reconciliation question (missing on one side, surplus, overlap, repeated keys) is a
filter over one tally, so any number of sides costs one scan each and one shuffle of keys
that were already counted inside the map tasks. A key that holds a large share of the
rows reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.columns import col, zero_if_null

SIDE = "__side"


def on_side(index: int) -> str:
    return f"__n{index}"


def tag_sides(sides: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """UNION ALL of the given columns of every side with the side's position."""
    tagged = [df.select(*[col(c) for c in columns], F.lit(i).alias(SIDE)) for i, df in enumerate(sides)]
    return reduce(DataFrame.union, tagged)


def side_tally(sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per distinct key tuple (NULLs compare equal) with the row count of each side."""
    counts = [F.count_if(F.col(SIDE) == i).alias(on_side(i)) for i in range(len(sides))]
    return tag_sides(sides, keys).groupBy(*[col(k) for k in keys]).agg(*counts)


def side_counts(sides: Sequence[DataFrame]) -> DataFrame:
    """One row with the row count of each side; no data column is read."""
    counts = [F.count_if(F.col(SIDE) == i).alias(on_side(i)) for i in range(len(sides))]
    return tag_sides(sides, []).agg(*counts)


def total(value: Column) -> Column:
    return zero_if_null(F.sum(value))
