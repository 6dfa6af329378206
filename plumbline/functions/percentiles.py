"""Exact continuous percentiles, read off one ledger of counted values in global order.

Values are counted per group and column, so a frequent value is one row, and dealt by range of (group, column, value). A
range, called a slice here, is all one task ever holds; how many rows lie before it is a running sum over the few slices of a
group. Only slices that hold a wanted rank are read again, each with a running count of its own. One way for every
size: nothing depends on how large a group is or how many groups there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.columns import col
from plumbline.session import stored


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Long frame (by..., column_name, prob, value) of interpolated percentiles.

    Equal to ``percentile_cont`` over the non-null values; columns without any value have
    no value. The ledger is written to the shared folder.
    """
    columns, probs, by = list(columns), sorted(probs), list(by)
    narrow, keys = _narrow(df, columns, by)
    group = [*keys, "c"]
    counted = _cells(narrow, keys, columns).groupBy(*group, "v").agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.repartitionByRange(*group, "v").withColumn("s", F.spark_partition_id())
    ledger = stored(ordered, "percentile-ledger")  # fixes which slice a value lies in
    needed = _needed_slices(ledger, group, probs)
    if not by:
        needed = F.broadcast(needed)  # two slices at most per column and percentile
    renamed = {name: f"__o_{name}" for name in [*group, "s"]}
    same = [F.col(n).eqNullSafe(F.col(o)) for n, o in renamed.items()]
    within = Window.partitionBy(*group, "s").orderBy("v")
    placed = ledger.join(needed.withColumnsRenamed(renamed), same).select(
        *group, "v", "n", "total", (F.col("before") + F.sum("n").over(within)).alias("upto")
    )
    return _pick(placed, keys, columns, probs, by)


def _ranks(total: Column, prob: float) -> tuple[Column, Column, Column]:
    """Wanted rank from 0, and the whole ranks below and above it."""
    rank = (total - 1).cast("double") * F.lit(float(prob))
    return rank, F.floor(rank).cast("bigint"), F.ceil(rank).cast("bigint")


def _needed_slices(ledger: DataFrame, group: list[str], probs: list[float]) -> DataFrame:
    """(group, s, before, total) of the slices that hold a wanted rank."""
    slices = ledger.groupBy(*group, "s").agg(F.sum("n").alias("slice_rows"))
    in_order = Window.partitionBy(*group).orderBy("s")  # a row per slice of the group
    slices = slices.select(
        *group,
        "s",
        "slice_rows",
        (F.sum("slice_rows").over(in_order) - F.col("slice_rows")).alias("before"),
        F.sum("slice_rows").over(Window.partitionBy(*group)).alias("total"),
    )
    held = []
    for p in probs:
        _, low, high = _ranks(F.col("total"), p)
        held.append((low < F.col("before") + F.col("slice_rows")) & (high >= F.col("before")))
    return slices.filter(reduce(lambda a, b: a | b, held)).drop("slice_rows")


def _narrow(df: DataFrame, columns: list[str], by: list[str]) -> tuple[DataFrame, list[str]]:
    """Group keys and measured columns as doubles under names of their own."""
    keys = [f"__g{i}" for i in range(len(by))]
    measured = [col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(columns)]
    return df.select(*[col(b).alias(k) for b, k in zip(by, keys)], *measured), keys


def _cells(narrow: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per value: group keys, column position, value."""
    cells = [F.struct(F.lit(i).alias("c"), F.col(f"__x{i}").alias("v")) for i in range(len(columns))]
    return narrow.select(*keys, F.inline(F.array(*cells))).filter(F.col("v").isNotNull())


def _pick(placed: DataFrame, keys: list[str], columns: list[str], probs: list[float], by: list[str]) -> DataFrame:
    """Interpolated values at the wanted ranks of values with their count and running count."""
    group = [*keys, "c"]
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    picks = []
    for j, p in enumerate(probs):
        _, low, high = _ranks(F.col("total"), p)
        picks += [
            F.max(F.when((first <= low) & (low <= last), F.col("v"))).alias(f"low{j}"),
            F.max(F.when((first <= high) & (high <= last), F.col("v"))).alias(f"high{j}"),
        ]
    ranked = placed.groupBy(*group).agg(F.max("total").alias("total"), *picks)
    answers = []
    for j, p in enumerate(probs):
        rank, _, _ = _ranks(F.col("total"), p)
        low, high = F.col(f"low{j}"), F.col(f"high{j}")
        value = low + (high - low) * (rank - F.floor(rank))
        answers.append(F.struct(F.lit(float(p)).alias("prob"), value.alias("value")))
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("c") + 1)
    return ranked.select(
        *[F.col(k).alias(b) for k, b in zip(keys, by)], names.alias("column_name"), F.inline(F.array(*answers))
    )
