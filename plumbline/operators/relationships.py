"""Relationships found in data: which columns of many tables are contained in which others.

All tables become one inverted index, value -> set of columns that hold it, the sets as bitmaps that are combined inside the map tasks. The
sets of all values, counted, answer every pair of columns at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions.columns import BOOLEAN, DATE, NUMERIC, STRING, col, compact, dtype_of, family, in_rows, ratio
from plumbline.session import stored

WORD = 62  # columns one bitmap word stands for
EXACT = 9e15  # whole doubles below this are written like integers


def _value(df: DataFrame, name: str) -> tuple[str, Column] | None:
    """Kind and text of a column's values, the same text for equal values of one kind whatever their type; None for nested types."""
    value, dtype = col(name), dtype_of(df, name)
    kind = family(dtype)
    if isinstance(dtype, T.DecimalType) and dtype.scale > 0:
        return kind, F.regexp_replace(value.cast("string"), r"\.?0+$", "")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        number = value.cast("double")
        whole = (number == F.floor(number)) & (F.abs(number) < EXACT)
        return kind, F.when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string"))
    if kind == STRING:
        return kind, compact(value)
    if kind == DATE:  # a day and its midnight are different values
        return type(dtype).__name__, value.cast("string")
    return (kind, value.cast("string")) if kind in (NUMERIC, BOOLEAN) else None


def inclusion_dependencies(
    tables: Mapping[str, DataFrame], min_share: float = 1.0, columns: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Every pair of columns of which at least ``min_share`` of the first's distinct values occur in the second.

    ``table_name, column_name, in_table, in_column, distinct_values, contained_values, share, in_column_is_unique`` (no value of
    the second occurs twice: the pair may be a foreign key and its key). NULLs are no values; columns without values are left
    out, as are nested ones. Whole numbers are equal across numeric types; dates, timestamps, texts and booleans meet their like only. One
    shuffle of distinct values, whatever the number of columns; long texts travel as digests. The jobs run before the result is returned.
    """
    places: list[tuple[str, str]] = []
    parts, counts = [], []
    for table, df in tables.items():
        cells = []
        for name in (columns or {}).get(table, df.columns):
            found = _value(df, name)
            if found is not None:
                cells.append([F.lit(len(places)), F.lit(found[0]), found[1]])
                places.append((table, name))
        if cells:
            parts.append(in_rows(df, cells, ("place", "kind", "value")).filter(F.col("value").isNotNull()))
            here = [p for p in places if p[0] == table]
            wide = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, (_, c) in enumerate(here)])
            first = len(places) - len(here)
            counts.append(in_rows(wide, [[F.lit(first + i), F.col(f"n{i}")] for i in range(len(here))], ("place", "filled")))
    words = range(-(-len(places) // WORD))
    own = [F.when(F.floor(F.col("place") / WORD) == w, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % WORD)).otherwise(0) for w in words]
    # a value of a hot column, or held by many, is one row per task
    index = reduce(DataFrame.union, parts).groupBy("kind", "value").agg(*[F.bit_or(o).alias(f"w{w}") for w, o in zip(words, own)])
    sets = index.groupBy(*[f"w{w}" for w in words]).agg(F.count(F.lit(1)).alias("n"))
    listed = F.array(*[F.when(F.col(f"w{p // WORD}").bitwiseAND(F.lit(1 << (p % WORD))) != 0, F.lit(p)) for p in range(len(places))])
    sets = sets.select("n", F.array_compact(listed).alias("held"))
    # a row per set and two of its columns: bounded by the schemas, summed up inside the tasks
    pairs = sets.select("n", "held", F.explode("held").alias("a")).select("n", "a", F.explode("held").alias("b"))
    pairs = stored(pairs.groupBy("a", "b").agg(F.sum("n").alias("common")), "column-pairs")
    sizes = pairs.filter("a = b").select("a", F.col("common").alias("distinct_values"))
    filled = reduce(DataFrame.union, counts).withColumnRenamed("place", "b")
    unique = sizes.withColumnRenamed("a", "b").join(F.broadcast(filled), "b").select("b", (F.col("distinct_values") == F.col("filled")).alias("unique"))
    table_of = F.array(*[F.lit(t) for t, _ in places])
    column_of = F.array(*[F.lit(c) for _, c in places])
    share = ratio(F.col("common"), F.col("distinct_values"))
    # a row per column: small by the schemas
    return (
        pairs.filter("a <> b")
        .join(F.broadcast(sizes), "a")
        .join(F.broadcast(unique), "b")
        .filter(share >= min_share)
        .select(
            F.get(table_of, F.col("a")).alias("table_name"),
            F.get(column_of, F.col("a")).alias("column_name"),
            F.get(table_of, F.col("b")).alias("in_table"),
            F.get(column_of, F.col("b")).alias("in_column"),
            "distinct_values",
            F.col("common").alias("contained_values"),
            share.alias("share"),
            F.col("unique").alias("in_column_is_unique"),
        )
    )
