"""Minimal keys of a table, found level by level in the lattice of its column sets.

A set is ruled out without a look at the table if it holds a smaller key, if its columns cannot make enough combinations, or
if two known rows agree on it. What is left is settled exactly, by pivots: a pivot is a few columns on which few rows agree, and the columns on which
those pairs of rows agree besides settle every set that holds the pivot. So one join settles many sets. Sets without a pivot are counted, many in one pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import combinations
from math import ceil, prod
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions import values as V
from plumbline.functions.columns import comparable_cell
from plumbline.session import stored

SAMPLE = 100_000  # rows whose neighbours are compared, per column; what they cannot rule out is settled on the whole table
AGREEMENTS = 50_000  # column sets on which two sampled rows agree, at most
SETS = 24  # column sets counted in one pass
PAIRS = 32  # pairs of rows, per row of the table, that agree on a pivot, at most
GROUP = 2_000  # rows that agree on a pivot, at most: their pairs are formed in one task


class Keys(NamedTuple):
    keys: DataFrame  # key_columns, size, row_count
    levels: DataFrame  # size, candidates, by_bound, by_agreement, counted, keys


def _agreement(row: str, other: str, size: int) -> Column:
    """Bitmap of the columns on which two rows agree."""
    agree = [F.when(F.col(f"{row}c{k}") == F.col(f"{other}c{k}"), 1 << k).otherwise(0).cast("bigint") for k in range(size)]
    return sum(agree[1:], agree[0]).alias("mask")


def _agreements(rows: DataFrame, n: int, distinct: list[int]) -> list[int]:
    """Bitmaps of columns on which two rows of a sample agree, found between neighbours when sorted by each column.

    Each proves that no subset of it is a key. Only sets that no other contains are kept. A sample holds a share of a column's values, each with
    all its rows, so that rows that agree meet; of a column with few values it holds a share of the rows.
    """
    cells = [f"c{i}" for i in range(len(distinct))]
    share = ceil(n / SAMPLE)
    row = F.struct(*cells)
    masks = None
    for i in range(len(cells)):
        # the other columns, from the next on, follow in the order: neighbours agree on as much as possible
        rest = [f"c{(i + k) % len(cells)}" for k in range(1, len(cells))]
        by = f"c{i}" if distinct[i] >= 4 * share else "id"
        few = rows.filter(F.pmod(F.xxhash64(by), F.lit(share)) == 0).limit(SAMPLE)
        before = F.lag(row).over(Window.partitionBy(f"c{i}").orderBy(*rest))
        pairs = few.select(*cells, before.alias("p")).filter(F.col("p").isNotNull())
        found = pairs.select(_agreement("", "p.", len(cells)))
        masks = found if masks is None else masks.union(found)
    listed = masks.groupBy("mask").count().orderBy(F.desc(F.bit_count("mask")), "mask").limit(AGREEMENTS)
    largest: list[int] = []
    for r in listed.collect():
        if not any(r["mask"] & m == r["mask"] for m in largest):
            largest.append(r["mask"])
    return largest


def _mask(columns: Sequence[int]) -> int:
    return sum(1 << i for i in columns)


class _Pivots:
    """Settles sets by the pairs of rows that agree on a part of them."""

    def __init__(self, rows: DataFrame, n: int, pairs: list[float], most: list[int]):
        self.rows, self.n, self.pairs, self.most = rows, n, pairs, most
        self.masks: dict[tuple[int, ...], DataFrame] = {}  # of each pivot, the sets of columns on which its pairs agree
        self.refused: set[tuple[int, ...]] = set()

    def _expected(self, pivot: tuple[int, ...]) -> float:
        """Pairs that agree on the pivot if its columns have nothing to do with each other."""
        every = self.n * (self.n - 1) / 2
        return prod(self.pairs[i] for i in pivot) / every ** (len(pivot) - 1)

    def _choice(self, s: tuple[int, ...]) -> tuple[int, ...] | None:
        """The least pivot in a set that may do, a known one first."""
        for pivot in self.masks:
            if set(pivot) <= set(s):
                return pivot
        for size in range(1, len(s)):
            fit = [(self._expected(p), p) for p in combinations(s, size) if p not in self.refused]
            if fit and min(fit)[0] <= PAIRS * self.n:
                return min(fit)[1]
        return None

    def _take(self, pivot: tuple[int, ...]) -> None:
        names = [f"c{i}" for i in pivot]
        if len(pivot) == 1:
            pairs, most = self.pairs[pivot[0]], self.most[pivot[0]]
        else:
            group = F.count(F.lit(1)).cast("double")
            counted = self.rows.groupBy(*names).agg(group.alias("g"))
            pairs, most = counted.agg(F.sum(F.col("g") * (F.col("g") - 1) / 2), F.max("g")).first()
        if pairs > PAIRS * self.n or most > GROUP:
            self.refused.add(pivot)
            return
        size = len(self.pairs)
        a = self.rows.select(F.struct("*").alias("a"), *names)
        b = self.rows.select(F.struct("*").alias("b"), *names)
        joined = a.hint("merge").join(b, names).filter(F.col("a.id") < F.col("b.id"))
        self.masks[pivot] = stored(joined.select(_agreement("a.", "b.", size)).distinct(), "agreements")

    def settle(self, sets: Sequence[tuple[int, ...]]) -> tuple[set[tuple[int, ...]], list[tuple[int, ...]]]:
        """(sets on which rows agree, sets without a pivot)."""
        spark = self.rows.sparkSession
        wanted, repeated = list(sets), set()
        while True:
            choice = {s: self._choice(s) for s in wanted}
            new = Counter(p for p in choice.values() if p is not None and p not in self.masks)
            if not new:
                break
            self._take(max(new, key=lambda p: (new[p], -len(p))))
        for pivot in dict.fromkeys(p for p in choice.values() if p is not None):
            of_pivot = [(k, _mask(s)) for k, s in enumerate(wanted) if choice[s] == pivot]
            listed = F.broadcast(spark.createDataFrame(of_pivot, "k int, s long"))
            agreeing = self.masks[pivot].join(listed, F.col("mask").bitwiseAND(F.col("s")) == F.col("s")).select("k").distinct()
            repeated |= {wanted[r["k"]] for r in agreeing.collect()}  # a row a set
        return repeated, [s for s in wanted if choice[s] is None]


def _unique(rows: DataFrame, sets: Sequence[tuple[int, ...]]) -> set[tuple[int, ...]]:
    """The sets whose combinations never repeat: counted by two 64-bit hashes, a pass for SETS sets."""
    found: set[tuple[int, ...]] = set()
    for first in range(0, len(sets), SETS):
        some = sets[first : first + SETS]
        cells = [[F.col(f"c{i}") for i in s] for s in some]
        hashes = [F.struct(F.lit(k).alias("k"), F.xxhash64(*c).alias("a"), F.xxhash64(F.lit(1), *c).alias("b")) for k, c in enumerate(cells)]
        counted = rows.select(F.inline(F.array(*hashes))).groupBy("k", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        repeated = {r["k"] for r in counted.filter("n > 1").select("k").distinct().collect()}  # a row a set
        found |= {s for k, s in enumerate(some) if k not in repeated}
    return found


def minimal_keys(df: DataFrame, max_size: int = 4, columns: Sequence[str] | None = None) -> Keys:
    """All sets of up to ``max_size`` columns without NULLs whose combinations are unique, and no part of which is.

    Columns with NULLs belong to no key, constant ones to none of a table of two or more rows; of an empty table every column is one. ``levels`` tells how many
    sets of each size were candidates (no part of them a key), how many of these were ruled out by the product of distinct counts and by two
    rows that agree, how many were settled on the whole table, and how many are keys. Up to 62 columns. Jobs run before the result is returned.
    """
    columns = list(columns or df.columns)
    if len(columns) > 62:
        raise ValueError("at most 62 columns; name those that may be part of a key")
    count = F.col(V.COUNT).cast("double")
    pairs, most = F.sum(count * (count - 1) / 2).alias("pairs"), F.max(V.COUNT).alias("most")
    ledger = V.value_ledger(df, columns)
    totals = V.ledger_totals(ledger).join(ledger.groupBy(V.COLUMN).agg(pairs, most), V.COLUMN)
    totals = V.named(totals, columns).collect()  # a row a column
    n = max((r["rows"] for r in totals), default=0)
    distinct = {r["column_name"]: r["distinct"] for r in totals if r["non_null"] == r["rows"]} if n else dict.fromkeys(columns, 0)
    useful = [c for c in columns if c in distinct and (n < 2 or distinct[c] > 1)]
    keys = [(i,) for i, c in enumerate(useful) if distinct[c] == n]
    report = [(1, len(columns), len(columns) - len(useful), 0, len(useful), len(keys))]
    agreements, pivots = [], None
    if max_size > 1 and len(keys) < len(useful) and len(useful) > 1:
        of = {r["column_name"]: r for r in totals}
        cells = [comparable_cell(df, c).alias(f"c{i}") for i, c in enumerate(useful)]
        known = stored(df.select(*cells, F.monotonically_increasing_id().alias("id")), "key-rows")
        agreements = _agreements(known, n, [distinct[c] for c in useful])
        pivots = _Pivots(known, n, [of[c]["pairs"] for c in useful], [of[c]["most"] for c in useful])
    for size in range(2, max_size + 1):
        free = [i for i in range(len(useful)) if (i,) not in keys]
        candidates = [s for s in combinations(free, size) if not any(set(k) <= set(s) for k in keys)]
        enough = [s for s in candidates if prod(distinct[useful[i]] for i in s) >= n]
        open_ = [s for s in enough if not any(_mask(s) & m == _mask(s) for m in agreements)]
        repeated, rest = pivots.settle(open_) if open_ else (set(), [])
        counted = _unique(known, rest) if rest else set()
        new = [s for s in open_ if (s in counted if s in set(rest) else s not in repeated)]
        report.append((size, len(candidates), len(candidates) - len(enough), len(enough) - len(open_), len(open_), len(new)))
        keys += new
    spark = df.sparkSession
    rows = [(", ".join(useful[i] for i in k), len(k), n) for k in keys]
    levels = "size int, candidates long, by_bound long, by_agreement long, counted long, keys long"
    return Keys(spark.createDataFrame(rows, "key_columns string, size int, row_count long"), spark.createDataFrame(report, levels))
