"""Whole-row comparison by a tree of checksums: only rows below differing nodes are ever shuffled.

Rows are dealt into buckets by their hash. A bucket's digest (row count and four sums over two hashes of its rows) is the same for
the same rows in any order. Digests are summed up inside the map tasks, so two equal tables shuffle nothing but digests; where they differ, the
bucket is divided further, and the rows of the last differing buckets are compared one by one. The digests of a side can be stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.columns import as_list, col, comparable_cell, zero_if_null
from plumbline.functions.tally import total
from plumbline.operators.compare import row_compare, same_type_columns
from plumbline.session import stored

BITS = 16  # buckets of the first level, as a power of 2
WIDEST = 20  # buckets of a further level, as a power of 2: what may be broadcast
BUCKET_ROWS = 1_000  # rows a bucket is wanted to have at most before its rows are compared
LAST = 60  # bits of the hash that name a bucket at most
SUMS = ("low1", "high1", "low2", "high2")


def _hashes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with two hashes of its row; a NULL counts where it stands."""
    cells = [c for name in columns for c in (col(name).isNull(), comparable_cell(df, name))]
    return df.select("*", F.xxhash64(*cells).alias("__h1"), F.xxhash64(F.lit(1), *cells).alias("__h2"))


def _bucket(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("__h1"), 64 - bits)


def _digests(hashed: DataFrame, bits: int) -> DataFrame:
    low, high = F.lit(0xFFFFFFFF), 32
    halves = [F.col(h).bitwiseAND(low) if part == "low" else F.shiftrightunsigned(F.col(h), high) for h in ("__h1", "__h2") for part in ("low", "high")]
    return hashed.groupBy(_bucket(bits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(name) for h, name in zip(halves, SUMS)]
    )


def table_digests(df: DataFrame, columns: str | Sequence[str] | None = None) -> DataFrame:
    """(bucket, n, sums) of the first level, 2 ** BITS rows at most; to be stored and given to ``checksum_compare`` later.

    The columns must be those that are compared, in any order (they are sorted by name).
    """
    return _digests(_hashes(df, sorted(as_list(columns) if columns else df.columns)), BITS)


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Buckets whose digests differ, with the rows both sides have there."""
    names = ["n", *SUMS]
    left = a.select("bucket", *[F.col(n).alias(f"a_{n}") for n in names])
    right = b.select("bucket", *[F.col(n).alias(f"b_{n}") for n in names])
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"a_{n}").eqNullSafe(F.col(f"b_{n}"))
    return left.join(right, "bucket", "full").filter(~same).select("bucket", (zero_if_null(F.col("a_n")) + zero_if_null(F.col("b_n"))).alias("n"))


def _inside(hashed: DataFrame, bits: int, buckets: DataFrame) -> DataFrame:
    """Rows of the given buckets. There are 2 ** WIDEST of them at most."""
    return hashed.withColumn("bucket", _bucket(bits)).join(F.broadcast(buckets.select("bucket")), "bucket", "left_semi").drop("bucket")


def checksum_compare(
    main: DataFrame,
    current: DataFrame,
    model: str,
    schemas: tuple[str, str] = ("main", "current"),
    multiset: bool = False,
    main_digests: DataFrame | None = None,
    current_digests: DataFrame | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The result of ``row_compare``: row counts and whole-row differences both ways over the common columns of equal type.

    Two tables with equal digests are taken as equal: of rows that differ, two 64-bit hashes would have to agree in
    all sums of a bucket. Digests of a side that have been stored (``table_digests``) save its scan unless something differs. Buckets
    are divided as long as they hold more than ``bucket_rows`` rows and few enough differ to make it worthwhile. Jobs run before
    the result is returned; cells must be hashable (no maps).
    """
    columns = sorted(same_type_columns(main, current))
    sides = [_hashes(df.select(*[col(c) for c in columns]), columns) for df in (main, current)]
    given = (main_digests, current_digests)
    digests = [g if g is not None else stored(_digests(s, BITS), "row-digests") for g, s in zip(given, sides)]
    n_main, n_current = (F.lit(d.agg(total(F.col("n"))).first()[0]) for d in digests)
    bits, differing = BITS, stored(_differing(*digests), "differing-buckets")
    while True:
        found, rows = differing.agg(F.count(F.lit(1)), total(F.col("n"))).first()
        finer = min(WIDEST - max(found - 1, 0).bit_length(), LAST - bits)
        if rows <= found * bucket_rows or finer <= 2:  # dividing by less than 8 would cost more than it saves
            break
        sides_inside = [_inside(s, bits, differing) for s in sides]
        bits += finer
        differing = stored(_differing(*[_digests(s, bits) for s in sides_inside]), "differing-buckets")
    if found:
        sides = [_inside(s, bits, differing) for s in sides]
        rest = row_compare(*[s.select(*[col(c) for c in columns]) for s in sides], model, schemas, multiset)
    else:
        none = F.lit(0).cast("bigint")
        rest = differing.agg(
            F.lit(model).alias("model_name"), F.lit(schemas[0]).alias("main_schema"), F.lit(schemas[1]).alias("current_schema"),
            none.alias("rows_in_main_not_current"), none.alias("rows_in_current_not_main"),
        )
    return rest.select(
        "model_name",
        "main_schema",
        "current_schema",
        n_main.cast("bigint").alias("main_row_count"),
        n_current.cast("bigint").alias("current_row_count"),
        "rows_in_main_not_current",
        "rows_in_current_not_main",
    )
