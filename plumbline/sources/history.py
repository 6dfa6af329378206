"""Histories of dimensions kept by increments: a load closes what it replaces and opens what it brings.

The history is a versioned table (:mod:`plumbline.sources.snapshots`). The open row of each key stands in partitions dealt by
key, the closed ones in partitions by the month they began. A load reads the open rows only, and the rows that it closes and opens
are published as one version: readers see none or all of them, and what was closed earlier is neither read nor written,
but for months that gain rows and are folded now and then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plumbline.functions.columns import any_null, as_list, col
from plumbline.sources.snapshots import BUCKETS, FOLD, current_version, high_water_mark, merge_batch, snapshot

SLOT, CHANGED = "_slot", "_changed_at"  # when a closed row began, END for the open one; the load that wrote the row
END = "9999-12-31"
OPEN, CLOSED = "open-", "closed-"
VALIDITY = ("valid_from", "valid_to", "is_current")


def extend_history(
    loads: DataFrame,
    table: str,
    keys: str | Sequence[str],
    loaded_at: str = "loaded_at",
    changes_only: bool = False,
    source: str = "batch",
    batch_id: int | None = None,
    fold: int = FOLD,
) -> int:
    """Add the rows of one or several loads to the history below ``table``; the number of the version that holds them.

    A row is valid from its own ``loaded_at`` (date or timestamp) to that of the next row of its key. Of rows of a key and a moment, the one with the
    greatest other columns stays. With ``changes_only`` a row that repeats the one before it in all other columns is left out.
    Rows with a NULL key follow no other and stay open. Rows without a time, and those at or below the high-water mark of earlier loads, are left out, so a repeated load
    changes nothing; a ``batch_id`` not above the last one of its ``source`` changes nothing either. Columns named like the three of validity are replaced.
    """
    spark, keys = loads.sparkSession, as_list(keys)
    kind = loads.schema[loaded_at].dataType
    given = loads.drop(*VALIDITY)
    rest = [c for c in given.columns if c not in keys and c != loaded_at]
    fresh = given.filter(col(loaded_at).isNotNull()).withColumn("__held", F.lit(False))
    mark = high_water_mark(spark, table)
    if mark is not None:
        fresh = fresh.filter(col(loaded_at) > F.lit(mark).cast(kind))
    if current_version(spark, table):
        held = snapshot(spark, table, only=OPEN).drop(SLOT, CHANGED, "valid_to")
        touched = held.join(fresh.select(*[col(k) for k in keys]), keys, "left_semi")
        fresh = fresh.unionByName(touched.withColumn("__held", F.lit(True)), allowMissingColumns=True)
        rest = [c for c in fresh.columns if c not in keys and c not in (loaded_at, "__held")]
    # rows without a key follow no other; each has a number of its own
    fresh = fresh.withColumn("__own", F.when(any_null(keys), F.monotonically_increasing_id()))
    of_key = Window.partitionBy(*[col(k) for k in keys], "__own").orderBy(col(loaded_at), *[col(c) for c in rest])
    if changes_only:
        said = F.struct(*[col(c) for c in rest], F.lit(0).alias("__one"))
        fresh = fresh.withColumn("__before", F.lag(said).over(of_key)).filter(~said.eqNullSafe(F.col("__before"))).drop("__before")
    dated = fresh.withColumn("valid_to", F.lead(col(loaded_at)).over(of_key))
    is_open = F.col("valid_to").isNull()
    dated = dated.filter((is_open & ~F.col("__held")) | (F.col("valid_to") > col(loaded_at))).drop("__held", "__own")
    end = F.lit(END).cast(kind)
    rows = dated.withColumns({SLOT: F.when(is_open, end).otherwise(col(loaded_at)), CHANGED: F.coalesce("valid_to", col(loaded_at))})
    bucket = F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(BUCKETS)).cast("string")
    part = F.when(F.col(SLOT) == end, F.concat(F.lit(OPEN), bucket)).otherwise(
        F.concat(F.lit(CLOSED), F.date_format(F.col(SLOT).cast("timestamp_ntz"), "yyyy-MM"))
    )
    return merge_batch(rows, table, [*keys, SLOT], CHANGED, part, "upsert", source, batch_id, fold)


def read_history(
    spark: SparkSession, table: str, loaded_at: str = "loaded_at", at: object = None, version: int | None = None, current: bool = False
) -> DataFrame:
    """All rows with ``valid_from, valid_to, is_current``; those valid ``at`` a moment; or, ``current``, the open ones, of which alone files are read."""
    rows = snapshot(spark, table, version, OPEN if current else None).drop(SLOT, CHANGED)
    rows = rows.withColumns({"valid_from": col(loaded_at), "is_current": F.col("valid_to").isNull()})
    if at is None:
        return rows
    moment = F.lit(at).cast(rows.schema[loaded_at].dataType)
    return rows.filter((F.col("valid_from") <= moment) & (F.col("is_current") | (F.col("valid_to") > moment)))
