"""Streaming ingest of file drops and streaming merge by key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions.columns import as_list
from plumbline.sources.drops import (
    LEAVE,
    drop_name,
    file_type,
    headings,
    lacking,
    normalize_loa,
    normalize_time_off,
    read_drops,
    read_widened,
)
from plumbline.sources.snapshots import FOLD, merge_batch, snapshot, stream_source

FILES = "path string, modificationTime timestamp, length bigint, content binary"  # fixed by Spark
BATCH = "batch_id"
REFUSED = "_refused"  # readers of the table pass over folders that begin so
MAX_FILES = 10_000  # files of a micro-batch, whose names the driver holds


def drop_stream(spark: SparkSession, drops: str) -> DataFrame:
    """Files below a folder as a stream, each once: ``path, file_type``; their content is not read."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", MAX_FILES).load(drops).select("path", file_type(drop_name()).alias("file_type"))


def ingest_stream(
    spark: SparkSession,
    drops: str,
    kind: str,
    table: str,
    checkpoint: str,
    mapping: Mapping[str, str] | None = None,
    now: object = None,
) -> StreamingQuery:
    """Append all new drops of one kind, read by heading and normalised; ends when none is left.

    The stream carries file names, MAX_FILES a micro-batch at most, however many wait. Every micro-batch reads its files as :func:`read_drops` does and
    becomes one partition of ``table``, which a repeated batch overwrites, so a restarted
    query appends each file exactly once. A file that lacks a required column is refused as a whole and
    listed by :func:`refused_files`; the others go on. Read the table with :func:`ingested_table`.
    """
    normalize = normalize_loa if kind == LEAVE else normalize_time_off

    def apply(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.filter(F.col("file_type") == kind).select("path").distinct().collect()]
        if not files:
            return
        session = batch.sparkSession
        found = headings(session, files)
        refused = lacking(found, kind, mapping)
        refused.select("file_path", "lacking").write.mode("overwrite").parquet(f"{table}/{REFUSED}/{BATCH}={batch_id}")
        taken = found.join(refused.select("file_path"), "file_path", "left_anti")
        if not taken.isEmpty():
            rows = normalize(read_drops(session, files, taken).drop("file_name"), mapping, now)
            rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")

    stream = drop_stream(spark, drops).writeStream.option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).foreachBatch(apply).start()


def ingested_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows ingested so far, under the columns of all batches."""
    return read_widened(spark, table).drop(BATCH)


def refused_files(spark: SparkSession, table: str) -> DataFrame:
    """Files that were refused: ``file_path, lacking, batch_id``."""
    return spark.read.parquet(f"{table}/{REFUSED}")


def merge_stream(
    updates: DataFrame,
    table: str,
    checkpoint: str,
    keys: str | Sequence[str],
    stage: Callable[[DataFrame], DataFrame],
    order: str = "timestamp_unix",
    late: str = "drop",
    partition: Column | str | None = None,
    fold: int = FOLD,
    event_time: str | None = None,
    delay: str = "1 hour",
) -> StreamingQuery:
    """Merge a stream of updates by key into a versioned table; ends when nothing is left to read.

    Every micro-batch is staged and merged by :func:`plumbline.sources.snapshots.merge_batch`, which knows the highest
    ``order`` merged so far and the last batch of this stream from the table's version: no batch reads the history. Rows at or below
    that mark are dropped, or merged with ``late='upsert'``. With ``late='watermark'`` lateness goes by the timestamp column ``event_time`` of the
    updates: rows more than ``delay`` behind the latest of earlier batches are dropped by Spark's watermark, which its checkpoint keeps,
    rows repeated within it (same keys and order) are dropped by its state store, which holds no more than ``delay`` of
    keys, and all others are merged. A repeated batch changes nothing. Read the table with :func:`merged_table`.
    """
    if late not in ("drop", "upsert", "watermark"):
        raise ValueError("late is 'drop', 'upsert' or 'watermark'")
    if (late == "watermark") != (event_time is not None):
        raise ValueError("late='watermark' and event_time go together")
    if event_time is not None:
        updates = updates.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([*as_list(keys), order])

    def apply(batch: DataFrame, batch_id: int) -> None:
        source = stream_source(batch, checkpoint)
        merge_batch(stage(batch), table, keys, order, partition, "drop" if late == "drop" else "upsert", source, batch_id, fold)

    return updates.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()


def merged_table(spark: SparkSession, table: str) -> DataFrame:
    """The latest row per key over all merged batches."""
    return snapshot(spark, table)
