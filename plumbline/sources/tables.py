"""Readers and writers of Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def append_history(snapshot: DataFrame, path: str) -> None:
    """Append snapshot or audit rows to a history table."""
    snapshot.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh. ``df`` must not read ``path`` itself."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A result as CSV with a header."""
    df.write.mode("overwrite").option("header", "true").csv(path)
