"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.columns import col
from plumbline.plans.fixtures import frame, oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Tables and derived inputs of one scale folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name, self._known)


def comparable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, since sums of doubles depend on their order."""
    return df.select(
        *[
            F.round(col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None, rounded: bool = True):
    """Register ``fn(inputs) -> DataFrame`` under a name, with its check."""

    def register(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = fn(Inputs(spark, sf_dir))
            return comparable(found) if rounded else found

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register
