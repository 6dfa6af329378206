"""What catalogs and file footers know: row counts, NULL counts, ranges and inventories without reading rows.

Parquet keeps counts and bounds of every column in its footers. Spark answers aggregates from these if they are pushed down into
its second generation of file readers, in tasks of their own, so many files are read in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.columns import col, in_rows, percent

_SETTINGS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}
LACKING = "No min/max found"  # how Spark says that a footer has no bounds
STATISTICS = "table_name string, column_name string, data_type string, ordinal long, row_count long, null_count long, min_value string, max_value string"


@contextmanager
def _footers(spark: SparkSession) -> Iterator[None]:
    """Aggregates over whole Parquet tables that are planned in here are answered from footers."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _has_bounds(dtype: T.DataType) -> bool:
    """Types whose bounds footers hold whole and Spark takes from there."""
    return isinstance(dtype, (T.IntegralType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType))


def _aggregated(df: DataFrame, bounds: bool = True) -> DataFrame:
    found = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema.fields):
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            found.append(F.count(col(f.name)).alias(f"f{i}"))
        if bounds and _has_bounds(f.dataType):
            found += [F.min(col(f.name)).alias(f"l{i}"), F.max(col(f.name)).alias(f"m{i}")]
    return df.agg(*found)


def _rows(df: DataFrame, table: str) -> DataFrame:
    wide = _aggregated(df)
    nothing = F.lit(None).cast("string")
    rows = []
    for i, f in enumerate(df.schema.fields):
        known = f"f{i}" in wide.columns
        nulls = F.col("n") - F.col(f"f{i}") if known else F.lit(None).cast("bigint")
        bounds = [F.col(f"{x}{i}").cast("string") if f"{x}{i}" in wide.columns else nothing for x in "lm"]
        described = [F.lit(table), F.lit(f.name), F.lit(f.dataType.simpleString()), F.lit(i + 1).cast("bigint")]
        rows.append([*described, F.col("n"), nulls, *bounds])
    return in_rows(wide, rows, ("table_name", "column_name", "data_type", "ordinal", "row_count", "null_count", "min_value", "max_value"))


def footer_statistics(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Rows, NULLs and bounds (as text) of every column of some Parquet tables, given by path.

    Bounds are NULL for texts, timestamps and decimals, which footers may cut short or order otherwise; counts of nested columns are NULL, too. One
    job a table reads footers only and runs before the result (a row per column) is returned. A table is scanned
    instead where a footer lacks a bound: in a part whose cells are all NULL, or hold NaN.
    """
    found = []
    for name, path in tables.items():
        try:
            with _footers(spark):
                found += _rows(spark.read.parquet(path), name).collect()
        except Py4JJavaError as error:
            if LACKING not in str(error):
                raise
            found += _rows(spark.read.parquet(path), name).collect()
    return spark.createDataFrame(found, STATISTICS)


def footer_row_counts(spark: SparkSession, a: str, b: str, labels: tuple[str, str] = ("a", "b")) -> DataFrame:
    """The result of ``ab_row_count`` of two Parquet tables, without reading a row."""
    with _footers(spark):
        counts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")) for p in (a, b)]
        n_a, n_b = (r["n"] for r in counts[0].withColumn("i", F.lit(0)).union(counts[1].withColumn("i", F.lit(1))).orderBy("i").collect())
    one = spark.createDataFrame([(*labels, n_a, n_b)], "model_a string, model_b string, model_a_rows long, model_b_rows long")
    gap = F.col("model_b_rows") - F.col("model_a_rows")
    return one.select("*", gap.alias("row_diff"), percent(gap, F.col("model_a_rows"), 2).alias("pct_diff"))


def footer_catalog(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """The result of ``column_catalog`` measured, but for the length of texts, which footers don't tell (NULL)."""
    return footer_statistics(spark, tables).select(
        F.col("table_name").alias("model_name"),
        "column_name",
        "data_type",
        F.lit(None).cast("bigint").alias("char_len"),
        (F.col("null_count") > 0).alias("is_nullable"),
        "ordinal",
    )


def catalog_inventory(spark: SparkSession, schemas: Sequence[str] | None = None) -> DataFrame:
    """Relations that the session's catalog knows: ``schema_name, ref_name, ref_type``, as ``vestigial_relations`` takes them."""
    found = []
    for name in schemas if schemas is not None else [d.name for d in spark.catalog.listDatabases()]:
        for t in spark.catalog.listTables(name):
            if not t.isTemporary:
                found.append((name, t.name, "view" if t.tableType == "VIEW" else "table"))
    return spark.createDataFrame(found, "schema_name string, ref_name string, ref_type string")
