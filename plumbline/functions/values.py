"""Value ledgers: (column, value, count) for many columns in one shuffle.

Distinct counts, null counts, most frequent values and repeated values of any number of
columns are all read off one ledger. Values travel in their native width (integers, dates
and booleans as bigint, floats as double, the rest as text, long texts as SHA-256) and are
counted inside the map tasks first, so neither a frequent value nor a wide table
concentrates rows in one task. Digests only count: long texts that a report ranks or shows are read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from plumbline.functions.columns import LONG_TEXT, col, compact, dtype_of, is_digest, name_column

COLUMN = "__column"
V_INT, V_FLOAT, V_TEXT = "__v_int", "__v_float", "__v_text"
VALUE = [V_INT, V_FLOAT, V_TEXT]
COUNT = "__count"


def _whole_text(name: str, dtype: T.DataType) -> Column:
    value = col(name)
    if isinstance(dtype, T.BinaryType):
        return F.base64(value)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return value.cast("string")


def _native(name: str, dtype: T.DataType) -> tuple[Column, Column, Column]:
    value = col(name)
    no_int, no_float, no_text = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return value.cast("bigint"), no_float, no_text
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("bigint"), no_float, no_text
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value), no_float, no_text
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return no_int, value.cast("double"), no_text
    return no_int, no_float, compact(_whole_text(name, dtype))


def value_rows(df: DataFrame, columns: Sequence[str], *carried: Column) -> DataFrame:
    """One row per input row and column: carried columns, column position, typed value."""
    cells = []
    for position, name in enumerate(columns):
        cells += [F.lit(position), *_native(name, dtype_of(df, name))]
    return df.select(*carried, F.stack(F.lit(len(columns)), *cells).alias(COLUMN, *VALUE))


def shown_value(df: DataFrame, columns: Sequence[str]) -> Column:
    """A ledger value as text, in the form its column's type has as text."""
    shown = F.coalesce(F.col(V_TEXT), F.col(V_INT).cast("string"), F.col(V_FLOAT).cast("string"))
    for position, name in enumerate(columns):
        dtype = dtype_of(df, name)
        if isinstance(dtype, T.BooleanType):
            text = (F.col(V_INT) == 1).cast("string")
        elif isinstance(dtype, T.DateType):
            text = F.date_from_unix_date(F.col(V_INT).cast("int")).cast("string")
        elif isinstance(dtype, T.TimestampType):
            text = F.timestamp_micros(F.col(V_INT)).cast("string")
        else:
            continue
        shown = F.when(F.col(COLUMN) == position, text).otherwise(shown)
    return shown


def has_value() -> Column:
    return F.coalesce(F.col(V_INT).isNotNull(), F.lit(False)) | F.col(V_FLOAT).isNotNull() | F.col(V_TEXT).isNotNull()


def value_ledger(df: DataFrame, columns: Sequence[str], *carried: Column, nulls: bool = True) -> DataFrame:
    """Count of every value (NULL as one value) per column and carried columns."""
    rows = value_rows(df, columns, *carried)
    if not nulls:
        rows = rows.filter(has_value())
    keys = [c for c in rows.columns]
    return rows.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias(COUNT))


def ledger_totals(ledger: DataFrame, *by: str) -> DataFrame:
    """Rows, non-null rows and distinct non-null values per column (and ``by``)."""
    return ledger.groupBy(*by, COLUMN).agg(
        F.sum(COUNT).alias("rows"),
        F.coalesce(F.sum(F.when(has_value(), F.col(COUNT))), F.lit(0).cast("bigint")).alias("non_null"),
        # reading the count keeps this branch equal to others over the same ledger, which then share its shuffle
        F.count_if(has_value() & (F.col(COUNT) > 0)).alias("distinct"),
    )


def restore_texts(df: DataFrame, columns: Sequence[str], shown: DataFrame) -> DataFrame:
    """Put the original texts back into a few ledger rows.

    ``shown`` holds a fixed number of rows per column, which is why it may be broadcast; if
    none is a digest, adaptive execution drops the extra pass over the table.
    """
    texts = [c for c in columns if not isinstance(dtype_of(df, c), (T.NumericType, T.BooleanType, T.DateType))]
    if not texts:
        return shown
    wanted = shown.filter(is_digest(F.col(V_TEXT))).select(F.col(COLUMN).alias("__c"), F.col(V_TEXT).alias("__t"))
    cells = [c for name in texts for c in (F.lit(list(columns).index(name)), _whole_text(name, dtype_of(df, name)))]
    rows = df.select(F.stack(F.lit(len(texts)), *cells).alias("__c", "__whole"))
    rows = rows.filter(F.length("__whole") > F.lit(0)).withColumn("__t", compact(F.col("__whole")))
    found = (
        rows.filter(is_digest(F.col("__t")))
        .join(F.broadcast(wanted), ["__c", "__t"], "left_semi")
        .groupBy("__c", "__t")
        .agg(F.any_value("__whole").alias("__whole"))
    )
    matches = (F.col(COLUMN) == F.col("__c")) & (F.col(V_TEXT) == F.col("__t"))
    return shown.join(found, matches, "left").select(
        *[
            F.coalesce("__whole", V_TEXT).alias(V_TEXT) if c == V_TEXT else F.col(c)
            for c in shown.columns
        ]
    )


def most_frequent(df: DataFrame, columns: Sequence[str], ledger: DataFrame, k: int, *carried: Column) -> DataFrame:
    """The k most frequent texts per column and carried columns, ties by the text itself: whole text, count, ``__rank``.

    ``ledger`` is a text ledger without NULLs of ``df`` with the same ``carried``. Its order is right but for long
    texts that begin alike, so the long texts that begin as one of the first k are read again and
    ranked by their whole. Ranking filters run inside every task before the shuffle (window group limit).
    """
    by = [c for c in ledger.columns if c not in (COLUMN, *VALUE, COUNT)]

    def first(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(*by, COLUMN).orderBy(F.col(COUNT).desc(), F.col(V_TEXT))
        return rows.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= k)

    kept = [*by, COLUMN, V_TEXT, COUNT]
    best = first(ledger.select(*kept))
    beginning = F.substring(V_TEXT, 1, LONG_TEXT)
    # at most k rows per column and group
    wanted = best.filter(is_digest(F.col(V_TEXT))).select(*by, COLUMN, beginning.alias("__beginning"))
    wanted = wanted.distinct().withColumnsRenamed({c: f"__w{c}" for c in (*by, COLUMN)})
    same = [F.col(c).eqNullSafe(F.col(f"__w{c}")) for c in (*by, COLUMN)] + [beginning == F.col("__beginning")]
    cells = [c for i, name in enumerate(columns) for c in (F.lit(i), _whole_text(name, dtype_of(df, name)))]
    texts = df.select(*carried, F.stack(F.lit(len(columns)), *cells).alias(COLUMN, V_TEXT)).filter(is_digest(F.col(V_TEXT)))
    long = (
        texts.join(F.broadcast(wanted) if not by else wanted, same, "left_semi")
        .groupBy(*by, COLUMN, compact(F.col(V_TEXT)).alias("__digest"))
        .agg(F.any_value(V_TEXT).alias(V_TEXT), F.count(F.lit(1)).alias(COUNT))
    )
    return first(best.filter(~is_digest(F.col(V_TEXT))).select(*kept).unionByName(long.select(*kept)))


def frequent_texts(df: DataFrame, columns: Sequence[str], ledger: DataFrame, k: int) -> DataFrame:
    """``value (count)`` of the k most frequent texts per column of a text ledger without NULLs."""
    best = most_frequent(df, columns, ledger, k)
    shown = F.concat(F.col(V_TEXT), F.lit(" ("), F.col(COUNT).cast("string"), F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct("__rank", shown.alias("shown"))))
    return best.groupBy(COLUMN).agg(F.array_join(F.transform(ordered, lambda e: e["shown"]), ", ").alias("top"))


def named(ledger_like: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the column position by the column name."""
    return ledger_like.withColumn("column_name", name_column(columns, F.col(COLUMN))).drop(COLUMN)
