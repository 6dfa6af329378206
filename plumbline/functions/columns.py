"""Column naming, type families, safe ratios and text rendering."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC, STRING, DATE, BOOLEAN, OTHER = "numeric", "string", "date", "boolean", "other"

LONG_TEXT = 64  # longer texts are compared by their beginning and SHA-256
DIGEST_MARK = "sha256:"


def col(name: str) -> Column:
    """Reference a column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def family(dtype: T.DataType) -> str:
    """The type family an operator dispatches on."""
    if isinstance(dtype, T.NumericType):
        return NUMERIC
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return STRING
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    if isinstance(dtype, T.BooleanType):
        return BOOLEAN
    return OTHER


def holds_map(dtype: T.DataType) -> bool:
    return "map<" in dtype.simpleString()


def without_maps(value: Column, dtype: T.DataType) -> Column:
    """The value with every map in it, however deep, as its entries in order of their keys, so that it can be compared and grouped."""
    if not holds_map(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: without_maps(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [without_maps(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    entry = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
    return F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(*[without_maps(e[f.name], f.dataType).alias(f.name) for f in entry.fields])))


def columns_of(df: DataFrame, *families: str) -> list[str]:
    return [f.name for f in df.schema.fields if family(f.dataType) in families]


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def compact(value: Column) -> Column:
    """A text that equals another exactly if the originals do, short enough to shuffle.

    A long text becomes its beginning, a mark and its SHA-256. Two of these sort like their originals
    unless both are long and begin alike. The result is longer than any text left as it is, so the two kinds
    never meet.
    """
    digest = F.concat(F.substring(value, 1, LONG_TEXT), F.lit(DIGEST_MARK), F.sha2(value, 256))
    return F.when(F.length(value) > LONG_TEXT, digest).otherwise(value)


def is_digest(text: Column) -> Column:
    return F.length(text) > LONG_TEXT


def comparable_cell(df: DataFrame, name: str) -> Column:
    """A column for equality only: long texts are shortened, everything else stays."""
    return compact(col(name)) if isinstance(dtype_of(df, name), T.StringType) else col(name)


def any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col(n).isNull() for n in names])


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL for a zero whole."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    value = part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def number_text(value: Column, digits: int = 4) -> Column:
    """A double as plain decimal text with a fixed number of digits."""
    return F.round(value.cast("double"), digits).cast(f"decimal(38,{digits})").cast("string")


def name_column(names: Sequence[str], index: Column) -> Column:
    """The name at a zero-based position of a list known to the driver."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), index + 1)


def in_rows(df: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn each input row into ``len(rows)`` output rows (wide to long)."""
    return df.select(F.stack(F.lit(len(rows)), *[c for row in rows for c in row]).alias(*names))
