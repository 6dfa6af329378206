"""Profiles, summaries, distributions and duplicate reports of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions import values as V
from plumbline.functions.columns import (
    BOOLEAN,
    DATE,
    NUMERIC,
    OTHER,
    STRING,
    as_list,
    col,
    columns_of,
    dtype_of,
    family,
    in_rows,
    number_text,
    percent,
    zero_if_null,
)
from plumbline.functions.percentiles import exact_percentiles
from plumbline.operators.samples import exact_sample
from plumbline.session import stored

# Declared type names per family, percentile metrics, date label formats.
DECLARED = {
    NUMERIC: ["numeric", "int", "integer", "float", "decimal", "number"],
    STRING: ["string", "varchar", "text", "char"],
    DATE: ["date", "timestamp", "datetime"],
}
PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
DATE_LABELS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "quarter": "yyyy-q", "year": "yyyy"}


# ---------------------------------------------------------------- dataset profile


def _plain_aggregates(df: DataFrame, position: int, name: str, approx: bool) -> list[Column]:
    value, kind = col(name), family(dtype_of(df, name))

    def out(metric: str) -> str:
        return f"{metric}{position}"

    found = [F.count(value).alias(out("count"))]
    if kind == NUMERIC:
        found += [
            F.min(value).alias(out("min")),
            F.max(value).alias(out("max")),
            F.avg(value).alias(out("avg")),
            F.stddev_samp(value).alias(out("stddev")),
        ]
    elif kind == STRING:
        found += [
            F.min(F.length(value)).alias(out("min_length")),
            F.max(F.length(value)).alias(out("max_length")),
            F.avg(F.length(value)).alias(out("avg_length")),
        ]
    elif kind == DATE:
        found += [F.min(value).alias(out("min_date")), F.max(value).alias(out("max_date"))]
    elif kind == BOOLEAN:
        found += [F.count_if(value).alias(out("true")), F.count_if(~value).alias(out("false"))]
    if approx and kind in (NUMERIC, STRING, DATE):
        found.append(F.approx_count_distinct(value).alias(out("distinct")))
    if approx and kind == NUMERIC:
        found.append(F.percentile_approx(value.cast("double"), list(PERCENTILES.values())).alias(out("cuts")))
    return found


def _plain_metrics(df: DataFrame, position: int, name: str, approx: bool) -> list[tuple[str, Column]]:
    dtype = dtype_of(df, name)
    kind = family(dtype)

    def got(metric: str) -> Column:
        return F.col(f"{metric}{position}")

    def text(value: Column) -> Column:
        return value.cast("string")

    count, rows = got("count"), F.col("rows")
    metrics = [
        ("count", text(count)),
        ("null_count", text(rows - count)),
        ("null_pct", number_text(percent(rows - count, rows, 2), 2)),
    ]
    if kind == NUMERIC:
        exact = text if isinstance(dtype, (T.IntegralType, T.DecimalType)) else number_text
        metrics += [("min", exact(got("min"))), ("max", exact(got("max")))]
        metrics += [("avg", number_text(got("avg"))), ("stddev", number_text(got("stddev")))]
    elif kind == STRING:
        metrics += [("min_length", text(got("min_length"))), ("max_length", text(got("max_length")))]
        metrics += [("avg_length", number_text(got("avg_length")))]
    elif kind == DATE:
        low, high = got("min_date"), got("max_date")
        metrics += [("min_date", text(low)), ("max_date", text(high))]
        metrics += [("date_range_days", text(F.datediff(high, low)))]
    elif kind == BOOLEAN:
        for word in ("true", "false"):
            metrics += [(f"{word}_count", text(got(word)))]
            metrics += [(f"{word}_pct", number_text(percent(got(word), count, 2), 2))]
    if approx and kind in (NUMERIC, STRING, DATE):
        metrics.append(("distinct_values", text(got("distinct"))))
    if approx and kind == NUMERIC:
        metrics += [(m, number_text(got("cuts")[i])) for i, m in enumerate(PERCENTILES)]
    return metrics


_LONG = ("data_type", "column_name", "metric", "metric_value")


def profile_dataset(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    sample_size: int | None = None,
    sample_by: str | Sequence[str] | None = None,
    approx: bool = False,
    top: int = 5,
) -> DataFrame:
    """Long profile ``(data_type, column_name, metric, metric_value)`` of every column.

    One scan answers all plain metrics of all columns; distinct and most frequent values
    share one value ledger; percentiles have one of their own. ``approx`` moves
    distincts and percentiles into the first scan. Columns of a nested type are reported as
    ``other`` with their counts. ``sample_size`` profiles min(sample_size, rows) rows, chosen as by ``exact_sample``.
    """
    if sample_size is not None:
        df = stored(exact_sample(df, sample_size, sample_by), "profile-sample")  # read more than once
    columns = list(columns or df.columns)
    kinds = {c: family(dtype_of(df, c)) for c in columns}

    def rows_of(metrics: list[tuple[str, str, Column]]) -> list[list[Column]]:
        return [[F.lit(kinds[c]), F.lit(c), F.lit(metric), value] for c, metric, value in metrics]

    aggregates = [a for i, c in enumerate(columns) for a in _plain_aggregates(df, i, c, approx)]
    plain = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    parts = [
        in_rows(
            plain,
            rows_of([(c, m, v) for i, c in enumerate(columns) for m, v in _plain_metrics(df, i, c, approx)]),
            _LONG,
        )
    ]
    counted = [c for c in columns if kinds[c] in (NUMERIC, STRING, DATE)]
    texts = [c for c in counted if kinds[c] == STRING]
    numbers = [c for c in columns if kinds[c] == NUMERIC]
    # Texts have a ledger of their own, which their distinct and most frequent values share.
    for held in ([c for c in counted if c not in texts], texts):
        if held and not approx:
            totals = V.ledger_totals(V.value_ledger(df, held, nulls=False)).agg(
                *[
                    zero_if_null(F.max(F.when(F.col(V.COLUMN) == i, F.col("distinct")))).alias(f"d{i}")
                    for i in range(len(held))
                ]
            )
            distinct = [(c, "distinct_values", F.col(f"d{i}").cast("string")) for i, c in enumerate(held)]
            parts.append(in_rows(totals, rows_of(distinct), _LONG))
    if texts and top:
        best = V.frequent_texts(df, texts, V.value_ledger(df, texts, nulls=False), top).agg(
            *[F.max(F.when(F.col(V.COLUMN) == i, F.col("top"))).alias(f"t{i}") for i in range(len(texts))]
        )
        shown = [(c, f"top_{top}_values", F.col(f"t{i}")) for i, c in enumerate(texts)]
        parts.append(in_rows(best, rows_of(shown), _LONG))
    if numbers and not approx:
        probs = list(PERCENTILES.values())
        ranked = exact_percentiles(df, numbers, probs)
        cells = {
            (c, m): F.max(F.when((F.col("column_name") == c) & (F.col("prob") == p), F.col("value"))).alias(f"{m}_{i}")
            for i, c in enumerate(numbers)
            for m, p in PERCENTILES.items()
        }
        wide = ranked.agg(*cells.values())
        parts.append(
            in_rows(
                wide,
                rows_of([(c, m, number_text(F.col(f"{m}_{i}"))) for i, c in enumerate(numbers) for m in PERCENTILES]),
                _LONG,
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy("data_type", "column_name", "metric")


def profile_columns(df: DataFrame, specs: Sequence[str]) -> DataFrame:
    """Profile of declared columns given as ``name:type``; one row per column, families side by side."""
    declared = []
    for spec in specs:
        name, _, kind = spec.partition(":")
        kind = kind.lower() or "unknown"
        declared.append((name, kind, next((f for f, names in DECLARED.items() if kind in names), OTHER)))
    names = [name for name, _, _ in declared]
    numbers = [n for n, _, f in declared if f == NUMERIC]
    texts = [n for n, _, f in declared if f == STRING]
    aggregates: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, (name, _, kind) in enumerate(declared):
        value = col(name)
        aggregates.append(F.count(value).alias(f"count{i}"))
        if kind == NUMERIC:
            number = value.cast("double")
            aggregates += [F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}"), F.avg(number).alias(f"c{i}")]
        elif kind == STRING:
            size = F.length(value).cast("bigint")
            aggregates += [F.min(size).alias(f"a{i}"), F.max(size).alias(f"b{i}"), F.avg(size).alias(f"c{i}")]
        elif kind == DATE:
            moment = value.cast("timestamp_ntz")
            aggregates += [F.min(moment).alias(f"a{i}"), F.max(moment).alias(f"b{i}")]
    wide = df.agg(*aggregates)
    if numbers:
        medians = exact_percentiles(df, numbers, [0.5]).agg(
            F.struct(
                *[F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(f"m{names.index(c)}") for c in numbers]
            ).alias("medians")
        )
        wide = wide.withColumn("medians", medians.scalar())
    if texts:
        distincts = V.ledger_totals(V.value_ledger(df, texts, nulls=False)).agg(
            F.struct(
                *[
                    F.max(F.when(F.col(V.COLUMN) == i, F.col("distinct"))).alias(f"d{names.index(c)}")
                    for i, c in enumerate(texts)
                ]
            ).alias("distincts")
        )
        wide = wide.withColumn("distincts", distincts.scalar())
    rows = []
    for i, (name, kind_name, kind) in enumerate(declared):

        def when_kind(wanted: str, value: str, dtype: str, kind=kind) -> Column:
            return (F.col(value) if kind == wanted else F.lit(None)).cast(dtype)

        low, high = F.col(f"a{i}"), F.col(f"b{i}")
        nulls = F.col("rows") - F.col(f"count{i}")
        range_days = F.datediff(high, low) if kind == DATE else F.lit(None)
        rows.append(
            [
                F.lit(name),
                F.lit(kind_name),
                F.col(f"count{i}"),
                nulls,
                percent(nulls, F.col("rows")),
                when_kind(NUMERIC, f"a{i}", "double"),
                when_kind(NUMERIC, f"b{i}", "double"),
                when_kind(NUMERIC, f"c{i}", "double"),
                when_kind(NUMERIC, f"medians.m{i}", "double"),
                when_kind(STRING, f"a{i}", "bigint"),
                when_kind(STRING, f"b{i}", "bigint"),
                when_kind(STRING, f"c{i}", "double"),
                zero_if_null(F.col(f"distincts.d{i}")) if kind == STRING else F.lit(None).cast("bigint"),
                when_kind(DATE, f"a{i}", "timestamp_ntz"),
                when_kind(DATE, f"b{i}", "timestamp_ntz"),
                range_days.cast("bigint"),
            ]
        )
    return in_rows(
        wide,
        rows,
        (
            "column_name",
            "data_type",
            "non_null_count",
            "null_count",
            "null_percentage",
            "min_value",
            "max_value",
            "avg_value",
            "median_value",
            "min_length",
            "max_length",
            "avg_length",
            "distinct_values",
            "min_date",
            "max_date",
            "date_range_days",
        ),
    )


# ---------------------------------------------------------------- summaries


def _with_medians(df: DataFrame, summary: DataFrame, by: list[str], columns: list[str], approx: bool) -> DataFrame:
    """Add ``__m<i>`` per column to a summary with one row per ``by`` group."""
    if not columns:
        return summary
    if approx:
        return summary
    ranked = exact_percentiles(df, columns, [0.5], by)
    cells = [
        F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(f"__m{i}") for i, c in enumerate(columns)
    ]
    if not by:
        return summary.withColumn("__m", ranked.agg(F.struct(*cells).alias("m")).scalar()).select("*", "__m.*").drop("__m")
    renamed = {b: f"__r{i}" for i, b in enumerate(by)}
    medians = ranked.groupBy(*[col(b) for b in by]).agg(*cells).withColumnsRenamed(renamed)
    same = [col(b).eqNullSafe(F.col(r)) for b, r in renamed.items()]
    return summary.join(medians, same, "left").drop(*renamed.values())


def summarize(
    df: DataFrame,
    model: str,
    group_by: str | Sequence[str] | None = None,
    numeric_columns: Sequence[str] | None = None,
    approx: bool = False,
) -> DataFrame:
    """Row count and, per numeric column, min, max, avg, median, counts and null share; per group if asked."""
    by = as_list(group_by or [])
    columns = [c for c in (numeric_columns or columns_of(df, NUMERIC)) if c not in by]
    aggregates: list[Column] = [F.count(F.lit(1)).alias("total_rows")]
    for i, c in enumerate(columns):
        value = col(c)
        aggregates += [
            F.min(value).alias(f"{c}_min"),
            F.max(value).alias(f"{c}_max"),
            F.avg(value).alias(f"{c}_avg"),
            F.count(value).alias(f"{c}_count"),
        ]
        if approx:
            aggregates.append(F.percentile_approx(value.cast("double"), 0.5).alias(f"__m{i}"))
    summary = df.groupBy(*[col(b) for b in by]).agg(*aggregates)
    summary = _with_medians(df, summary, by, columns, approx)
    shown: list[Column] = [col(b) for b in by] if by else [F.lit(model).alias("model_name")]
    shown.append(F.col("total_rows"))
    for i, c in enumerate(columns):
        nulls = F.col("total_rows") - col(f"{c}_count")
        shown += [
            col(f"{c}_min"),
            col(f"{c}_max"),
            col(f"{c}_avg"),
            F.col(f"__m{i}").alias(f"{c}_median"),
            col(f"{c}_count"),
            nulls.alias(f"{c}_null_count"),
            percent(nulls, F.col("total_rows")).alias(f"{c}_null_percentage"),
        ]
    return summary.select(*shown)


def analyze_nulls(df: DataFrame, model: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage per column, highest percentage first; one scan."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(col(c)).alias(f"count{i}") for i, c in enumerate(columns)]
    )
    rows = []
    for i, c in enumerate(columns):
        nulls = F.col("rows") - F.col(f"count{i}")
        rows.append([F.lit(model), F.col("rows"), F.lit(c), nulls, percent(nulls, F.col("rows"))])
    names = ("model_name", "total_rows", "column_name", "null_count", "null_percentage")
    return in_rows(wide, rows, names).orderBy(F.col("null_percentage").desc(), "column_name")


def aggregate_measure(
    df: DataFrame,
    group_by: str,
    measure: str,
    aggregations: Sequence[str] = ("sum", "avg", "count"),
    approx: bool = False,
) -> DataFrame:
    """Requested aggregates of one measure per group, largest sum (or group) first."""
    value = col(measure)
    available = {
        "sum": (F.sum(value), "sum_value"),
        "avg": (F.avg(value), "avg_value"),
        "min": (F.min(value), "min_value"),
        "max": (F.max(value), "max_value"),
        "stddev": (F.stddev_samp(value), "stddev_value"),
        "count_distinct": ((F.approx_count_distinct if approx else F.count_distinct)(value), "distinct_count"),
    }
    unknown = set(aggregations) - set(available) - {"count", "median"}
    if unknown:
        raise ValueError(f"unknown aggregations: {sorted(unknown)}")
    wanted = [available[a] for a in available if a in aggregations]
    grouped = df.groupBy(col(group_by)).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(value).alias("__count"),
        *[a.alias(name) for a, name in wanted],
        *([F.percentile_approx(value.cast("double"), 0.5).alias("__m0")] if approx and "median" in aggregations else []),
    )
    shown = [col(group_by), F.col("row_count"), *[F.col(name) for _, name in wanted]]
    if "median" in aggregations:
        grouped = _with_medians(df, grouped, [group_by], [measure], approx)
        shown.append(F.col("__m0").alias("median_value"))
    nulls = F.col("row_count") - F.col("__count")
    shown += [nulls.alias("null_count"), percent(nulls, F.col("row_count")).alias("null_percentage")]
    order = "sum_value" if "sum" in aggregations else "row_count"
    return grouped.select(*shown).orderBy(F.col(order).desc(), col(group_by))


# ---------------------------------------------------------------- distributions


def date_distribution(df: DataFrame, model: str, date_column: str, date_part: str = "month") -> DataFrame:
    """One row of statistics over the date buckets, then one row per bucket with its count."""
    if date_part not in DATE_LABELS:
        raise ValueError(f"date_part is one of {list(DATE_LABELS)}")
    value = col(date_column)
    bucket = F.date_trunc(date_part, value).cast("timestamp_ntz")
    buckets = (
        df.filter(value.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("records"))
    )
    shared = [F.lit(model).alias("model_name"), F.lit(date_column).alias("date_column")]
    nothing = F.lit(None)
    stats = buckets.agg(
        F.min("bucket").alias("min_date"),
        F.max("bucket").alias("max_date"),
        F.count(F.lit(1)).alias("unique_periods"),
        F.sum("records").alias("total_records"),
        F.min("records").alias("min_period_count"),
        F.max("records").alias("max_period_count"),
        F.avg("records").alias("avg_period_count"),
    ).select(*shared, F.lit(date_part).alias("date_granularity"), "*", nothing.cast("timestamp_ntz").alias("__at"))
    per_bucket = buckets.select(
        *shared,
        F.date_format("bucket", DATE_LABELS[date_part]).alias("date_granularity"),
        nothing.cast("timestamp_ntz").alias("min_date"),
        nothing.cast("timestamp_ntz").alias("max_date"),
        nothing.cast("bigint").alias("unique_periods"),
        F.col("records").alias("total_records"),
        nothing.cast("bigint").alias("min_period_count"),
        nothing.cast("bigint").alias("max_period_count"),
        nothing.cast("double").alias("avg_period_count"),
        F.col("bucket").alias("__at"),
    )
    return stats.unionByName(per_bucket).orderBy(F.col("__at").asc_nulls_first()).drop("__at")


def incremental_counts(
    df: DataFrame, model: str, date_column: str, lookback_days: int = 7, as_of: object = None
) -> DataFrame:
    """Rows dated up to the latest date minus i days, for i below ``lookback_days``, newest first.

    A table without any date gives one row dated ``as_of`` (today) with a zero count.
    """
    value = col(date_column)
    newest = df.agg(F.max(value).alias("newest")).scalar()

    def back(days: int) -> Column:
        if isinstance(dtype_of(df, date_column), T.DateType):
            return F.date_sub(newest, days)
        return newest - F.make_dt_interval(F.lit(days))

    counts = df.agg(*[F.count_if(value <= back(i)).alias(f"n{i}") for i in range(lookback_days)])
    today = F.current_date() if as_of is None else F.lit(as_of)
    rows = [
        [F.lit(i), F.when(newest.isNotNull(), back(i)).otherwise(today.cast(dtype_of(df, date_column))), F.col(f"n{i}")]
        for i in range(lookback_days)
    ]
    return (
        in_rows(counts, rows, ("i", "load_date", "record_count"))
        .filter((F.col("i") == 0) | newest.isNotNull())
        .select(F.lit(model).alias("model_name"), "load_date", "record_count")
        .orderBy(F.col("load_date").desc())
    )


# ---------------------------------------------------------------- duplicates


def duplicate_groups(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, with their count."""
    return df.groupBy(*[col(k) for k in as_list(keys)]).agg(F.count(F.lit(1)).alias("occurrence_count")).filter(
        F.col("occurrence_count") > 1
    )


def find_duplicates(df: DataFrame, model: str, keys: str | Sequence[str]) -> DataFrame:
    """Number of repeated keys, rows they cover and the largest group."""
    return duplicate_groups(df, keys).agg(
        F.lit(model).alias("model_name"),
        F.lit(", ".join(as_list(keys))).alias("key_columns"),
        F.count(F.lit(1)).alias("duplicate_key_count"),
        F.sum("occurrence_count").alias("total_duplicate_rows"),
        F.max("occurrence_count").alias("max_occurrences"),
    )


def duplicate_examples(df: DataFrame, keys: str | Sequence[str], limit: int = 10) -> DataFrame:
    """The most frequent repeated keys, ties by key."""
    keys = as_list(keys)
    shown = F.concat_ws("|", *[col(k).cast("string") for k in keys])
    return (
        duplicate_groups(df, keys)
        .orderBy(F.col("occurrence_count").desc(), *[col(k) for k in keys])
        .limit(limit)
        .select(shown.alias("key_columns"), F.col("occurrence_count").alias("duplicate_key_count"))
    )


__all__ = [
    "aggregate_measure",
    "analyze_nulls",
    "date_distribution",
    "duplicate_examples",
    "duplicate_groups",
    "find_duplicates",
    "incremental_counts",
    "profile_columns",
    "profile_dataset",
    "summarize",
]
