"""Drift of column statistics between a recent and an earlier time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions import values as V
from plumbline.functions.columns import NUMERIC, STRING, col, columns_of, in_rows, number_text, percent, zero_if_null

# Severities with the percentage each must exceed, and the units of a window.
SEVERITIES = {"High": 50, "Medium": 20, "Low": 5}
NORMAL = "Normal"
UNITS = ["hour", "day", "week", "month", "quarter", "year"]


def window_interval(text: str) -> Column:
    """``'10 day'`` or ``'1 month'`` as an interval."""
    number, _, unit = text.strip().partition(" ")
    unit = unit.strip().lower().removesuffix("s")
    if unit not in UNITS:
        raise ValueError(f"window unit is one of {UNITS}")
    count = F.lit(int(number))
    if unit in ("month", "quarter", "year"):
        return F.make_ym_interval(F.lit(0), count * {"month": 1, "quarter": 3, "year": 12}[unit])
    if unit == "hour":
        return F.make_dt_interval(F.lit(0), count)
    return F.make_dt_interval(count * (7 if unit == "week" else 1))


def severity(pct_change: Column) -> Column:
    graded = F.lit(NORMAL)
    for name, above in reversed(SEVERITIES.items()):
        graded = F.when(pct_change > above, name).otherwise(graded)
    return graded


def detect_drift(
    df: DataFrame,
    time_column: str,
    time_window: str = "1 month",
    compare_window: str = "1 month",
    as_of: object = None,
    columns: Sequence[str] | None = None,
    abs_baseline: bool = False,
    only_drifted: bool = True,
) -> DataFrame:
    """Statistics of the window before ``as_of`` against the window before that one.

    Numeric columns compare average, standard deviation and null rate; text columns distinct
    count, null rate and most frequent value. Both windows are told apart inside one
    aggregation; a negative baseline grades Normal unless ``abs_baseline`` is set.
    """
    chosen = [c for c in (columns or df.columns) if c != time_column]
    numbers = [c for c in columns_of(df, NUMERIC) if c in chosen]
    texts = [c for c in columns_of(df, STRING) if c in chosen]
    end = (F.current_date() if as_of is None else F.lit(as_of)).cast("date").cast("timestamp_ntz")
    split = end - window_interval(time_window)
    start = end - window_interval(compare_window) - window_interval(time_window)
    when = col(time_column).cast("timestamp_ntz")
    recent = F.coalesce(when >= split, F.lit(False))
    inside = df.filter(when >= start).withColumn("__recent", recent)
    is_recent = F.col("__recent")
    sides = {"r": is_recent, "c": ~is_recent}

    aggregates = [F.count_if(side).alias(f"{s}_rows") for s, side in sides.items()]
    for i, c in enumerate([*numbers, *texts]):
        for s, side in sides.items():
            value = F.when(side, col(c))
            aggregates.append(F.count(value).alias(f"{s}_count{i}"))
            if c in numbers:
                aggregates += [F.avg(value).alias(f"{s}_avg{i}"), F.stddev_samp(value).alias(f"{s}_stddev{i}")]
    wide = inside.agg(*aggregates)
    if texts:
        ledger = V.value_ledger(inside, texts, is_recent.alias("__recent"), nulls=False)
        distincts = ledger.groupBy("__recent", V.COLUMN).agg(F.count(F.lit(1)).alias("distinct"))
        tops = V.most_frequent(inside, texts, ledger, 1, is_recent).drop(V.COUNT, "__rank")
        per_window = distincts.join(tops, ["__recent", V.COLUMN])
        cells = []
        for i in range(len(texts)):
            for s, side in sides.items():
                here = side & (F.col(V.COLUMN) == i)
                cells.append(zero_if_null(F.max(F.when(here, F.col("distinct")))).alias(f"{s}_distinct{i}"))
                cells.append(F.max(F.when(here, F.col(V.V_TEXT))).alias(f"{s}_top{i}"))
        wide = wide.withColumn("texts", per_window.agg(F.struct(*cells).alias("texts")).scalar())

    def relative(new: Column, base: Column) -> Column:
        return F.round(
            F.abs(new - base).cast("double")
            / F.nullif((F.abs(base) if abs_baseline else base).cast("double"), F.lit(0.0))
            * F.lit(100.0),
            2,
        )

    rows = []
    for i, c in enumerate([*numbers, *texts]):
        kind = "numeric" if c in numbers else "categorical"
        if c in numbers:
            for metric in ("avg", "stddev"):
                new, base = F.col(f"r_{metric}{i}"), F.col(f"c_{metric}{i}")
                rows.append([c, kind, metric, number_text(new, 2), number_text(base, 2), relative(new, base)])
        else:
            t = i - len(numbers)
            new, base = F.col(f"texts.r_distinct{t}"), F.col(f"texts.c_distinct{t}")
            rows.append(
                [c, kind, "distinct_count", new.cast("string"), base.cast("string"), relative(new, base)]
            )
            new, base = F.col(f"texts.r_top{t}"), F.col(f"texts.c_top{t}")
            changed = F.when(new == base, F.lit(0.0)).otherwise(F.lit(100.0))
            rows.append([c, kind, "top_category_change", new, base, changed])
        new = percent(F.col("r_rows") - F.col(f"r_count{i}"), F.col("r_rows"))
        base = percent(F.col("c_rows") - F.col(f"c_count{i}"), F.col("c_rows"))
        rows.append([c, kind, "null_rate", number_text(new, 2), number_text(base, 2), F.abs(new - base)])
    cells = [[*[F.lit(v) for v in row[:3]], *row[3:]] for row in rows]
    names = ("column_name", "data_type", "metric", "recent_value", "comparison_value", "pct_change")
    result = in_rows(wide, cells, names).withColumn("drift_severity", severity(F.col("pct_change")))
    if only_drifted:
        result = result.filter(F.col("drift_severity") != NORMAL)
    grade = F.array_position(F.array(*[F.lit(s) for s in [*SEVERITIES, NORMAL]]), F.col("drift_severity"))
    return result.orderBy(grade, F.col("pct_change").desc(), "column_name", "metric")
