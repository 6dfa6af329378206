"""A stored state of sketches per day and column, merged for any window without reading rows.

A state row holds exact counts, mean and spread, and three sketches: HLL (distinct values), theta (overlap of two sets of values) and
KLL (quantiles of numbers). Rows merge in any order and number, so states of batches, days and windows have one form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions.columns import NUMERIC, col, columns_of, dtype_of, family, in_rows, number_text, percent
from plumbline.operators.drift import NORMAL, UNITS, severity, window_interval

HLL_BITS = 12  # relative standard error about 1.6 %
KLL_K = 200  # rank error about 1.7 %
BATCH = "batch"
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
STATE = (
    "day", "column_name", "data_type", "n_rows", "n_values", "mean", "spread", "min_value", "max_value", "distincts", "members", "quantiles",
)


def _cells(df: DataFrame, position: int, name: str) -> list[Column]:
    """Aggregates of one column, under names that end in its position."""
    value = col(name)
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    found = [
        F.count(value).alias(f"n{position}"),
        F.hll_sketch_agg(hashed, HLL_BITS).alias(f"h{position}"),
        F.theta_sketch_agg(hashed).alias(f"t{position}"),
    ]
    if family(dtype_of(df, name)) == NUMERIC:
        number = value.cast("double")
        found += [
            F.avg(number).alias(f"a{position}"),
            (F.var_pop(number) * F.count(value)).alias(f"s{position}"),
            F.min(number).alias(f"l{position}"),
            F.max(number).alias(f"m{position}"),
            F.kll_sketch_agg_double(number, KLL_K).alias(f"q{position}"),
        ]
    return found


def sketch_state(df: DataFrame, time_column: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One state row per day and column, in one scan; rows without a time form a day of their own (NULL).

    ``spread`` is the sum of squared distances from the mean. Columns that cannot be hashed (maps) must be left out.
    """
    columns = [c for c in (columns or df.columns) if c != time_column]
    numbers = columns_of(df, NUMERIC)
    aggregates = [a for i, c in enumerate(columns) for a in _cells(df, i, c)]
    daily = df.groupBy(col(time_column).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)
    nothing, no_sketch = F.lit(None).cast("double"), F.lit(None).cast("binary")
    rows = []
    for i, c in enumerate(columns):
        is_number = c in numbers
        figures = [F.col(f"{x}{i}") if is_number else nothing for x in "aslm"]
        sketch = F.col(f"q{i}") if is_number else no_sketch
        kind = F.lit("numeric" if is_number else "categorical")
        rows.append([F.col("day"), F.lit(c), kind, F.col("n_rows"), F.col(f"n{i}"), *figures, F.col(f"h{i}"), F.col(f"t{i}"), sketch])
    return in_rows(daily, rows, STATE)


def merged_state(state: DataFrame, *by: Column | str) -> DataFrame:
    """State rows merged per ``by`` and column. Without ``by``, one row per column with the last day."""
    whole = F.sum("n_values")
    weighted = F.sum(F.col("mean") * F.col("n_values"))
    mean = weighted / F.nullif(whole, F.lit(0))
    # squares about each part's mean, and those of the parts' means about the common one
    spread = F.sum("spread") + F.sum(F.col("n_values") * F.col("mean") * F.col("mean")) - weighted * mean
    day = [] if "day" in [b for b in by if isinstance(b, str)] else [F.max("day").alias("day")]
    found = state.groupBy(*by, "column_name", "data_type").agg(
        *day,
        F.sum("n_rows").alias("n_rows"),
        whole.alias("n_values"),
        mean.alias("mean"),
        F.greatest(spread, F.lit(0.0)).alias("spread"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.hll_union_agg("distincts").alias("distincts"),
        F.theta_union_agg("members").alias("members"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    extra = [c for c in found.columns if c not in STATE]
    return found.select(*extra, *STATE)


def add_batch(state: DataFrame, folder: str, batch: int) -> None:
    """Store the state of one batch; a repeated batch replaces itself."""
    state.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch}")


def stored_state(spark: SparkSession, folder: str) -> DataFrame:
    """All stored state rows. Late rows of a day are further state rows of that day."""
    return spark.read.parquet(folder).drop(BATCH)


def compact_state(spark: SparkSession, folder: str, target: str) -> None:
    """One row per day and column, written to another folder as batch 0."""
    add_batch(merged_state(stored_state(spark, folder), "day"), target, 0)


def figures(state: DataFrame) -> DataFrame:
    """Readable columns of state rows: counts, null share, mean, deviation, bounds, distinct estimate, quantile estimates."""
    ranks = [
        F.when((F.col("data_type") == "numeric") & (F.col("n_values") > 0), F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(name)
        for name, p in QUANTILES.items()
    ]
    return state.select(
        *[c for c in state.columns if c not in STATE[3:]],
        "n_rows",
        "n_values",
        percent(F.col("n_rows") - F.col("n_values"), F.col("n_rows")).alias("null_pct"),
        F.col("mean").alias("avg"),
        _deviation(F.col("spread"), F.col("n_values")).alias("stddev"),
        "min_value",
        "max_value",
        F.hll_sketch_estimate("distincts").alias("distinct_values"),
        *ranks,
    )


def _deviation(spread: Column, n: Column) -> Column:
    return F.when(n > 1, F.sqrt(spread / (n - 1)))


def _between(start: Column, end: Column) -> Column:
    return (F.col("day") >= start) & (F.col("day") < end)


def window_state(state: DataFrame, start: object, end: object) -> DataFrame:
    """The state of the days from ``start`` to before ``end``, one row per column."""
    return merged_state(state.filter(_between(F.lit(start).cast("date"), F.lit(end).cast("date"))))


def sketched_drift(
    state: DataFrame,
    time_window: str = "1 month",
    compare_window: str = "1 month",
    as_of: object = None,
    abs_baseline: bool = False,
    only_drifted: bool = True,
) -> DataFrame:
    """Drift between the window before ``as_of`` and the window before that one, from the state alone.

    Average, standard deviation and null rate are exact; distinct counts are estimates. ``value_overlap`` is the estimated
    percentage of recent distinct values that the earlier window lacks. Windows are whole days.
    """
    for window in (time_window, compare_window):
        if window.strip().partition(" ")[2].strip().lower().removesuffix("s") not in UNITS[1:]:
            raise ValueError("windows of a daily state are given in days or longer units")
    end = (F.current_date() if as_of is None else F.lit(as_of)).cast("date").cast("timestamp_ntz")
    split = (end - window_interval(time_window)).cast("date")
    start = (end - window_interval(compare_window) - window_interval(time_window)).cast("date")
    inside = state.filter(_between(start, end.cast("date"))).withColumn("__recent", F.col("day") >= split)
    sides = merged_state(inside, "__recent")
    parts = ("n_rows", "n_values", "mean", "spread", "distincts", "members")
    picked = [
        F.first(F.when(side, F.struct(*parts)), ignorenulls=True).alias(name)
        for name, side in (("r", F.col("__recent")), ("c", ~F.col("__recent")))
    ]
    wide = sides.groupBy("column_name", "data_type").agg(*picked)  # two rows a column

    def relative(new: Column, base: Column) -> Column:
        base_ = (F.abs(base) if abs_baseline else base).cast("double")
        return F.round(F.abs(new - base).cast("double") / F.nullif(base_, F.lit(0.0)) * F.lit(100.0), 2)

    numeric = F.col("data_type") == "numeric"
    spreads = {s: _deviation(F.col(f"{s}.spread"), F.col(f"{s}.n_values")) for s in "rc"}
    distincts = {s: F.hll_sketch_estimate(F.col(f"{s}.distincts")) for s in "rc"}
    nulls = {s: percent(F.col(f"{s}.n_rows") - F.col(f"{s}.n_values"), F.col(f"{s}.n_rows")) for s in "rc"}
    known = F.col("r").isNotNull() & F.col("c").isNotNull()
    recent = F.theta_sketch_estimate(F.col("r.members"))
    shared = F.when(known, F.theta_sketch_estimate(F.theta_intersection(F.col("r.members"), F.col("c.members"))))
    lacking = F.when(known, F.round(F.lit(100.0) - percent(F.least(shared, recent), recent), 2))

    def row(metric: str, new: Column, base: Column, change: Column, wanted: Column) -> list[Column]:
        return [F.lit(metric), new, base, change, wanted]

    rows = [
        row("avg", number_text(F.col("r.mean"), 2), number_text(F.col("c.mean"), 2), relative(F.col("r.mean"), F.col("c.mean")), numeric),
        row("stddev", number_text(spreads["r"], 2), number_text(spreads["c"], 2), relative(spreads["r"], spreads["c"]), numeric),
        row("distinct_count", distincts["r"].cast("string"), distincts["c"].cast("string"), relative(distincts["r"], distincts["c"]), ~numeric),
        row("null_rate", number_text(nulls["r"], 2), number_text(nulls["c"], 2), F.abs(nulls["r"] - nulls["c"]), F.lit(True)),
        row("value_overlap", shared.cast("string"), F.theta_sketch_estimate(F.col("c.members")).cast("string"), lacking, ~numeric),
    ]
    names = ("metric", "recent_value", "comparison_value", "pct_change", "wanted")
    cells = F.array(*[F.struct(*[v.alias(n) for n, v in zip(names, r)]) for r in rows])
    found = wide.select("column_name", "data_type", F.inline(cells)).filter("wanted").drop("wanted")
    found = found.withColumn("drift_severity", severity(F.col("pct_change")))
    return found.filter(F.col("drift_severity") != NORMAL) if only_drifted else found
