"""Staging, dimensions and day-grain fact of the leave mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.columns import any_null, as_list, col

TIMESTAMP = "timestamp_unix"

# Raw headings, staged types, window bounds and constants of the leave branch.
TIME_OFF_HEADINGS = {
    "Employee ID": "employee_id",
    "Timestamp - Request was Made": "timestamp_request_was_made",
    "Type": "type",
    "Time Off Date": "time_off_date",
    "Duration": "duration",
    "Unit of Time": "unit_of_time",
    "Status": "status",
}
LEAVE_HEADINGS = {
    "Employee ID": "employee_id",
    "Effective Date": "effective_date",
    "Last Day of Work": "last_day_of_work",
    "First Day of Leave": "first_day_of_leave",
    "Last Day of Leave - Estimated": "last_day_leave_estimated",
    "Last Day of Leave - Actual": "last_day_leave_actual",
    "First day Back at Work": "first_day_back_at_work",
    "Total Days on Leave": "total_days_on_leave",
}
TIME_OFF_TYPES = {
    "employee_id": "int",
    "timestamp_request_was_made": "int",
    "type": "string",
    "time_off_date": "date",
    "duration": "decimal(5,2)",
    "unit_of_time": "string",
    "status": "string",
    "timestamp_unix": "bigint",
}
LEAVE_TYPES = {
    "employee_id": "int",
    "effective_date": "date",
    "last_day_of_work": "date",
    "first_day_of_leave": "date",
    "last_day_leave_estimated": "date",
    "last_day_leave_actual": "date",
    "first_day_back_at_work": "date",
    "total_days_on_leave": "string",
    "timestamp_unix": "bigint",
}
LOOKBACK_DAYS, FORWARD_DAYS = 60, 30
LEAVE_TYPE, LEAVE_HOURS, LEAVE_STATUS = "LOA", "8.0", "Approved"


def _typed(raw: DataFrame, headings: dict[str, str], types: dict[str, str]) -> DataFrame:
    """Rename, cast (dirty text becomes NULL) and add absent columns as NULL."""
    df = raw.withColumnsRenamed({k: v for k, v in headings.items() if k in raw.columns})
    return df.select(
        "*",
        *[
            (col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias("__" + c)
            for c, t in types.items()
        ],
    )


def window_filter(
    df: DataFrame,
    date_column: str,
    as_of: object = None,
    lookback: int = LOOKBACK_DAYS,
    forward: int = FORWARD_DAYS,
) -> DataFrame:
    """Rows dated within the business window around ``as_of``, bounds included."""
    today = (F.current_date() if as_of is None else F.lit(as_of)).cast("date")
    return df.filter(col(date_column).between(F.date_sub(today, lookback), F.date_add(today, forward)))


def newer_than(df: DataFrame, target: DataFrame | None, column: str = "timestamp_unix") -> DataFrame:
    """Rows above the target's high-water mark."""
    if target is None:
        return df
    mark = target.agg(F.coalesce(F.max(column), F.lit(0).cast("bigint")).alias("mark")).scalar()
    return df.filter(col(column) > mark)


def latest_rows(df: DataFrame, keys: str | Sequence[str], order: str = "timestamp_unix") -> DataFrame:
    """The row with the highest ``order`` per key, ties by all columns; rows with a NULL key all stay.

    A plain maximum of structs, so a frequent key is reduced inside the map tasks. Rows with a
    NULL key are told apart by a number of their own.
    """
    keys = as_list(keys)
    rest = [c for c in df.columns if c not in keys and c != order]
    own_number = F.when(any_null(keys), F.monotonically_increasing_id())
    return (
        df.withColumn("__own", own_number)
        .groupBy(*[col(k) for k in keys], "__own")
        .agg(F.max(F.struct(col(order), *[col(c) for c in rest])).alias("__best"))
        .select(*[col(c) if c in keys else F.col("__best")[c].alias(c) for c in df.columns])
    )


def merge_latest(
    target: DataFrame | None, updates: DataFrame, keys: str | Sequence[str], order: str = "timestamp_unix"
) -> DataFrame:
    """The latest row per key of a target (unique by key) and updates; at equal times the update wins.

    An update older than the target's row, or without a time, changes nothing.
    """
    updates = latest_rows(updates, keys, order)
    if target is None:
        return updates
    keys = as_list(keys)
    held = target.select(*[col(k) for k in keys], col(order).alias("__held_at"), F.lit(True).alias("__held"))
    updates = updates.join(held, keys, "left")
    newer = F.isnull("__held") | F.isnull("__held_at") | (col(order) >= F.col("__held_at"))
    updates = updates.filter(newer).select(*[col(c) for c in updates.columns if not c.startswith("__held")])
    kept = target.join(updates.select(*[col(k) for k in keys]), keys, "left_anti").select(*[col(c) for c in target.columns])
    return kept.unionByName(updates)


def _loaded(loaded_at: object) -> Column:
    return (F.current_timestamp() if loaded_at is None else F.lit(loaded_at)).cast("timestamp_ntz").alias("loaded_at")


def typed_time_off(raw: DataFrame, loaded_at: object = None, canonical_upi: bool = False) -> DataFrame:
    """Typed time-off rows with the row identity ``employee|date|duration``.

    The identity is built from the raw text; ``canonical_upi`` uses the typed values, so that
    ``8`` and ``8.0`` hours agree.
    """
    df = _typed(raw, TIME_OFF_HEADINGS, TIME_OFF_TYPES)
    mark = "__" if canonical_upi else ""
    parts = [col(mark + c).cast("string") for c in ("employee_id", "time_off_date", "duration")]
    upi = F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2])
    return df.select(*[col("__" + c).alias(c) for c in TIME_OFF_TYPES], upi.alias("upi"), _loaded(loaded_at))


def typed_loa(raw: DataFrame, loaded_at: object = None) -> DataFrame:
    df = _typed(raw, LEAVE_HEADINGS, LEAVE_TYPES)
    return df.select(*[col("__" + c).alias(c) for c in LEAVE_TYPES], _loaded(loaded_at))


def stage_time_off(
    raw: DataFrame,
    target: DataFrame | None = None,
    as_of: object = None,
    late: str = "drop",
    loaded_at: object = None,
    canonical_upi: bool = False,
) -> DataFrame:
    """Incremental staging of time off: typed, newer than the target, in the window, merged on ``upi``.

    ``late='upsert'`` also merges rows at or below the high-water mark.
    """
    typed = typed_time_off(raw, loaded_at, canonical_upi)
    fresh = newer_than(typed, target if late == "drop" else None)
    return merge_latest(target, window_filter(fresh, "time_off_date", as_of), "upi")


def stage_loa(
    raw: DataFrame,
    target: DataFrame | None = None,
    as_of: object = None,
    late: str = "drop",
    loaded_at: object = None,
) -> DataFrame:
    """Incremental staging of leave, merged on ``(employee_id, effective_date)``."""
    fresh = newer_than(typed_loa(raw, loaded_at), target if late == "drop" else None)
    return merge_latest(target, window_filter(fresh, "effective_date", as_of), ["employee_id", "effective_date"])


def stage_employee(employees: DataFrame) -> DataFrame:
    return employees.select("employee_id", F.col("preferred_name").alias("employee_name"))


def _dimension(staged: DataFrame, employees: DataFrame, keys: Sequence[str], history: bool) -> DataFrame:
    rest = [c for c in staged.columns if c != "employee_id"]
    valid_to = F.lit(None).cast("timestamp_ntz")
    if history:
        # rows without a key follow no other; each has a number of its own
        staged = staged.withColumn("__own", F.when(any_null(keys), F.monotonically_increasing_id()))
        order = [col(c) for c in ("loaded_at", TIMESTAMP, *[c for c in rest if c not in (*keys, "loaded_at", TIMESTAMP)])]
        versions = Window.partitionBy(*[col(k) for k in keys], "__own").orderBy(*order)
        staged = staged.withColumn("__valid_to", F.lead("loaded_at").over(versions))
        valid_to = F.col("__valid_to")
    return staged.join(employees, "employee_id", "left").select(
        "employee_id",
        "employee_name",
        *[col(c) for c in rest],
        F.col("loaded_at").alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def dim_time_off(staged: DataFrame, employees: DataFrame, history: bool = False) -> DataFrame:
    """Time off with employee name and validity columns, one current row per key.

    With ``history``, ``staged`` holds the rows of several loads and every row stays, valid until the
    key's next load; the last is current.
    """
    return _dimension(staged, employees, ["upi"], history)


def dim_loa(staged: DataFrame, employees: DataFrame, history: bool = False) -> DataFrame:
    """Leave with employee name and validity columns, one current row per key; ``history`` as for time off."""
    return _dimension(staged, employees, ["employee_id", "effective_date"], history)


def _request_time() -> Column:
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return epoch + F.make_dt_interval(secs=F.col("timestamp_unix").cast("decimal(18,6)"))


_FACT = (
    "employee_id",
    "employee_name",
    "request_timestamp",
    "request_timestamp_unix",
    "type_of_time_off",
    "time_off_date",
    "duration_hours",
    "status",
    "upi",
)


def expand_leave_days(leave: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per working day of each current leave.

    The interval, cut to the span of the date dimension, becomes its days, and days meet the
    dimension by equality. A leave without an end or with its end before its start has no days.
    """
    working = dates.filter((F.col("day_is_weekday") == 1) & (F.col("holiday_us_federal_reserve") == 0)).select(
        F.col("full_date").alias("time_off_date")
    )
    span = working.agg(F.struct(F.min("time_off_date").alias("low"), F.max("time_off_date").alias("high"))).scalar()
    first = F.greatest(F.col("first_day_of_leave"), span["low"])
    last = F.coalesce("last_day_leave_actual", "last_day_leave_estimated")
    days = (
        leave.filter(F.col("is_current"))
        .withColumn("__first", F.when(F.col("first_day_of_leave").isNotNull(), first))
        .withColumn("__last", F.when(last.isNotNull(), F.least(last, span["high"])))
        .filter(F.col("__first") <= F.col("__last"))
        .withColumn("time_off_date", F.explode(F.sequence("__first", "__last")))
        .join(working, "time_off_date", "inner")
    )
    return days.select(
        "employee_id",
        "employee_name",
        _request_time().alias("request_timestamp"),
        F.col("timestamp_unix").alias("request_timestamp_unix"),
        F.lit(LEAVE_TYPE).alias("type_of_time_off"),
        "time_off_date",
        F.lit(LEAVE_HOURS).cast("decimal(5,2)").alias("duration_hours"),
        F.lit(LEAVE_STATUS).alias("status"),
        F.concat_ws("|", F.col("employee_id"), F.col("time_off_date"), F.lit(LEAVE_HOURS)).alias("upi"),
    )


def fct_time_off_leave(
    time_off: DataFrame, leave: DataFrame, dates: DataFrame, updated_at: object = None
) -> DataFrame:
    """Current time off and expanded leave as one day-grain fact."""
    current = time_off.filter("is_current").select(
        "employee_id",
        "employee_name",
        _request_time().alias("request_timestamp"),
        F.col("timestamp_unix").alias("request_timestamp_unix"),
        F.col("type").alias("type_of_time_off"),
        "time_off_date",
        F.col("duration").alias("duration_hours"),
        "status",
        "upi",
    )
    updated = (F.current_timestamp() if updated_at is None else F.lit(updated_at)).cast("timestamp_ntz")
    return (
        current.unionByName(expand_leave_days(leave, dates))
        .select(*_FACT)
        .withColumnsRenamed({"employee_id": "emp_id", "employee_name": "emp_name"})
        .withColumn("last_updated_at", updated)
    )
