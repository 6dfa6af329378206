"""Registered queries: file drops, leave mart, streaming ingest and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.operators import leave
from plumbline.plans.registry import Inputs, query
from plumbline.session import scratch_dir
from plumbline.sources import drops
from plumbline.sources.history import extend_history, read_history
from plumbline.streaming import ingest

# ---------------------------------------------------------------- drops

_TYPE = """CASE WHEN regexp_matches(LOWER(file_name), 'leave\\s+of\\s+absence') THEN 'loa'
      WHEN regexp_matches(LOWER(file_name), 'time\\s+off') THEN 'to' END"""
_KNOWN = f"(SELECT *, {_TYPE} AS file_type FROM {{drop_files}} WHERE ends_with(file_name, '.xlsx') OR ends_with(file_name, '.xls'))"
_DATE = "CAST(try_strptime(regexp_extract(file_name, '(\\d{{8}})', 1), '%Y%m%d') AS DATE)"


@query("classify_files", f"SELECT * FROM {_KNOWN} WHERE file_type IS NOT NULL")
def _(t: Inputs):
    return drops.classify_files(t.drop_files)


@query("file_date", f"SELECT *, {_DATE} AS file_date FROM {{drop_files}}")
def _(t: Inputs):
    return drops.file_date(t.drop_files)


def _leave_drop(t: Inputs) -> DataFrame:
    """Leave as a drop delivers it: headed columns, one of them under another name, no ingest time."""
    return t.raw_leave.select(
        F.col("employee_id").alias("Worker"),
        F.col("effective_date").alias("Effective Date"),
        F.col("first_day_of_leave").alias("First Day of Leave"),
        F.col("last_day_leave_estimated").alias("Last Day of Leave - Estimated"),
        F.col("last_day_leave_actual").alias("Last Day of Leave - Actual"),
    )


_LEAVE_DROP_SQL = """SELECT employee_id AS "Employee ID", CAST(effective_date AS VARCHAR) AS "Effective Date",
      CAST(first_day_of_leave AS VARCHAR) AS "First Day of Leave", COALESCE(CAST(last_day_leave_estimated AS VARCHAR), '') AS "Last Day of Leave - Estimated",
      COALESCE(CAST(last_day_leave_actual AS VARCHAR), '') AS "Last Day of Leave - Actual", CAST(1741766400 AS BIGINT) AS timestamp_unix FROM {raw_leave}"""


@query("normalize_loa", _LEAVE_DROP_SQL)
def _(t: Inputs):
    return drops.normalize_loa(_leave_drop(t), {"Worker": "Employee ID"}, 1741766400)


def _time_off_drop(t: Inputs) -> DataFrame:
    """Time off as a drop delivers it, without the optional columns."""
    return t.raw_time_off.select(
        F.col("employee_id").alias("Employee ID"),
        F.col("time_off_date").alias("Time Off Date"),
        F.col("duration").alias("Duration"),
        F.col("timestamp_unix").cast("bigint").alias("timestamp_unix"),
    )


@query(
    "normalize_time_off",
    """SELECT employee_id AS "Employee ID", time_off_date AS "Time Off Date", duration AS "Duration", CAST(timestamp_unix AS BIGINT) AS timestamp_unix,
      'Approved' AS "Status", 'Hours' AS "Unit of Time" FROM {raw_time_off}""",
)
def _(t: Inputs):
    return drops.normalize_time_off(_time_off_drop(t))


@query(
    "append_aligned",
    """SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(NULL AS DATE) AS order_day FROM {orders_old}
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL, NULL, order_day FROM {orders_reshaped}""",
)
def _(t: Inputs):
    return drops.append_aligned(t.orders_old, t.orders_reshaped)


def _known_files(t: Inputs) -> DataFrame:
    return drops.classify_files(t.drop_files).withColumnRenamed("doc_id", "file_path")


def _archived_before(t: Inputs) -> DataFrame:
    """Records of an earlier run: every leave file from the two most common sources."""
    held = drops.classify_files(t.drop_files).filter(F.col("file_name").contains("src0") & (F.col("file_type") == "loa"))
    return held.select("file_type", F.col("file_name").alias("archived_filename")).distinct()


@query(
    "ingest_manifest",
    f"""WITH known AS (SELECT * FROM {_KNOWN} WHERE file_type IS NOT NULL),
    held AS (SELECT DISTINCT file_type, file_name FROM known WHERE contains(file_name, 'src0') AND file_type = 'loa'),
    ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY file_type, file_name ORDER BY doc_id) AS rn FROM known)
    SELECT file_name AS original_filename, CASE WHEN rn > 1 OR EXISTS (SELECT 1 FROM held h WHERE h.file_type = r.file_type AND h.file_name = r.file_name)
      THEN '20250312_070500_' || substr(sha256(file_type || '|' || doc_id), 1, 16) || '_' || file_name ELSE file_name END AS archived_filename, file_type, '2025-03-12T07:05:00' AS archived_timestamp, 'ingest' AS archived_by
    FROM ranked r""",
)
def _(t: Inputs):
    return drops.ingest_manifest(_known_files(t), _archived_before(t), "2025-03-12 07:05:00")


@query(
    "ingest_summary",
    f"""SELECT file_name AS file, COALESCE(strftime({_DATE}, '%Y-%m-%d'), 'unknown date') AS date, file_type AS type,
      CASE WHEN COUNT(*) FILTER (WHERE trim(text) <> '') > 0 THEN COUNT(*) FILTER (WHERE trim(text) <> '') ELSE 0 END AS records,
      COUNT(*) FILTER (WHERE trim(text) <> '') > 0 AS success, COUNT(*) FILTER (WHERE trim(text) <> '') > 0 AND file_type = 'loa' AS archived,
      CAST(NULL AS VARCHAR) AS error
    FROM (SELECT k.*, d.text FROM {_KNOWN} k JOIN {{documents}} d USING (doc_id)) WHERE file_type IS NOT NULL GROUP BY file_name, file_type""",
)
def _(t: Inputs):
    files = drops.classify_files(t.drop_files)
    records = files.join(t.documents.filter("trim(text) <> ''").select("doc_id"), "doc_id", "left_semi")
    manifest = drops.ingest_manifest(_known_files(t).filter("file_type = 'loa'"), None)
    return drops.ingest_summary(files, records, manifest)


# ---------------------------------------------------------------- staging

_LOADED = "2024-03-10 06:00:00"
_TIME_OFF_AS_OF, _LEAVE_AS_OF = "2024-03-10", "1998-06-01"
_RAW_TO = """SELECT CAST(employee_id AS INT) AS employee_id, CAST(timestamp_request_was_made AS INT) AS timestamp_request_was_made, type,
      CAST(time_off_date AS DATE) AS time_off_date, CAST(duration AS DOUBLE) AS duration, unit_of_time, status, CAST(timestamp_unix AS BIGINT) AS timestamp_unix,
      employee_id || '|' || time_off_date || '|' || duration AS upi, TIMESTAMP '2024-03-10 06:00:00' AS loaded_at FROM {raw_time_off}"""
_RAW_LOA = """SELECT CAST(employee_id AS INT) AS employee_id, effective_date, CAST(NULL AS DATE) AS last_day_of_work, first_day_of_leave,
      last_day_leave_estimated, last_day_leave_actual, CAST(NULL AS DATE) AS first_day_back_at_work, CAST(NULL AS VARCHAR) AS total_days_on_leave,
      CAST(timestamp_unix AS BIGINT) AS timestamp_unix, TIMESTAMP '2024-03-10 06:00:00' AS loaded_at FROM {raw_leave}"""


def _latest(source: str, keys: str, columns: str, name: str) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["timestamp_unix", *columns.split()])
    return f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1)"


_TO_REST = "employee_id timestamp_request_was_made type time_off_date duration unit_of_time status"
_LOA_REST = "first_day_of_leave last_day_leave_estimated last_day_leave_actual"
_TO = f"WITH raw AS ({_RAW_TO}), " + _latest("raw", "upi", _TO_REST, "staged")
_LOA = f"WITH rawl AS ({_RAW_LOA}), " + _latest("rawl", "employee_id, effective_date", _LOA_REST, "stagedl")


def _as_double(df: DataFrame) -> DataFrame:
    shown = {c: F.col(c).cast("double") for c in ("duration", "duration_hours") if c in df.columns}
    return df.withColumns(shown)


def _staged_time_off(t: Inputs) -> DataFrame:
    return leave.latest_rows(leave.typed_time_off(t.raw_time_off, _LOADED), "upi")


def _staged_loa(t: Inputs) -> DataFrame:
    return leave.latest_rows(leave.typed_loa(t.raw_leave, _LOADED), ["employee_id", "effective_date"])


@query(
    "stage_time_off",
    f"""WITH raw AS ({_RAW_TO}), inside AS (SELECT * FROM raw WHERE time_off_date BETWEEN DATE '2024-01-10' AND DATE '2024-04-09'),
    first_half AS (SELECT * FROM inside WHERE time_off_date < DATE '2024-01-20'),
    """
    + _latest("first_half", "upi", _TO_REST, "target")
    + ", "
    + _latest("(SELECT * FROM inside WHERE timestamp_unix > (SELECT MAX(timestamp_unix) FROM target))", "upi", _TO_REST, "updates")
    + " SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.upi = t.upi) UNION ALL SELECT * FROM updates",
)
def _(t: Inputs):
    earlier = t.raw_time_off.filter("time_off_date < '2024-01-20'")
    target = leave.stage_time_off(earlier, None, _TIME_OFF_AS_OF, loaded_at=_LOADED)
    return _as_double(leave.stage_time_off(t.raw_time_off, target, _TIME_OFF_AS_OF, loaded_at=_LOADED))


@query(
    "stage_loa",
    f"WITH rawl AS ({_RAW_LOA}), inside AS (SELECT * FROM rawl WHERE effective_date BETWEEN DATE '1998-04-02' AND DATE '1998-07-01'), "
    + _latest("inside", "employee_id, effective_date", _LOA_REST, "stagedl")
    + " SELECT * FROM stagedl",
)
def _(t: Inputs):
    return leave.stage_loa(t.raw_leave, None, _LEAVE_AS_OF, loaded_at=_LOADED)


@query("window_filter", "SELECT * FROM {orders} WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-04-02' AND DATE '1998-07-01'")
def _(t: Inputs):
    return leave.window_filter(t.orders, "o_orderdate", _LEAVE_AS_OF)


@query("stage_employee", "SELECT employee_id, preferred_name AS employee_name FROM {employee}")
def _(t: Inputs):
    return leave.stage_employee(t.employee)


_DIM = """SELECT s.*, e.preferred_name AS employee_name, s.loaded_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
    FROM %s s LEFT JOIN {employee} e ON e.employee_id = s.employee_id"""


@query("dim_time_off", _TO + _DIM % "staged")
def _(t: Inputs):
    return _as_double(leave.dim_time_off(_staged_time_off(t), leave.stage_employee(t.employee)))


@query("dim_loa", _LOA + _DIM % "stagedl")
def _(t: Inputs):
    return leave.dim_loa(_staged_loa(t), leave.stage_employee(t.employee))


_TWICE = (
    f"WITH raw AS ({_RAW_TO}), early AS (SELECT * REPLACE (TIMESTAMP '2024-03-09 06:00:00' AS loaded_at) FROM raw WHERE time_off_date < DATE '2024-01-20'), "
    + _latest("early", "upi", _TO_REST, "first_load")
    + ", "
    + _latest("raw", "upi", _TO_REST, "second_load")
    + ", loads AS (SELECT * FROM first_load UNION ALL SELECT * FROM second_load)"
)


_HISTORY = (
    _TWICE
    + """ SELECT * , valid_to IS NULL AS is_current FROM (SELECT s.*, e.preferred_name AS employee_name, s.loaded_at AS valid_from,
      LEAD(s.loaded_at) OVER (PARTITION BY s.upi ORDER BY s.loaded_at) AS valid_to
    FROM loads s LEFT JOIN {employee} e ON e.employee_id = s.employee_id)"""
)


@query("dim_time_off_history", _HISTORY)
def _(t: Inputs):
    """Two loads, the second of which repeats the days of the first."""
    early = leave.typed_time_off(t.raw_time_off.filter("time_off_date < '2024-01-20'"), "2024-03-09 06:00:00")
    loads = leave.latest_rows(early, "upi").unionByName(_staged_time_off(t))
    return _as_double(leave.dim_time_off(loads, leave.stage_employee(t.employee), history=True))


@query("dim_time_off_increments", _HISTORY)
def _(t: Inputs):
    """The same two loads, the history kept by increments; the second load comes twice."""
    table = scratch_dir(t.spark, "time-off-history") + "/table"
    early = leave.typed_time_off(t.raw_time_off.filter("time_off_date < '2024-01-20'"), "2024-03-09 06:00:00")
    for load in (leave.latest_rows(early, "upi"), _staged_time_off(t), _staged_time_off(t)):
        extend_history(load, table, "upi")
    return _as_double(read_history(t.spark, table).join(leave.stage_employee(t.employee), "employee_id", "left"))


@query(
    "dim_time_off_as_of",
    _HISTORY.replace(" SELECT * , valid_to", " SELECT upi, status, duration, valid_to", 1)
    + " WHERE valid_from <= TIMESTAMP '2024-03-09 12:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-03-09 12:00:00')",
)
def _(t: Inputs):
    """What the history of two loads said between them."""
    table = scratch_dir(t.spark, "time-off-as-of") + "/table"
    early = leave.typed_time_off(t.raw_time_off.filter("time_off_date < '2024-01-20'"), "2024-03-09 06:00:00")
    extend_history(leave.latest_rows(early, "upi").unionByName(_staged_time_off(t)), table, "upi")
    found = read_history(t.spark, table, at="2024-03-09 12:00:00")
    return _as_double(found.select("upi", "status", "duration", "is_current"))


_DAYS = """SELECT s.employee_id, e.preferred_name AS employee_name, TIMESTAMP '1970-01-01 00:00:00' + s.timestamp_unix * INTERVAL 1 SECOND AS request_timestamp,
      s.timestamp_unix AS request_timestamp_unix, 'LOA' AS type_of_time_off, d.full_date AS time_off_date, CAST(8 AS DOUBLE) AS duration_hours,
      'Approved' AS status, s.employee_id || '|' || d.full_date || '|8.0' AS upi
    FROM stagedl s LEFT JOIN {employee} e ON e.employee_id = s.employee_id
    JOIN {date_dim} d ON d.full_date BETWEEN s.first_day_of_leave AND COALESCE(s.last_day_leave_actual, s.last_day_leave_estimated)
      AND d.day_is_weekday = 1 AND d.holiday_us_federal_reserve = 0"""


@query("expand_leave_days", _LOA + _DAYS)
def _(t: Inputs):
    return _as_double(leave.expand_leave_days(leave.dim_loa(_staged_loa(t), leave.stage_employee(t.employee)), t.date_dim))


@query(
    "fct_time_off_leave",
    _TO
    + ", "
    + _LOA.removeprefix("WITH ")
    + """ SELECT employee_id AS emp_id, employee_name AS emp_name, request_timestamp, request_timestamp_unix, type_of_time_off, time_off_date,
      duration_hours, status, upi, TIMESTAMP '2024-03-10 06:00:00' AS last_updated_at FROM (
      SELECT s.employee_id, e.preferred_name AS employee_name, TIMESTAMP '1970-01-01 00:00:00' + s.timestamp_unix * INTERVAL 1 SECOND AS request_timestamp,
        s.timestamp_unix AS request_timestamp_unix, s.type AS type_of_time_off, s.time_off_date, s.duration AS duration_hours, s.status, s.upi
      FROM staged s LEFT JOIN {employee} e ON e.employee_id = s.employee_id UNION ALL """
    + _DAYS
    + ")",
)
def _(t: Inputs):
    employees = leave.stage_employee(t.employee)
    time_off = leave.dim_time_off(_staged_time_off(t), employees)
    loa = leave.dim_loa(_staged_loa(t), employees)
    return _as_double(leave.fct_time_off_leave(time_off, loa, t.date_dim, _LOADED))


# ---------------------------------------------------------------- streaming

@query("ingest_stream", _LEAVE_DROP_SQL.replace("employee_id AS", "CAST(employee_id AS VARCHAR) AS", 1))
def _(t: Inputs):
    """Drops arrive in two deliveries, the second with its columns in reverse; its run takes only the new files."""
    place = scratch_dir(t.spark, "ingest-stream")
    whole = _leave_drop(t)
    early = F.col("Effective Date") < F.lit("1998-01-01").cast("date")
    for folder, rows in (
        ("Leave of Absence 19980101", whole.filter(early)),
        ("Leave of Absence 20010801", whole.filter(~early)),
    ):
        columns = rows.columns if folder.endswith("0101") else rows.columns[::-1]
        rows.select(*columns).write.option("header", "true").csv(f"{place}/drops/{folder}")
        stream = ingest.ingest_stream(
            t.spark,
            f"{place}/drops",
            drops.LEAVE,
            f"{place}/table",
            f"{place}/checkpoint",
            {"Worker": "Employee ID"},
            1741766400,
        )
        stream.awaitTermination()
    return ingest.ingested_table(t.spark, f"{place}/table")


@query(
    "merge_stream",
    f"""WITH raw AS ({_RAW_TO}), early AS (SELECT * FROM raw WHERE time_off_date < DATE '2024-01-16'),
    merged AS (SELECT * FROM early UNION ALL
      SELECT * FROM raw WHERE time_off_date >= DATE '2024-01-11' AND timestamp_unix > (SELECT MAX(timestamp_unix) FROM early)),
    """
    + _latest("merged", "upi", _TO_REST, "latest")
    + " SELECT * FROM latest",
)
def _(t: Inputs):
    """Two deliveries of which the second repeats five days; the repeated rows are late and dropped."""
    place = scratch_dir(t.spark, "merge-stream")
    raw = t.raw_time_off
    for rows in (raw.filter("time_off_date < '2024-01-16'"), raw.filter("time_off_date >= '2024-01-11'")):
        rows.write.mode("append").parquet(f"{place}/raw")
        updates = t.spark.readStream.schema(raw.schema).parquet(f"{place}/raw")
        stream = ingest.merge_stream(
            updates,
            f"{place}/table",
            f"{place}/checkpoint",
            "upi",
            lambda batch: leave.typed_time_off(batch, _LOADED),
            partition="time_off_date",
        )
        stream.awaitTermination()
    return _as_double(ingest.merged_table(t.spark, f"{place}/table"))


@query(
    "merge_stream_watermark",
    f"""WITH raw AS ({_RAW_TO}), early AS (SELECT * FROM raw WHERE time_off_date < DATE '2024-01-16'),
    merged AS (SELECT * FROM early UNION ALL
      SELECT * FROM raw WHERE time_off_date >= DATE '2024-01-11' AND timestamp_unix > (SELECT MAX(timestamp_unix) - 1800 FROM early)),
    """
    + _latest("merged", "upi", _TO_REST, "latest")
    + " SELECT * FROM latest",
)
def _(t: Inputs):
    """The same deliveries by event time: rows of the second that are over half an hour behind the first are dropped."""
    place = scratch_dir(t.spark, "merge-watermark")
    raw = leave.typed_time_off(t.raw_time_off, _LOADED).withColumn("made_at", F.timestamp_seconds("timestamp_unix"))
    for rows in (raw.filter("time_off_date < '2024-01-16'"), raw.filter("time_off_date >= '2024-01-11'")):
        rows.write.mode("append").parquet(f"{place}/raw")
        stream = ingest.merge_stream(
            t.spark.readStream.schema(raw.schema).parquet(f"{place}/raw"),
            f"{place}/table",
            f"{place}/checkpoint",
            "upi",
            lambda batch: batch.drop("made_at"),
            late="watermark",
            partition="time_off_date",
            event_time="made_at",
            delay="30 minutes",
        )
        stream.awaitTermination()
    return _as_double(ingest.merged_table(t.spark, f"{place}/table"))
