from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from helpers import one, rows

from plumbline.operators import leave as E
from plumbline.sources import drops as S
from plumbline.streaming import ingest as T

D = dt.date
TO = "employee_id string, time_off_date string, duration string, status string, timestamp_unix string"


def time_off(spark, *items):
    return spark.createDataFrame(items, TO)


def test_files(spark):
    names = [
        "Export  Leave of Absence 20250312 07_00 PDT.xlsx",
        "Export  TIME   off 20250312 07_02 PDT.xls",
        "Leave of Absence, Time Off 20259912.xlsx",
        "Roster 20250312.xlsx",
        "Time Off 20250312.pdf",
        "Time Off.xlsx",
    ]
    files = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = {r["file_name"]: (r["file_type"], r["file_date"]) for r in S.file_date(S.classify_files(files)).collect()}
    assert got == {
        names[0]: ("loa", D(2025, 3, 12)),
        names[1]: ("to", D(2025, 3, 12)),
        names[2]: ("loa", None),
        names[5]: ("to", None),
    }


def test_normalisation(spark):
    raw = spark.createDataFrame([(1, None, None, "x")], "Worker int, `Effective Date` date, `First Day of Leave` date, note string")
    got = one(S.normalize_loa(raw, {"Worker": "Employee ID"}, 7))
    assert got == {"Employee ID": 1, "Effective Date": "", "First Day of Leave": "", "note": "x", "timestamp_unix": 7}
    with pytest.raises(ValueError, match="Employee ID"):
        S.normalize_loa(raw)
    drop = spark.createDataFrame([(1, "2024-01-01", "8", None)], "`Employee ID` int, `Time Off Date` string, Duration string, Status string")
    got = one(S.normalize_time_off(drop))
    assert got["Status"] is None and got["Unit of Time"] == "Hours" and got["timestamp_unix"] > 1_600_000_000


def test_append_widens(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "k int, s string"), spark.createDataFrame([(9.5, 2)], "extra double, k int")
    assert S.append_aligned(a, b).columns == ["k", "s", "extra"]
    assert rows(S.append_aligned(a, b)) == [(1, "x", None), (2, None, 9.5)]
    assert S.append_aligned(None, b) is b
    path = str(tmp_path / "sink")
    S.append_to(a, path)
    S.append_to(b, path)
    assert rows(S.read_widened(spark, path), "k", "s", "extra") == [(1, "x", None), (2, None, 9.5)]


def test_read_drops_names_folders(spark, tmp_path):
    rows_of = spark.createDataFrame([(1, "a")], "k int, s string")
    rows_of.write.option("header", "true").csv(str(tmp_path / "Time Off 20240102 50%+"))
    got = one(S.read_drops(spark, str(tmp_path)))
    assert got["file_name"] == "Time Off 20240102 50%+" and got["k"] == "1"


def test_manifest(spark):
    files = spark.createDataFrame([("loa", "a.xlsx", 1), ("loa", "a.xlsx", 2), ("to", "a.xlsx", 3), ("loa", "b.xlsx", 4)], "file_type string, file_name string, file_path int")
    held = spark.createDataFrame([("loa", "b.xlsx")], "file_type string, archived_filename string")
    got = rows(S.ingest_manifest(files, held, "2025-03-12 07:05:00"), "file_type", "archived_filename")
    names = [name.replace("20250312_070500_", "+") for _, name in got]
    assert [n[:1] + n[-7:] if n[0] == "+" else n for n in names] == ["+_b.xlsx", "+_a.xlsx", "a.xlsx", "a.xlsx"]
    # three files of one name, all names taken by a run of the same second before
    more = spark.createDataFrame([("loa", "a.xlsx", i) for i in (1, 2, 5)], files.schema)
    first = S.ingest_manifest(more, held, "2025-03-12 07:05:00")
    second = S.ingest_manifest(more, first.union(first.limit(0)), "2025-03-12 07:05:00")
    third = S.ingest_manifest(more, first.union(second), "2025-03-12 07:05:00")
    kept = [r["archived_filename"] for r in first.union(second).union(third).collect()]
    assert len(kept) == 9 == len(set(kept))


def test_drops_are_read_by_heading(spark, tmp_path):
    folder = tmp_path / "drops"
    folder.mkdir()
    (folder / "time off [1].csv").write_text("Employee ID,Time Off Date,Duration\n1,2024-06-01,8\n")
    (folder / "time off 2.csv").write_text('Time Off Date,"Extra, more",,Duration,Employee ID\r\n2024-06-02,x,gap,4,2\r\n')
    (folder / "time off 3.csv").write_text("Employee ID,Duration\n3,8\n")
    (folder / "time off 4.csv").write_text("")
    names = ["Employee ID", "Time Off Date", "Duration", "Extra, more"]
    got = S.read_drops(spark, str(folder))
    assert sorted(got.columns) == sorted([*names, "file_name"])
    want = [("1", "2024-06-01", "8", None), ("2", "2024-06-02", "4", "x"), ("3", None, "8", None)]
    assert rows(got, *[f"`{n}`" for n in names]) == want
    place = str(tmp_path / "table")

    def run():
        T.ingest_stream(spark, str(folder), "to", place, str(tmp_path / "cp"), now=5).awaitTermination()
        return rows(T.ingested_table(spark, place), *[f"`{n}`" for n in names])

    assert run() == want[:2] == run()
    assert [r["lacking"] for r in T.refused_files(spark, place).collect()] == [["Time Off Date"]]
    (folder / "time off 5.csv").write_text("Worker,Duration,Time Off Date,Note\n")
    assert S.lacking(S.headings(spark, str(folder)), "to", {"Worker": "Employee ID"}).count() == 1


def test_summary(spark):
    files = spark.createDataFrame([("x 20240102", "to", None), ("y", "loa", "boom"), ("z", "to", None)], "file_name string, file_type string, error string")
    records = spark.createDataFrame([("x 20240102",), ("x 20240102",), ("y",)], "file_name string")
    got = {r["file"]: (r["date"], r["records"], r["success"], r["archived"]) for r in S.ingest_summary(files, records).collect()}
    assert got == {"x 20240102": ("2024-01-02", 2, True, False), "y": ("unknown date", 0, False, False), "z": ("unknown date", 0, False, False)}


def test_window_is_inclusive(spark):
    today = D(2024, 6, 15)
    days = [(today + dt.timedelta(n),) for n in (-61, -60, 0, 30, 31)]
    got = E.window_filter(spark.createDataFrame(days, "d date"), "d", "2024-06-15")
    assert rows(got) == [(days[1][0],), (days[2][0],), (days[3][0],)]


def test_upi_forms(spark):
    raw = time_off(spark, ("1", "2024-06-01", "8", "a", "1"), ("1", "2024-06-01", "8.0", "b", "2"))
    assert E.stage_time_off(raw, None, "2024-06-15").count() == 2
    got = one(E.stage_time_off(raw, None, "2024-06-15", canonical_upi=True))
    assert (got["upi"], got["status"], got["duration"]) == ("1|2024-06-01|8.00", "b", Decimal("8.00"))


def test_headings_and_dirty_text(spark):
    raw = spark.createDataFrame([("1", "n/a", "8")], "`Employee ID` string, `Time Off Date` string, Duration string")
    got = one(E.typed_time_off(raw))
    assert got["employee_id"] == 1 and got["time_off_date"] is None and got["upi"] == "1|n/a|8"


def test_incremental_merge(spark):
    first = time_off(spark, ("1", "2024-06-01", "8", "old", "10"), ("2", "2024-06-01", "8", "old", "20"))
    target = E.stage_time_off(first, None, "2024-06-15", loaded_at="2024-06-15")
    second = time_off(
        spark,
        ("1", "2024-06-01", "8", "new", "30"),
        ("1", "2024-06-01", "8", "newest", "31"),
        ("2", "2024-06-01", "8", "late", "15"),
        ("3", "2024-06-02", "8", "late", "20"),
        ("4", "2023-01-01", "8", "outside", "40"),
    )
    dropped = E.stage_time_off(second, target, "2024-06-15", loaded_at="2024-06-16")
    assert rows(dropped, "employee_id", "status") == [(1, "newest"), (2, "old")]
    kept = E.stage_time_off(second, target, "2024-06-15", late="upsert", loaded_at="2024-06-16")
    assert rows(kept, "employee_id", "status") == [(1, "newest"), (2, "old"), (3, "late")]
    again = E.stage_time_off(second, dropped, "2024-06-15", loaded_at="2024-06-17")
    assert rows(again) == rows(dropped)


def test_latest_rows(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (None, 1, "n"), (None, 2, "n")], "k int, timestamp_unix bigint, v string")
    assert rows(E.latest_rows(df, "k")) == [(1, 5, "b"), (None, 1, "n"), (None, 2, "n")]


def leave(spark, *items):
    schema = "employee_id int, first_day_of_leave date, last_day_leave_estimated date, last_day_leave_actual date"
    staged = E.typed_loa(spark.createDataFrame(items, schema).selectExpr("*", "first_day_of_leave effective_date", "1000 timestamp_unix"), "2024-01-01")
    employees = spark.createDataFrame([(1, "Ann")], "employee_id int, employee_name string")
    return E.dim_loa(staged, employees)


def dates(spark):
    return spark.sql(
        "select d full_date, if(weekday(d) < 5, 1, 0) day_is_weekday, if(d = date'2024-07-04', 1, 0) holiday_us_federal_reserve "
        "from (select explode(sequence(date'2024-06-01', date'2024-08-01')) d)"
    )


def test_leave_days(spark):
    loa = leave(
        spark,
        (1, D(2024, 7, 3), D(2024, 7, 31), D(2024, 7, 8)),  # actual end wins; holiday and weekend inside
        (2, D(2024, 7, 3), None, None),  # open
        (3, D(2024, 7, 9), D(2024, 7, 8), None),  # inverted
        (4, D(2024, 7, 9), D(2024, 7, 9), None),  # one day
    )
    got = E.expand_leave_days(loa, dates(spark))
    assert rows(got, "employee_id", "time_off_date") == [(1, D(2024, 7, 3)), (1, D(2024, 7, 5)), (1, D(2024, 7, 8)), (4, D(2024, 7, 9))]
    first = got.filter("employee_id = 4").first()
    assert (first["upi"], first["duration_hours"], first["employee_name"]) == ("4|2024-07-09|8.0", Decimal("8.00"), None)
    assert first["request_timestamp"] == dt.datetime(1970, 1, 1, 0, 16, 40)


def test_fact(spark):
    staged = E.stage_time_off(time_off(spark, ("1", "2024-07-01", "4.5", "Denied", "60")), None, "2024-07-01", loaded_at="2024-07-01")
    employees = spark.createDataFrame([(1, "Ann")], "employee_id int, employee_name string")
    to = E.dim_time_off(staged, employees)
    fact = E.fct_time_off_leave(to, leave(spark, (4, D(2024, 7, 9), D(2024, 7, 9), None)), dates(spark), "2024-07-02")
    assert fact.columns[:2] == ["emp_id", "emp_name"] and fact.count() == 2
    assert rows(fact, "emp_id", "type_of_time_off", "status") == [(1, None, "Denied"), (4, "LOA", "Approved")]


def test_ingest_stream_is_exactly_once(spark, tmp_path):
    schema = "`Employee ID` int, `Time Off Date` string, Duration string"

    def deliver(folder, *items):
        spark.createDataFrame(items, schema).write.option("header", "true").csv(str(tmp_path / "drops" / folder))

    def run():
        T.ingest_stream(spark, str(tmp_path / "drops"), "to", str(tmp_path / "table"), str(tmp_path / "cp"), None, 5).awaitTermination()
        return rows(T.ingested_table(spark, str(tmp_path / "table")), "Employee ID", "Status", "timestamp_unix")

    deliver("Time Off 20240101", (1, "2024-01-01", "8"))
    deliver("Leave of Absence 20240101", (9, "2024-01-01", "8"))
    assert run() == [("1", "Approved", 5)]
    assert run() == [("1", "Approved", 5)]
    deliver("Time  off 20240102", (2, "2024-01-02", "8"))
    assert run() == [("1", "Approved", 5), ("2", "Approved", 5)]


@pytest.mark.parametrize(("late", "expected"), [("drop", [(1, "newest"), (2, "old")]), ("upsert", [(1, "newest"), (2, "old"), (3, "late")])])
def test_merge_stream(spark, tmp_path, late, expected):
    source = str(tmp_path / "raw")

    def run():
        updates = spark.readStream.schema(TO).parquet(source)
        T.merge_stream(updates, str(tmp_path / "table"), str(tmp_path / "cp"), "upi", E.typed_time_off, late=late).awaitTermination()

    time_off(spark, ("1", "2024-06-01", "8", "old", "10"), ("2", "2024-06-01", "8", "old", "20")).write.mode("append").parquet(source)
    run()
    time_off(spark, ("1", "2024-06-01", "8", "newest", "31"), ("2", "2024-06-01", "8", "late", "15"), ("3", "2024-06-02", "8", "late", "20")).write.mode("append").parquet(source)
    run()
    run()
    assert rows(T.merged_table(spark, str(tmp_path / "table")), "employee_id", "status") == expected


def test_far_end_is_cut_to_the_calendar(spark):
    got = E.expand_leave_days(leave(spark, (1, D(2020, 1, 1), D(9999, 12, 31), None)), dates(spark))
    assert got.count() == 43  # working days of the calendar


def test_history_of_a_dimension(spark):
    first = E.typed_time_off(time_off(spark, ("1", "2024-06-01", "8", "old", "10"), (None, "2024-06-01", "8", "n", "1")), "2024-06-01")
    second = E.typed_time_off(time_off(spark, ("1", "2024-06-01", "8", "new", "20"), (None, "2024-06-01", "8", "n", "2")), "2024-06-02")
    employees = spark.createDataFrame([(1, "Ann")], "employee_id int, employee_name string")
    got = E.dim_time_off(first.union(second), employees, history=True)
    moment = dt.datetime(2024, 6, 2)
    assert rows(got.filter("employee_id = 1"), "status", "valid_to", "is_current") == [("new", None, True), ("old", moment, False)]
    assert got.filter("employee_id is null and is_current").count() == 2
