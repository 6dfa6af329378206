"""Registered queries: profiles, summaries, distributions, duplicates, drift."""

from __future__ import annotations

from plumbline.operators import drift, profile
from plumbline.plans.registry import Inputs, query


def _number(x: str, digits: int = 4) -> str:
    return f"CAST(CAST(ROUND(CAST({x} AS DOUBLE), {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"


def _text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _metrics(c: str, kind: str, integral: bool, source: str) -> str:
    share = "ROUND(CAST({} AS DOUBLE) * 100 / NULLIF({}, 0), 2)"
    rows = {
        "count": _text(f"COUNT({c})"),
        "null_count": _text(f"COUNT(*) - COUNT({c})"),
        "null_pct": _number(share.format(f"(COUNT(*) - COUNT({c}))", "COUNT(*)"), 2),
    }
    if kind != "boolean":
        rows["distinct_values"] = _text(f"COUNT(DISTINCT {c})")
    if kind == "numeric":
        exact = _text if integral else _number
        rows |= {"min": exact(f"MIN({c})"), "max": exact(f"MAX({c})")}
        rows |= {"avg": _number(f"AVG({c})"), "stddev": _number(f"STDDEV_SAMP({c})")}
        for name, p in profile.PERCENTILES.items():
            rows[name] = _number(f"quantile_cont(CAST({c} AS DOUBLE), {p})")
    elif kind == "string":
        rows |= {"min_length": _text(f"MIN(LENGTH({c}))"), "max_length": _text(f"MAX(LENGTH({c}))")}
        rows["avg_length"] = _number(f"AVG(LENGTH({c}))")
    elif kind == "date":
        rows |= {"min_date": _text(f"MIN({c})"), "max_date": _text(f"MAX({c})")}
        rows["date_range_days"] = _text(f"DATEDIFF('day', MIN({c}), MAX({c}))")
    elif kind == "boolean":
        for word in ("true", "false"):
            n = f"COUNT(*) FILTER (WHERE {c} = {word})"
            rows |= {f"{word}_count": _text(n), f"{word}_pct": _number(share.format(n, f"COUNT({c})"), 2)}
    parts = [
        f"SELECT '{kind}' AS data_type, '{c}' AS column_name, '{m}' AS metric, {v} AS metric_value FROM {source}"
        for m, v in rows.items()
    ]
    if kind == "string":
        parts.append(
            f"SELECT 'string', '{c}', 'top_5_values', string_agg(v || ' (' || n || ')', ', ' ORDER BY n DESC, v) FROM "
            f"(SELECT {c} AS v, COUNT(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, v LIMIT 5)"
        )
    return " UNION ALL ".join(parts)


_EVENTS = {
    "event_id": ("numeric", True),
    "ts": ("date", False),
    "user_id": ("numeric", True),
    "event_type": ("string", False),
    "value": ("numeric", False),
    "flag": ("boolean", False),
}


def _profile(columns, source: str = "{events_n}") -> str:
    return " UNION ALL ".join(_metrics(c, *_EVENTS[c], source) for c in columns)


@query("profile_dataset", _profile(_EVENTS))
def _(t: Inputs):
    return profile.profile_dataset(t.events_n)


@query("profile_dataset_numeric", _profile(["event_id", "user_id", "value"]))
def _(t: Inputs):
    return profile.profile_dataset(t.events_n, ["event_id", "user_id", "value"])


_LINE_TEXTS = ["l_returnflag", "l_linestatus"]


@query(
    "profile_dataset_string",
    " UNION ALL ".join(_metrics(c, "string", False, "{lineitem}") for c in _LINE_TEXTS)
    + " UNION ALL "
    + _metrics("text", "string", False, "{documents}"),
)
def _(t: Inputs):
    return profile.profile_dataset(t.lineitem, _LINE_TEXTS).unionByName(profile.profile_dataset(t.documents, ["text"]))


@query("profile_dataset_date", _profile(["ts"]) + " UNION ALL " + _metrics("l_shipdate", "date", False, "{lineitem}"))
def _(t: Inputs):
    return profile.profile_dataset(t.events_n, ["ts"]).unionByName(profile.profile_dataset(t.lineitem, ["l_shipdate"]))


@query("profile_dataset_boolean", _profile(["flag"]))
def _(t: Inputs):
    return profile.profile_dataset(t.events_n, ["flag"])


@query(
    "profile_dataset_sample",
    "WITH chosen AS (SELECT * FROM {events_n} ORDER BY md5(CAST(event_id AS VARCHAR)) LIMIT 2000) SELECT * FROM ("
    + _profile(["value", "event_type", "flag"], "chosen")
    + ")",
)
def _(t: Inputs):
    return profile.profile_dataset(t.events_n, ["value", "event_type", "flag"], sample_size=2000, sample_by="event_id")


def _profiled(c: str, kind: str) -> str:
    def only(wanted: str, expression: str, dtype: str) -> str:
        return f"CAST({expression if kind == wanted else 'NULL'} AS {dtype})"

    return f"""SELECT '{c}' AS column_name, '{kind}' AS data_type, COUNT({c}) AS non_null_count, COUNT(*) - COUNT({c}) AS null_count,
      ROUND(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100 / NULLIF(COUNT(*), 0), 4) AS null_percentage,
      ROUND({only("numeric", f"MIN({c})", "DOUBLE")}, 4) AS min_value, ROUND({only("numeric", f"MAX({c})", "DOUBLE")}, 4) AS max_value,
      ROUND({only("numeric", f"AVG({c})", "DOUBLE")}, 4) AS avg_value,
      ROUND({only("numeric", f"quantile_cont({c}, 0.5)", "DOUBLE")}, 4) AS median_value,
      {only("string", f"MIN(LENGTH({c}))", "BIGINT")} AS min_length, {only("string", f"MAX(LENGTH({c}))", "BIGINT")} AS max_length,
      ROUND({only("string", f"AVG(LENGTH({c}))", "DOUBLE")}, 4) AS avg_length, {only("string", f"COUNT(DISTINCT {c})", "BIGINT")} AS distinct_values,
      {only("date", f"MIN({c})", "TIMESTAMP")} AS min_date, {only("date", f"MAX({c})", "TIMESTAMP")} AS max_date,
      {only("date", f"DATEDIFF('day', MIN({c}), MAX({c}))", "BIGINT")} AS date_range_days FROM {{events_n}}"""


@query(
    "profile_columns",
    " UNION ALL ".join(_profiled(c, k) for c, k in (("value", "numeric"), ("event_type", "string"), ("ts", "date"), ("flag", "flag"))),
)
def _(t: Inputs):
    return profile.profile_columns(t.events_n, ["value:numeric", "event_type:string", "ts:date", "flag:flag"])


def _summary(c: str, integral: bool) -> str:
    low, high = (f"MIN({c})", f"MAX({c})") if integral else (f"ROUND(MIN({c}), 4)", f"ROUND(MAX({c}), 4)")
    return f"""{low} AS {c}_min, {high} AS {c}_max, ROUND(AVG({c}), 4) AS {c}_avg,
      ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS {c}_median, COUNT({c}) AS {c}_count, COUNT(*) - COUNT({c}) AS {c}_null_count,
      ROUND(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100 / COUNT(*), 4) AS {c}_null_percentage"""


@query(
    "summarize",
    "SELECT 'events' AS model_name, COUNT(*) AS total_rows, "
    + ", ".join(_summary(c, i) for c, i in (("event_id", True), ("user_id", True), ("value", False)))
    + " FROM {events_n}",
)
def _(t: Inputs):
    return profile.summarize(t.events_n, "events")


@query(
    "summarize_grouped",
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS total_rows, "
    + ", ".join(_summary(c, i) for c, i in (("l_quantity", False), ("l_extendedprice", False), ("l_linenumber", True)))
    + " FROM {lineitem} GROUP BY ALL",
)
def _(t: Inputs):
    measured = ["l_quantity", "l_extendedprice", "l_linenumber"]
    return profile.summarize(t.lineitem, "lineitem", ["l_returnflag", "l_linestatus"], measured)


@query(
    "analyze_nulls",
    " UNION ALL ".join(
        f"SELECT 'events' AS model_name, COUNT(*) AS total_rows, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
        f"ROUND(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100 / NULLIF(COUNT(*), 0), 4) AS null_percentage FROM {{events_n}}"
        for c in _EVENTS
    ),
)
def _(t: Inputs):
    return profile.analyze_nulls(t.events_n, "events")


def _distribution(source: str, c: str, part: str, label: str) -> str:
    return f"""WITH buckets AS (SELECT CAST(DATE_TRUNC('{part}', {c}) AS TIMESTAMP) AS b, COUNT(*) AS n FROM {{{source}}} WHERE {c} IS NOT NULL GROUP BY 1)
    SELECT '{source}' AS model_name, '{c}' AS date_column, '{part}' AS date_granularity, MIN(b) AS min_date, MAX(b) AS max_date,
      COUNT(*) AS unique_periods, CAST(SUM(n) AS BIGINT) AS total_records, MIN(n) AS min_period_count, MAX(n) AS max_period_count,
      ROUND(AVG(n), 4) AS avg_period_count FROM buckets
    UNION ALL SELECT '{source}', '{c}', {label}, NULL, NULL, NULL, n, NULL, NULL, NULL FROM buckets"""


@query("date_distribution", _distribution("lineitem", "l_shipdate", "month", "strftime(b, '%Y-%m')"))
def _(t: Inputs):
    return profile.date_distribution(t.lineitem, "lineitem", "l_shipdate")


@query("date_distribution_day", _distribution("events", "ts", "day", "strftime(b, '%Y-%m-%d')"))
def _(t: Inputs):
    return profile.date_distribution(t.events, "events", "ts", "day")


@query("date_distribution_quarter", _distribution("orders", "o_orderdate", "quarter", "strftime(b, '%Y-') || quarter(b)"))
def _(t: Inputs):
    return profile.date_distribution(t.orders, "orders", "o_orderdate", "quarter")


@query("date_distribution_year", _distribution("orders", "o_orderdate", "year", "strftime(b, '%Y')"))
def _(t: Inputs):
    return profile.date_distribution(t.orders, "orders", "o_orderdate", "year")


@query(
    "aggregate_measure",
    """SELECT l_returnflag, COUNT(*) AS row_count, ROUND(SUM(l_extendedprice), 4) AS sum_value, ROUND(AVG(l_extendedprice), 4) AS avg_value,
      ROUND(MIN(l_extendedprice), 4) AS min_value, ROUND(MAX(l_extendedprice), 4) AS max_value, ROUND(STDDEV_SAMP(l_extendedprice), 4) AS stddev_value,
      COUNT(DISTINCT l_extendedprice) AS distinct_count, ROUND(quantile_cont(l_extendedprice, 0.5), 4) AS median_value,
      COUNT(*) - COUNT(l_extendedprice) AS null_count, CAST(0 AS DOUBLE) AS null_percentage FROM {lineitem} GROUP BY l_returnflag""",
)
def _(t: Inputs):
    wanted = ["sum", "avg", "min", "max", "stddev", "count_distinct", "median", "count"]
    return profile.aggregate_measure(t.lineitem, "l_returnflag", "l_extendedprice", wanted)


_GROUPS = "(SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM {lineitem} GROUP BY ALL HAVING COUNT(*) > 1)"


@query(
    "find_duplicates",
    f"""SELECT 'lineitem' AS model_name, 'l_orderkey, l_linenumber' AS key_columns, COUNT(*) AS duplicate_key_count,
      CAST(SUM(n) AS BIGINT) AS total_duplicate_rows, MAX(n) AS max_occurrences FROM {_GROUPS}""",
)
def _(t: Inputs):
    return profile.find_duplicates(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_examples",
    f"""SELECT l_orderkey || '|' || l_linenumber AS key_columns, n AS duplicate_key_count FROM {_GROUPS}
      ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 10""",
)
def _(t: Inputs):
    return profile.duplicate_examples(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "incremental_counts",
    """WITH m AS (SELECT MAX(ts) AS newest FROM {events}), back AS (SELECT newest - i * INTERVAL 1 DAY AS load_date FROM m, generate_series(0, 6) AS s(i))
    SELECT 'events' AS model_name, load_date, (SELECT COUNT(*) FROM {events} WHERE ts <= load_date) AS record_count FROM back""",
)
def _(t: Inputs):
    return profile.incremental_counts(t.events, "events", "ts")


# ---------------------------------------------------------------- drift

_AS_OF, _SPLIT, _START = "2024-01-31", "TIMESTAMP '2024-01-21'", "TIMESTAMP '2024-01-11'"


def _relative(r: str, c: str) -> str:
    return f"ROUND(ABS(CAST({r} AS DOUBLE) - {c}) / NULLIF(CAST({c} AS DOUBLE), 0) * 100, 2)"


def _drift_rows(numbers, texts) -> str:
    parts = []
    shown = "SELECT '{c}' AS column_name, '{k}' AS data_type, '{m}' AS metric, {r} AS recent_value, {b} AS comparison_value, {p} AS pct_change FROM {s}"
    for c in [*numbers, *texts]:
        kind = "numeric" if c in numbers else "categorical"
        side = (
            f"(SELECT AVG({c}) AS avg, STDDEV_SAMP({c}) AS stddev, COUNT(DISTINCT {c}) AS d, "
            f"(COUNT(*) - COUNT({c})) * CAST(100 AS DOUBLE) / NULLIF(COUNT(*), 0) AS null_rate FROM {{events_n}} WHERE {{w}})"
            if c in numbers
            else f"(SELECT COUNT(DISTINCT {c}) AS d, (COUNT(*) - COUNT({c})) * CAST(100 AS DOUBLE) / NULLIF(COUNT(*), 0) AS null_rate, "
            f"(SELECT {c} FROM {{events_n}} WHERE {{w}} AND {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS top FROM {{events_n}} WHERE {{w}})"
        )
        both = (
            side.replace("{w}", f"ts >= {_SPLIT}")
            + " r CROSS JOIN "
            + side.replace("{w}", f"ts >= {_START} AND ts < {_SPLIT}")
            + " c"
        )
        if c in numbers:
            for m in ("avg", "stddev"):
                parts.append(shown.format(c=c, k=kind, m=m, r=_number(f"r.{m}", 2), b=_number(f"c.{m}", 2), p=_relative(f"r.{m}", f"c.{m}"), s=both))
        else:
            parts.append(shown.format(c=c, k=kind, m="distinct_count", r=_text("r.d"), b=_text("c.d"), p=_relative("r.d", "c.d"), s=both))
            parts.append(shown.format(c=c, k=kind, m="top_category_change", r="r.top", b="c.top", p="CASE WHEN r.top = c.top THEN 0 ELSE 100 END", s=both))
        parts.append(shown.format(c=c, k=kind, m="null_rate", r=_number("r.null_rate", 2), b=_number("c.null_rate", 2), p="ABS(r.null_rate - c.null_rate)", s=both))
    return (
        "SELECT column_name, data_type, metric, recent_value, comparison_value, ROUND(CAST(pct_change AS DOUBLE), 4) AS pct_change, "
        "CASE WHEN pct_change > 50 THEN 'High' WHEN pct_change > 20 THEN 'Medium' WHEN pct_change > 5 THEN 'Low' ELSE 'Normal' END AS drift_severity FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


_NUMBERS, _TEXTS = ["event_id", "user_id", "value"], ["event_type"]


@query("detect_drift", f"SELECT * FROM ({_drift_rows(_NUMBERS, _TEXTS)}) WHERE drift_severity <> 'Normal'")
def _(t: Inputs):
    return drift.detect_drift(t.events_n, "ts", "10 day", "10 day", _AS_OF)


@query("detect_drift_numeric", _drift_rows(_NUMBERS, []))
def _(t: Inputs):
    return drift.detect_drift(t.events_n, "ts", "10 day", "10 day", _AS_OF, columns=_NUMBERS, only_drifted=False)


@query("detect_drift_categorical", _drift_rows([], _TEXTS))
def _(t: Inputs):
    return drift.detect_drift(t.events_n, "ts", "10 day", "10 day", _AS_OF, columns=_TEXTS, only_drifted=False)
