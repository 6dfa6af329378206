"""Inputs the registered queries derive from the given tables.

The tables hold no NULLs, versions, graphs or catalogs, so each input is a query over a
whole table that plants the differences an operator is meant to find. A text serves Spark
and the SQL check alike; where the dialects differ, both are given. Names in braces are
tables or other inputs.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from plumbline.sources.tables import TABLES, read_table

_DATES = (
    "SELECT d AS full_date, CAST({weekday} AS INT) AS day_is_weekday,\n"
    "  CASE WHEN {month_day} IN ('01-01', '07-04', '12-25') THEN 1 ELSE 0 END AS holiday_us_federal_reserve\n"
    "FROM ({days}) AS x"
)

SQL: dict[str, str | tuple[str, str]] = {
    "orders_old": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
          o_totalprice, o_orderdate, o_orderpriority FROM {orders}""",
    "orders_new": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
          CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          o_orderdate, o_orderpriority
        FROM {orders} WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
        UNION ALL
        SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    # a narrower, differently typed and renamed version for the schema side of comparisons
    "orders_reshaped": """
        SELECT o_orderkey, CAST(o_custkey AS INT) AS o_custkey, o_orderstatus, o_totalprice,
          CAST(o_orderdate AS DATE) AS order_day FROM {orders_new}""",
    "lines_old": "SELECT l_orderkey, l_quantity, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS l_returnflag FROM {lineitem}",
    "lines_new": """
        SELECT CASE WHEN l_linestatus = 'O' AND l_tax = 0.0 THEN NULL ELSE l_orderkey END AS l_orderkey,
          l_quantity + CASE WHEN l_discount = 0.0 THEN 1 ELSE 0 END AS l_quantity, l_returnflag
        FROM {lineitem} WHERE NOT (l_returnflag = 'R' AND l_discount > 0.05)""",
    "env_dev": "SELECT * FROM {orders} WHERE o_orderpriority <> '1-URGENT'",
    "env_test": "SELECT * FROM {orders} WHERE o_orderstatus <> 'P' OR o_orderpriority = '5-LOW'",
    "src_f": "SELECT * FROM {orders} WHERE o_orderstatus = 'F'",
    "src_o": "SELECT * FROM {orders} WHERE o_orderstatus = 'O'",
    "src_p": "SELECT * FROM {orders} WHERE o_orderstatus = 'P'",
    "cons_target": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM {orders}
        WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM') AND NOT (o_orderstatus = 'P' AND o_totalprice > 400000)""",
    "events_n": """
        SELECT event_id, ts, user_id, CASE WHEN event_id % 37 = 0 THEN NULL ELSE event_type END AS event_type,
          CASE WHEN event_id % 29 = 0 THEN NULL ELSE value END AS value,
          CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_id % 2 = 0 END AS flag FROM {events}""",
    "nodes": """
        SELECT p_partkey AS node_id, CONCAT('model_', p_partkey) AS model_name,
          CASE WHEN p_size = 9 THEN 'source' ELSE 'model' END AS resource_type,
          CONCAT('SELECT ', p_name, ' FROM t WHERE ', p_type) AS model_sql FROM {part}""",
    "edges": """
        SELECT CAST(FLOOR(p_partkey / 3) AS BIGINT) AS upstream_id, p_partkey AS downstream_id FROM {part} WHERE p_partkey >= 3
        UNION ALL
        SELECT CAST(FLOOR(p_partkey / 5) AS BIGINT), p_partkey FROM {part} WHERE p_partkey >= 5 AND p_type = 'ECONOMY'""",
    # walks start at every model that nothing depends on, or at every model of one type
    "leaf_models": """
        SELECT model_name FROM {nodes} AS n WHERE NOT EXISTS (SELECT 1 FROM {edges} AS e WHERE e.upstream_id = n.node_id)""",
    "large_models": "SELECT CONCAT('model_', p_partkey) AS model_name FROM {part} WHERE p_type = 'LARGE'",
    "catalog_old": """
        SELECT CONCAT('model_', CAST(FLOOR(p_partkey / 40) AS BIGINT)) AS model_name, CONCAT('c', p_partkey) AS column_name,
          p_type AS data_type, CAST(p_size AS BIGINT) AS char_len, p_size % 2 = 0 AS is_nullable, p_partkey AS ordinal
        FROM {part} WHERE p_name <> 'red widget'""",
    "catalog_new": """
        SELECT CONCAT('model_', CAST(FLOOR(p_partkey / 40) AS BIGINT)) AS model_name, CONCAT('c', p_partkey) AS column_name,
          CASE WHEN p_size = 13 THEN 'TEXT' ELSE p_type END AS data_type,
          CASE WHEN p_size = 21 THEN NULL ELSE CAST(p_size AS BIGINT) END AS char_len,
          CASE WHEN p_size = 17 THEN p_size % 2 <> 0 ELSE p_size % 2 = 0 END AS is_nullable, p_partkey AS ordinal
        FROM {part} WHERE p_name <> 'blue gear'""",
    "schema_history": """
        SELECT CONCAT('m', CAST(FLOOR(p_partkey / 40) AS BIGINT)) AS model_name, v AS version_no,
          CONCAT('c', p_partkey) AS column_name,
          CASE WHEN p_partkey % 101 = 0 AND v >= 3 THEN 'TEXT' ELSE p_type END AS data_type,
          (p_partkey % 97 = 0 AND v >= 2) AS is_nullable, p_partkey AS ordinal
        FROM (SELECT *, {versions} AS v FROM {part}) AS p
        WHERE NOT (p_name = 'red widget' AND v = 4 AND p_size > 40) AND NOT (p_name = 'blue gear' AND v = 1 AND p_size > 40)""",
    "relation_rows": """
        SELECT CONCAT('model_', l_partkey) AS model_name, COUNT(*) AS row_count FROM {lineitem} GROUP BY l_partkey""",
    "model_columns": """
        SELECT DISTINCT CONCAT('model_', l_partkey) AS model_name,
          CASE WHEN l_linenumber = 1 THEN CONCAT('pk_', l_suppkey) WHEN l_linenumber < 4 THEN CONCAT('s', l_suppkey, '_id')
               ELSE CONCAT('c', l_suppkey) END AS column_name FROM {lineitem}""",
    "audit": "SELECT CONCAT('model_', user_id) AS model_name, ts AS created_at, value AS execution_time FROM {events}",
    "test_results": """
        SELECT CONCAT('model_', user_id) AS model_name, ts AS created_at,
          CASE WHEN event_type = 'error' THEN 'fail' ELSE 'pass' END AS status FROM {events}""",
    "model_files": """
        SELECT CONCAT('models/', p_brand, '/model_', p_partkey, CASE WHEN p_size = 50 THEN '.md' ELSE '.sql' END) AS file_path,
          CASE WHEN p_size = 49 THEN NULL ELSE CONCAT('select * from {{{{ ref(''model_', CAST(FLOOR(p_partkey / 3) AS BIGINT),
            ''') }}}} join {{{{ REF("Model_', CAST(FLOOR(p_partkey / 5) AS BIGINT), '") }}}}') END AS file_content FROM {part}""",
    "inventory": """
        SELECT p_brand AS schema_name, CONCAT('t', p_partkey) AS ref_name, 'table' AS ref_type FROM {part}
        UNION ALL SELECT c_mktsegment, CONCAT('v', c_custkey), 'view' FROM {customer}""",
    "expected": """
        SELECT p_brand AS schema_name, CONCAT('t', p_partkey) AS ref_name FROM {part} WHERE p_size <> 7
        UNION ALL SELECT c_mktsegment, CONCAT('v', c_custkey) FROM {customer}
          WHERE c_nationkey <> 3 AND c_mktsegment <> 'MACHINERY'""",
    "drop_files": """
        SELECT doc_id, CONCAT('Export  ', CASE WHEN lang = 'en' THEN 'Leave of Absence' WHEN lang = 'de' THEN 'Time  Off'
            WHEN lang = 'fr' THEN 'TIME OFF' ELSE 'Roster' END, ' 2025', CASE WHEN doc_id % 10 = 0 THEN '99' ELSE '03' END,
            CASE WHEN doc_id % 4 = 0 THEN '12' ELSE '28' END, ' 07_00 ', source,
            CASE WHEN n_chars % 7 = 0 THEN '.pdf' WHEN n_chars % 7 = 1 THEN '.xls' ELSE '.xlsx' END) AS file_name FROM {documents}""",
    "employee": "SELECT c_custkey AS employee_id, c_name AS preferred_name FROM {customer} WHERE c_nationkey <> 4",
    "raw_time_off": """
        SELECT CAST(user_id AS {text}) AS employee_id, CAST(event_id AS {text}) AS timestamp_request_was_made,
          event_type AS type, CAST(CAST(ts AS DATE) AS {text}) AS time_off_date,
          CASE WHEN event_id % 2 = 0 THEN '8' ELSE '4.5' END AS duration, 'Hours' AS unit_of_time,
          CASE WHEN event_type = 'error' THEN 'Denied' ELSE 'Approved' END AS status,
          CAST(1700000000 + event_id AS {text}) AS timestamp_unix FROM {events}""",
    "raw_leave": (
        """
        SELECT o_custkey AS employee_id, CAST(o_orderdate AS DATE) AS effective_date, CAST(o_orderdate AS DATE) AS first_day_of_leave,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 15 AS INT) - 1) END AS last_day_leave_estimated,
          CASE WHEN o_orderkey % 4 = 1 THEN date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 9 AS INT)) END AS last_day_leave_actual,
          1600000000 + o_orderkey AS timestamp_unix FROM {orders}""",
        """
        SELECT o_custkey AS employee_id, CAST(o_orderdate AS DATE) AS effective_date, CAST(o_orderdate AS DATE) AS first_day_of_leave,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + (CAST(o_orderkey % 15 AS INT) - 1) END AS last_day_leave_estimated,
          CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INT) END AS last_day_leave_actual,
          1600000000 + o_orderkey AS timestamp_unix FROM {orders}""",
    ),
    # the calendar from the first order to three weeks past the last one
    "date_dim": (
        _DATES.format(
            weekday="CASE WHEN weekday(d) < 5 THEN 1 ELSE 0 END",
            month_day="date_format(d, 'MM-dd')",
            days="SELECT explode(sequence(CAST(MIN(o_orderdate) AS DATE), date_add(CAST(MAX(o_orderdate) AS DATE), 21))) AS d FROM {{orders}}",
        ).replace("{{orders}}", "{orders}"),
        _DATES.format(
            weekday="CASE WHEN isodow(d) <= 5 THEN 1 ELSE 0 END",
            month_day="strftime(d, '%m-%d')",
            days="SELECT CAST(unnest(generate_series(CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE) + 21, INTERVAL 1 DAY)) AS DATE) AS d FROM {{orders}}",
        ).replace("{{orders}}", "{orders}"),
    ),
}

_SPARK_WORDS = {"{text}": "STRING", "{versions}": "explode(array(1, 2, 3, 4))"}
_DUCK_WORDS = {"{text}": "VARCHAR", "{versions}": "unnest([1, 2, 3, 4])"}
_NAME = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def _text(name: str, duck: bool) -> str:
    text = SQL[name]
    text = text[duck] if isinstance(text, tuple) else text
    words = _DUCK_WORDS if duck else _SPARK_WORDS
    for mark, word in words.items():
        text = text.replace(mark, word)
    return text.strip()


def frame(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A table or derived input as a DataFrame; ``known`` keeps what was already resolved."""
    known = {} if known is None else known
    if name not in known:
        if name in TABLES:
            known[name] = read_table(spark, sf_dir, name)
        else:
            text = _text(name, False)
            inputs = {n: frame(spark, sf_dir, n, known) for n in dict.fromkeys(_NAME.findall(text))}
            known[name] = spark.sql(text, **inputs)
    return known[name]


@cache
def _needed(name: str) -> tuple[str, ...]:
    if name not in SQL:
        return ()
    found: dict[str, None] = {}
    for inner in _NAME.findall(_text(name, True)):
        for needed in _needed(inner):
            found[needed] = None
    found[name] = None
    return tuple(found)


def oracle(body: str) -> str:
    """SQL for the check: ``{input}`` names in the body become common table expressions."""
    needed: dict[str, None] = {}
    for name in _NAME.findall(body):
        needed.update(dict.fromkeys(_needed(name)))

    def plain(text: str) -> str:
        return _NAME.sub(r"\1", text).replace("{{", "{").replace("}}", "}")

    body = plain(body.strip())
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({plain(_text(n, True))})" for n in needed)
    keyword = "WITH RECURSIVE" if body.startswith("WITH RECURSIVE") else "WITH"
    rest = re.sub(r"^WITH( RECURSIVE)?\s+", "", body)
    separator = ",\n" if rest != body else "\n"
    return f"{keyword} {ctes}{separator}{rest}"
