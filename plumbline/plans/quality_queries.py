"""Registered queries: checks, suggestions, model health, schema history."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import quality, schema_history
from plumbline.plans.registry import Inputs, query

_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "flag"]


@query(
    "check_not_null",
    " UNION ALL ".join(
        f"SELECT 'not_null' AS check_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_failing FROM {{events_n}}" for c in _COLUMNS
    ),
)
def _(t: Inputs):
    return quality.check_not_null(t.events_n, _COLUMNS)


@query(
    "check_unique",
    " UNION ALL ".join(
        f"SELECT 'unique' AS check_name, '{c}' AS column_name, COUNT(*) AS n_failing FROM "
        f"(SELECT {c} FROM {{events_n}} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
        for c in _COLUMNS
    ),
)
def _(t: Inputs):
    return quality.check_unique(t.events_n, _COLUMNS)


@query(
    "check_unique_combination",
    """SELECT 'unique_combination' AS check_name, 'l_orderkey, l_linenumber' AS column_name, COUNT(*) AS n_failing
    FROM (SELECT 1 FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)""",
)
def _(t: Inputs):
    return quality.check_unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "check_relationship",
    """SELECT 'relationship' AS check_name, 'o_custkey' AS column_name, COUNT(*) AS n_failing, COUNT(DISTINCT o_custkey) AS n_failing_values
    FROM {orders} o WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {employee} e WHERE e.employee_id = o.o_custkey)""",
)
def _(t: Inputs):
    return quality.check_relationship(t.orders, "o_custkey", t.employee, "employee_id")


@query(
    "check_accepted_values",
    """SELECT 'accepted_values' AS check_name, 'event_type' AS column_name, event_type AS value, COUNT(*) AS n_failing
    FROM {events_n} WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY event_type""",
)
def _(t: Inputs):
    return quality.check_accepted_values(t.events_n, "event_type", ["click", "view", "purchase"])


def _suggested() -> str:
    parts = []
    for c in _COLUMNS:
        parts.append(f"SELECT '{c}' AS column_name, 'not_null' AS check_name, NULL AS args, COUNT(*) - COUNT({c}) AS n_failing FROM {{events_n}}")
    parts.append(
        "SELECT 'event_id', 'unique', NULL, COUNT(*) FROM (SELECT event_id FROM {events_n} WHERE event_id IS NOT NULL GROUP BY event_id HAVING COUNT(*) > 1)"
    )
    for c in ("event_id", "user_id"):
        parts.append(f"SELECT '{c}', 'relationships', '{c.replace('_id', '')}.id', NULL")
    for c, shown in (("event_type", "v"), ("flag", "CAST(v AS VARCHAR)")):
        parts.append(
            f"SELECT '{c}', 'accepted_values', string_agg({shown}, ', ' ORDER BY v), 0 FROM (SELECT DISTINCT {c} AS v FROM {{events_n}} WHERE {c} IS NOT NULL) HAVING COUNT(*) BETWEEN 1 AND 9"
        )
    return " UNION ALL ".join(parts)


@query("suggest_checks", _suggested())
def _(t: Inputs):
    return quality.suggest_checks(t.events_n)


_REPORT = "TIMESTAMP '2024-02-10 00:00:00'"


@query(
    "model_health",
    f"""WITH up AS (SELECT downstream_id AS id, COUNT(*) AS n FROM {{edges}} e WHERE EXISTS (SELECT 1 FROM {{nodes}} x WHERE x.node_id = e.upstream_id) GROUP BY 1),
    down AS (SELECT upstream_id AS id, COUNT(*) AS n FROM {{edges}} e WHERE EXISTS (SELECT 1 FROM {{nodes}} x WHERE x.node_id = e.downstream_id) GROUP BY 1),
    cols AS (SELECT model_name, COUNT(*) AS n, COUNT(*) FILTER (WHERE starts_with(column_name, 'pk_') OR ends_with(column_name, '_id')) AS k FROM {{model_columns}} GROUP BY 1),
    runs AS (SELECT model_name, MAX(created_at) AS last_run, AVG(execution_time) AS a, MAX(execution_time) AS m FROM {{audit}} WHERE created_at >= {_REPORT} - INTERVAL 30 DAY GROUP BY 1),
    tests AS (SELECT model_name, COUNT(*) AS n, COUNT(*) FILTER (WHERE status = 'fail') AS f FROM {{test_results}} WHERE created_at >= {_REPORT} - INTERVAL 30 DAY GROUP BY 1)
    SELECT n.model_name, COALESCE(up.n, 0) AS upstream_dependencies, COALESCE(down.n, 0) AS downstream_dependencies, r.row_count,
      cols.n AS column_count, cols.k AS key_column_count, runs.last_run, ROUND(runs.a, 4) AS avg_execution_time, ROUND(runs.m, 4) AS max_execution_time,
      COALESCE(tests.n, 0) AS total_tests, COALESCE(tests.f, 0) AS failed_tests, {_REPORT} AS report_generated_at
    FROM {{nodes}} n LEFT JOIN up ON up.id = n.node_id LEFT JOIN down ON down.id = n.node_id LEFT JOIN {{relation_rows}} r ON r.model_name = n.model_name
      LEFT JOIN cols ON cols.model_name = n.model_name LEFT JOIN runs ON runs.model_name = n.model_name LEFT JOIN tests ON tests.model_name = n.model_name""",
)
def _(t: Inputs):
    return quality.model_health(
        t.nodes, t.edges, t.audit, t.test_results, t.relation_rows, t.model_columns, "2024-02-10 00:00:00"
    )


# ---------------------------------------------------------------- schema history


def _catalogued(model: str, columns) -> str:
    parts = []
    for i, (c, dtype) in enumerate(columns, 1):
        length = f"CAST(MAX(LENGTH({c})) AS BIGINT)" if dtype == "string" else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{model}' AS model_name, '{c}' AS column_name, '{dtype}' AS data_type, {length} AS char_len, "
            f"COUNT({c}) < COUNT(*) AS is_nullable, CAST({i} AS BIGINT) AS ordinal FROM {{{model}}}"
        )
    return " UNION ALL ".join(parts)


_ORDERS_NEW = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]
_DOCUMENTS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]


@query("column_catalog", _catalogued("orders_new", _ORDERS_NEW) + " UNION ALL " + _catalogued("documents", _DOCUMENTS))
def _(t: Inputs):
    return schema_history.column_catalog({"orders_new": t.orders_new, "documents": t.documents}, measure=True)


def _diff(columns) -> str:
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in columns)
    shown = ", ".join(f"o.{c} AS old_{c}, n.{c} AS new_{c}" for c in columns)
    return f"""SELECT * FROM (SELECT COALESCE(o.model_name, n.model_name) AS model_name, COALESCE(o.column_name, n.column_name) AS column_name,
      CASE WHEN o.column_name IS NULL THEN 'added' WHEN n.column_name IS NULL THEN 'removed' WHEN {differs} THEN 'changed' END AS change, {shown}
      FROM {{catalog_old}} o FULL JOIN {{catalog_new}} n ON o.model_name = n.model_name AND o.column_name = n.column_name) WHERE change IS NOT NULL"""


@query("schema_diff", _diff(["data_type", "char_len", "is_nullable"]))
def _(t: Inputs):
    return schema_history.schema_diff(t.catalog_old, t.catalog_new)


@query("migration_columns", _diff(["data_type", "is_nullable"]))
def _(t: Inputs):
    return schema_history.migration_columns(t.catalog_old, t.catalog_new)


@query(
    "schema_diff_types",
    """SELECT COALESCE(o.model_name, n.model_name) AS model_name,
      COUNT(*) FILTER (WHERE o.data_type = n.data_type) AS common_columns, COUNT(*) FILTER (WHERE o.column_name IS NULL) AS added_columns,
      COUNT(*) FILTER (WHERE n.column_name IS NULL) AS removed_columns, COUNT(*) FILTER (WHERE o.data_type <> n.data_type) AS type_changes
    FROM {catalog_old} o FULL JOIN (SELECT model_name, UPPER(column_name) AS column_name, data_type FROM {catalog_new}) n
      ON o.model_name = n.model_name AND LOWER(o.column_name) = LOWER(n.column_name) GROUP BY 1""",
)
def _(t: Inputs):
    upper = t.catalog_new.withColumn("column_name", F.upper("column_name"))
    return schema_history.schema_diff_types(t.catalog_old, upper, ignore_case=True)


_HASH = """md5('[' || string_agg('"' || column_name || ':' || data_type || '"', ',' ORDER BY ordinal) || ']')"""


@query(
    "schema_snapshot",
    f"""SELECT model_name, DATE '2024-02-01' AS snapshot_date, r.row_count, column_count, hash_value
    FROM (SELECT model_name, COUNT(*) AS column_count, {_HASH} AS hash_value FROM {{catalog_new}} GROUP BY model_name) c
    LEFT JOIN {{relation_rows}} r USING (model_name)""",
)
def _(t: Inputs):
    return schema_history.schema_snapshot(t.catalog_new, t.relation_rows, "2024-02-01")


_CONTENT = " || '|' || ".join(
    f"COALESCE(LENGTH(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in ("doc_id", "text", "lang", "source", "n_chars")
)


@query(
    "content_hash",
    f"""SELECT COUNT(*) AS row_count, CAST(COALESCE(SUM(CAST('0x' || SUBSTR(md5({_CONTENT}), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS content_hash
    FROM {{documents}}""",
)
def _(t: Inputs):
    return schema_history.content_hash(t.documents, ["doc_id", "text", "lang", "source", "n_chars"])


@query(
    "schema_change_log",
    f"""SELECT * FROM (SELECT model_name, version_no, LAG(hash_value) OVER w AS previous_hash, hash_value,
      LAG(column_count) OVER w AS previous_column_count, column_count
      FROM (SELECT model_name, version_no, COUNT(*) AS column_count, {_HASH} AS hash_value FROM {{schema_history}} GROUP BY 1, 2)
      WINDOW w AS (PARTITION BY model_name ORDER BY version_no)) WHERE previous_hash <> hash_value""",
)
def _(t: Inputs):
    history = schema_history.schema_snapshot(t.schema_history, None, "2024-02-01", by=("model_name", "version_no"))
    return schema_history.schema_change_log(history, "version_no")


@query(
    "semantic_version",
    """WITH pairs AS (SELECT COALESCE(n.model_name, o.model_name) AS model_name, COALESCE(n.version_no, o.version_no + 1) AS v,
        CASE WHEN n.column_name IS NULL THEN 2 WHEN o.column_name IS NULL THEN 1 WHEN n.data_type <> o.data_type THEN 2
             WHEN o.is_nullable AND NOT n.is_nullable THEN 2 WHEN n.is_nullable AND NOT o.is_nullable THEN 1 ELSE 0 END AS bump
      FROM {schema_history} n FULL JOIN {schema_history} o
        ON o.model_name = n.model_name AND o.version_no = n.version_no - 1 AND o.column_name = n.column_name),
    graded AS (SELECT model_name, v, CASE WHEN v = MIN(v) OVER (PARTITION BY model_name) THEN 'first'
        WHEN b = 2 THEN 'major' WHEN b = 1 THEN 'minor' ELSE 'patch' END AS bump_kind
      FROM (SELECT model_name, v, MAX(bump) AS b FROM pairs GROUP BY 1, 2) WHERE (model_name, v) IN (SELECT model_name, version_no FROM {schema_history})),
    a AS (SELECT *, 1 + COUNT(*) FILTER (WHERE bump_kind = 'major') OVER (PARTITION BY model_name ORDER BY v) AS major FROM graded),
    b AS (SELECT *, COUNT(*) FILTER (WHERE bump_kind = 'minor') OVER (PARTITION BY model_name, major ORDER BY v) AS minor FROM a)
    SELECT model_name, v AS version_no, bump_kind, major || '.' || minor || '.' ||
      COUNT(*) FILTER (WHERE bump_kind = 'patch') OVER (PARTITION BY model_name, major, minor ORDER BY v) AS version FROM b""",
)
def _(t: Inputs):
    return schema_history.semantic_version(t.schema_history)


@query(
    "migration_impact",
    f"""WITH RECURSIVE changed AS (SELECT model_name, MAX(CASE change WHEN 'removed' THEN 3 WHEN 'changed' THEN 2 ELSE 1 END) AS s
      FROM ({_diff(["data_type", "is_nullable"])}) GROUP BY 1),
    walk AS (SELECT n.model_name AS changed_model, n.node_id, n.model_name AS name, CAST(NULL AS VARCHAR) AS referenced_by, 0 AS depth
        FROM {{nodes}} n JOIN changed USING (model_name)
      UNION SELECT w.changed_model, n.node_id, n.model_name, w.name, w.depth + 1 FROM walk w
        JOIN {{edges}} e ON e.upstream_id = w.node_id JOIN {{nodes}} n ON n.node_id = e.downstream_id WHERE n.resource_type = 'model')
    SELECT DISTINCT changed_model, name, referenced_by, depth, CASE s WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' ELSE 'Low' END AS risk
    FROM walk JOIN changed ON changed.model_name = changed_model WHERE depth > 0""",
)
def _(t: Inputs):
    return schema_history.migration_impact(t.nodes, t.edges, t.catalog_old, t.catalog_new)
