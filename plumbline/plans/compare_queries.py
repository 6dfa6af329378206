"""Registered queries: version comparison and consolidation."""

from __future__ import annotations

from plumbline.operators import compare, consolidate
from plumbline.plans.registry import Inputs, query

_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _counters(c: str) -> str:
    old, new = f"o.{c}", f"n.{c}"
    return f"""
      COUNT(*) FILTER (WHERE {old} IS NOT DISTINCT FROM {new}) AS {c}_same_count,
      COUNT(*) FILTER (WHERE {old} <> {new}) AS {c}_diff_count,
      COUNT(*) FILTER (WHERE {old} IS NULL AND {new} IS NOT NULL) AS {c}_null_to_value_count,
      COUNT(*) FILTER (WHERE {old} IS NOT NULL AND {new} IS NULL) AS {c}_value_to_null_count"""


def _label(c: str) -> str:
    return (
        f"CASE WHEN o.{c} = n.{c} THEN 'SAME' WHEN o.{c} IS NULL AND n.{c} IS NULL THEN 'SAME' "
        f"WHEN o.{c} IS NULL THEN 'NULL→VALUE' WHEN n.{c} IS NULL THEN 'VALUE→NULL' ELSE 'DIFFERENT' END AS {c}_comparison"
    )


@query(
    "column_compare",
    "SELECT 'old vs new' AS comparison_name,"
    + ",".join(map(_counters, _COLUMNS))
    + " FROM {orders_old} o FULL JOIN {orders_new} n ON o.o_orderkey = n.o_orderkey",
)
def _(t: Inputs):
    return compare.column_compare(t.orders_old, t.orders_new, "o_orderkey")


@query(
    "column_compare_repeated_keys",
    "SELECT 'old vs new' AS comparison_name,"
    + ",".join(map(_counters, ["l_quantity", "l_returnflag"]))
    + """, COUNT(*) FILTER (WHERE n.here IS NULL) AS only_in_old, COUNT(*) FILTER (WHERE o.here IS NULL) AS only_in_new
    FROM (SELECT *, 1 AS here FROM {lines_old}) o FULL JOIN (SELECT *, 1 AS here FROM {lines_new}) n ON o.l_orderkey = n.l_orderkey""",
)
def _(t: Inputs):
    return compare.column_compare(t.lines_old, t.lines_new, "l_orderkey", row_status=True)


def _per_key(c: str) -> str:
    return (
        f"SELECT COALESCE(o.l_orderkey, n.l_orderkey) AS l_orderkey, '{c}' AS column_name,"
        + _counters(c).replace(f"{c}_", "")
        + " FROM {lines_old} o FULL JOIN {lines_new} n ON o.l_orderkey = n.l_orderkey GROUP BY 1"
    )


@query("column_compare_by_key", " UNION ALL ".join(map(_per_key, ["l_quantity", "l_returnflag"])))
def _(t: Inputs):
    return compare.column_compare_by_key(t.lines_old, t.lines_new, "l_orderkey")


@query(
    "column_compare_rows",
    "SELECT COALESCE(o.o_orderkey, n.o_orderkey) AS o_orderkey, "
    + ", ".join(map(_label, _COLUMNS))
    + " FROM {orders_old} o FULL JOIN {orders_new} n ON o.o_orderkey = n.o_orderkey",
)
def _(t: Inputs):
    return compare.column_compare_rows(t.orders_old, t.orders_new, "o_orderkey")


def _key_counts(old: str, new: str, key: str) -> str:
    return f"""
    WITH counted AS (SELECT (SELECT COUNT(*) FROM {{{old}}}) AS n_old, (SELECT COUNT(*) FROM {{{new}}}) AS n_new,
      (SELECT COUNT(*) FROM {{{old}}} a WHERE NOT EXISTS (SELECT 1 FROM {{{new}}} b WHERE a.{key} = b.{key})) AS old_only,
      (SELECT COUNT(*) FROM {{{new}}} b WHERE NOT EXISTS (SELECT 1 FROM {{{old}}} a WHERE a.{key} = b.{key})) AS new_only)"""


_DIFFERENCE = """ABS(n_new - n_old) AS record_count_difference,
      ROUND(ROUND(ABS(n_new - n_old) * CAST(100 AS DOUBLE) / NULLIF(n_old, 0), 2), 4) AS percentage_change FROM counted"""


@query(
    "key_reconcile",
    _key_counts("orders_old", "orders_new", "o_orderkey")
    + """ SELECT 'orders_old' AS old_model, 'orders_new' AS new_model, n_old AS old_record_count, n_new AS new_record_count,
      old_only AS records_in_old_not_in_new, new_only AS records_in_new_not_in_old, """
    + _DIFFERENCE,
)
def _(t: Inputs):
    return compare.key_reconcile(t.orders_old, t.orders_new, "o_orderkey", ("orders_old", "orders_new"))


@query(
    "key_reconcile_min",
    _key_counts("lines_old", "lines_new", "l_orderkey")
    + """ SELECT 'lines_old' AS old_model, 'lines_new' AS new_model, n_old AS old_record_count, n_new AS new_record_count,
      old_only AS keys_missing_in_new, new_only AS keys_missing_in_old FROM counted""",
)
def _(t: Inputs):
    return compare.key_reconcile_min(t.lines_old, t.lines_new, "l_orderkey", ("lines_old", "lines_new"))


@query(
    "key_reconcile_schemas",
    _key_counts("env_dev", "orders", "o_orderkey")
    + """ SELECT 'orders' AS model_name, 'dev' AS schema_a, 'prod' AS schema_b, n_old AS schema_a_row_count,
      n_new AS schema_b_row_count, old_only AS rows_in_a_not_in_b, new_only AS rows_in_b_not_in_a, """
    + _DIFFERENCE,
)
def _(t: Inputs):
    return compare.key_reconcile_schemas(t.env_dev, t.orders, "o_orderkey", "orders", ("dev", "prod"))


@query(
    "missing_key_sample",
    """SELECT * FROM (SELECT 'missing_in_new' AS direction, a.* FROM {orders_old} a
      WHERE NOT EXISTS (SELECT 1 FROM {orders_new} b WHERE a.o_orderkey = b.o_orderkey) ORDER BY o_orderkey LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'missing_in_old' AS direction, b.* FROM {orders_new} b
      WHERE NOT EXISTS (SELECT 1 FROM {orders_old} a WHERE a.o_orderkey = b.o_orderkey) ORDER BY o_orderkey LIMIT 5)""",
)
def _(t: Inputs):
    return compare.missing_key_sample(t.orders_old, t.orders_new, "o_orderkey")


_ROW_COMPARE = """SELECT 'orders' AS model_name, 'main' AS main_schema, 'current' AS current_schema,
      (SELECT COUNT(*) FROM {%s}) AS main_row_count, (SELECT COUNT(*) FROM {%s}) AS current_row_count,
      (SELECT COUNT(*) FROM (SELECT %s FROM {%s} %s SELECT %s FROM {%s})) AS rows_in_main_not_current,
      (SELECT COUNT(*) FROM (SELECT %s FROM {%s} %s SELECT %s FROM {%s})) AS rows_in_current_not_main"""


def _row_compare(main: str, current: str, columns: str, op: str) -> str:
    return _ROW_COMPARE % (main, current, columns, main, op, columns, current, columns, current, op, columns, main)


@query("row_compare", _row_compare("orders_old", "orders_new", "*", "EXCEPT"))
def _(t: Inputs):
    return compare.row_compare(t.orders_old, t.orders_new, "orders")


@query(
    "row_compare_common_columns",
    _row_compare("orders_old", "orders_reshaped", "o_orderkey, o_orderstatus, o_totalprice", "EXCEPT"),
)
def _(t: Inputs):
    return compare.row_compare(t.orders_old, t.orders_reshaped, "orders")


@query("row_compare_multiset", _row_compare("lines_old", "lines_new", "*", "EXCEPT ALL"))
def _(t: Inputs):
    return compare.row_compare(t.lines_old, t.lines_new, "orders", multiset=True)


def _env_pair(before: str, after: str, old: str, new: str) -> str:
    return f"""SELECT 'orders' AS model_name, '{before}' AS baseline_env, '{after}' AS compare_env, b AS baseline_rows, c AS compare_rows,
      c - b AS absolute_diff, ROUND(ROUND((c - b) * CAST(100 AS DOUBLE) / NULLIF(b, 0), 2), 4) AS percent_diff,
      (SELECT COUNT(*) FROM (SELECT o_orderkey FROM {{{old}}} EXCEPT SELECT o_orderkey FROM {{{new}}})) AS rows_in_baseline_not_compare,
      (SELECT COUNT(*) FROM (SELECT o_orderkey FROM {{{new}}} EXCEPT SELECT o_orderkey FROM {{{old}}})) AS rows_in_compare_not_baseline
      FROM (SELECT (SELECT COUNT(*) FROM {{{old}}}) AS b, (SELECT COUNT(*) FROM {{{new}}}) AS c)"""


@query(
    "env_chain_compare",
    _env_pair("dev", "test", "env_dev", "env_test") + " UNION ALL " + _env_pair("test", "prod", "env_test", "orders"),
)
def _(t: Inputs):
    chain = {"dev": t.env_dev, "test": t.env_test, "prod": t.orders}
    return compare.env_chain_compare(chain, "orders", ["o_orderkey"])


def _stat(c: str) -> str:
    return (
        f"(SELECT COUNT({c}) FROM {{orders_old}}) AS main_{c}_non_null, (SELECT COUNT({c}) FROM {{orders_reshaped}}) AS current_{c}_non_null, "
        f"(SELECT COUNT(DISTINCT {c}) FROM {{orders_old}}) AS main_{c}_distinct, (SELECT COUNT(DISTINCT {c}) FROM {{orders_reshaped}}) AS current_{c}_distinct"
    )


@query(
    "stat_compare",
    """SELECT main_rows, current_rows, current_rows - main_rows AS row_difference,
      'o_orderdate, o_orderpriority' AS columns_removed, 'order_day' AS columns_added, """
    + ", ".join(map(_stat, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]))
    + """ FROM (SELECT (SELECT COUNT(*) FROM {orders_old}) AS main_rows, (SELECT COUNT(*) FROM {orders_reshaped}) AS current_rows)""",
)
def _(t: Inputs):
    return compare.stat_compare(t.orders_old, t.orders_reshaped)


@query(
    "ab_row_count",
    """SELECT 'a' AS model_a, 'b' AS model_b, a AS model_a_rows, b AS model_b_rows, b - a AS row_diff,
      ROUND(ROUND((b - a) * CAST(100 AS DOUBLE) / NULLIF(a, 0), 2), 4) AS pct_diff
      FROM (SELECT (SELECT COUNT(*) FROM {orders_old}) AS a, (SELECT COUNT(*) FROM {orders_new}) AS b)""",
)
def _(t: Inputs):
    return compare.ab_row_count(t.orders_old, t.orders_new)


def _quality(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, an AS a_null_count, bn AS b_null_count, bn - an AS null_diff,
      ad AS a_distinct_count, bd AS b_distinct_count, bd - ad AS distinct_diff
      FROM (SELECT COUNT(*) - COUNT({c}) AS an, COUNT(DISTINCT {c}) AS ad FROM {{orders_old}}) CROSS JOIN
           (SELECT COUNT(*) - COUNT({c}) AS bn, COUNT(DISTINCT {c}) AS bd FROM {{orders_new}})"""


@query("ab_data_quality", " UNION ALL ".join(map(_quality, ["o_orderkey", *_COLUMNS])))
def _(t: Inputs):
    return compare.ab_data_quality(t.orders_old, t.orders_new)


_GATE = """SELECT 'FAIL: Row count changed by more than 10%%' AS status, a AS old_row_count, b AS new_row_count,
      ABS(b - a) AS row_count_diff, ROUND(ABS(b - a) / CAST(a AS DOUBLE), 4) AS row_count_pct_change
      FROM (SELECT (SELECT COUNT(*) FROM {%s}) AS a, (SELECT COUNT(*) FROM {%s}) AS b) WHERE ABS(b - a) / CAST(a AS DOUBLE) > 0.1"""


@query("row_count_gate", _GATE % ("env_dev", "orders"))
def _(t: Inputs):
    return compare.row_count_gate(t.env_dev, t.orders)


# ---------------------------------------------------------------- consolidation


def _sources(t: Inputs):
    return {"src_f": t.src_f, "src_o": t.src_o, "src_p": t.src_p}


_NAMES = ("src_f", "src_o", "src_p")
_ALL_KEYS = " UNION ".join(f"SELECT o_orderkey FROM {{{s}}}" for s in _NAMES)


@query(
    "consolidation_check",
    "SELECT 'src_f, src_o, src_p' AS source_models, 'cons_target' AS target_model, target_row_count, union_row_count, "
    + ", ".join(
        f"(SELECT COUNT(*) FROM {{{s}}}) AS {s}_row_count, (SELECT COUNT(*) FROM {{{s}}} a WHERE NOT EXISTS "
        f"(SELECT 1 FROM {{cons_target}} b WHERE a.o_orderkey = b.o_orderkey)) AS {s}_missing_count"
        for s in _NAMES
    )
    + f""", CASE WHEN union_row_count <= target_row_count THEN 'OK' ELSE 'WARNING: Target has fewer rows than union of sources' END AS validation_status
    FROM (SELECT (SELECT COUNT(*) FROM {{cons_target}}) AS target_row_count, (SELECT COUNT(DISTINCT o_orderkey) FROM ({_ALL_KEYS})) AS union_row_count)""",
)
def _(t: Inputs):
    return consolidate.consolidation_check(_sources(t), t.cons_target, "o_orderkey", "cons_target")


@query(
    "consolidation_missing_rows",
    " UNION ALL ".join(
        f"SELECT '{s}' AS source_model, (SELECT COUNT(*) FROM (SELECT o_orderkey, o_custkey FROM {{{s}}} EXCEPT "
        f"SELECT o_orderkey, o_custkey FROM {{cons_target}})) AS missing_row_count"
        for s in _NAMES
    ),
)
def _(t: Inputs):
    return consolidate.consolidation_missing_rows(_sources(t), t.cons_target, ["o_orderkey", "o_custkey"])


@query(
    "consolidation_missing_rows_all",
    " UNION ALL ".join(
        f"SELECT '{s}' AS source_model, (SELECT COUNT(*) FROM {{{s}}} a LEFT JOIN (SELECT DISTINCT l_orderkey FROM {{{k}}}) b "
        f"ON a.l_orderkey = b.l_orderkey WHERE b.l_orderkey IS NULL) AS missing_row_count"
        for s, k in (("lines_new", "lines_old"), ("lineitem", "lines_old"))
    ),
)
def _(t: Inputs):
    sources = {"lines_new": t.lines_new, "lineitem": t.lineitem}
    return consolidate.consolidation_missing_rows(sources, t.lines_old, "l_orderkey", mode="rows")


@query(
    "consolidation_missing_sample",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{s}' AS source_model, a.* FROM {{{s}}} a WHERE NOT EXISTS "
        f"(SELECT 1 FROM {{cons_target}} b WHERE a.o_orderkey = b.o_orderkey) ORDER BY o_orderkey LIMIT 5)"
        for s in _NAMES
    ),
)
def _(t: Inputs):
    return consolidate.consolidation_missing_sample(_sources(t), t.cons_target, "o_orderkey")


@query(
    "consolidation_missing_union",
    f"SELECT COUNT(*) AS missing_union_count FROM (({_ALL_KEYS}) EXCEPT SELECT o_orderkey FROM {{cons_target}})",
)
def _(t: Inputs):
    return consolidate.consolidation_missing_union(_sources(t), t.cons_target, "o_orderkey")


@query(
    "consolidation_missing_union_sample",
    f"SELECT o_orderkey FROM (({_ALL_KEYS}) EXCEPT SELECT o_orderkey FROM {{cons_target}}) ORDER BY o_orderkey LIMIT 5",
)
def _(t: Inputs):
    return consolidate.consolidation_missing_union(_sources(t), t.cons_target, "o_orderkey", sample=5)


@query(
    "consolidation_missing_columns",
    """SELECT column_name, arg_min(data_type, (model_name, ordinal, data_type)) AS data_type, MIN(model_name) AS source_model
    FROM {catalog_old} o WHERE column_name NOT IN ('c1', 'c3') AND NOT EXISTS (SELECT 1 FROM {catalog_new} n WHERE n.column_name = o.column_name)
    GROUP BY column_name""",
)
def _(t: Inputs):
    return consolidate.consolidation_missing_columns(t.catalog_old, t.catalog_new, ["c1", "c3"])


@query(
    "consolidation_summary",
    " UNION ALL ".join(
        f"SELECT '{s}' AS model_name, 'src_f,src_o,src_p' AS source_models, 'cons_target' AS target_model, "
        f"(SELECT COUNT(*) FROM {{{s}}}) AS row_count, CAST({n} AS BIGINT) AS column_count, "
        f"CAST({c} AS BIGINT) AS common_columns, CAST({m} AS BIGINT) AS missing_columns"
        for s, n, c, m in [*((s, 6, 5, 1) for s in _NAMES), ("cons_target", 5, "NULL", "NULL")]
    ),
)
def _(t: Inputs):
    return consolidate.consolidation_summary(_sources(t), t.cons_target, "cons_target")


_COMMON = {"o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": False, "o_orderdate": False}


@query(
    "infer_keys",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {named} AS name_matches, COUNT(*) AS row_count, COUNT(DISTINCT {c}) AS distinct_count, "
        f"ROUND(COUNT(DISTINCT {c}) / CAST(COUNT(*) AS DOUBLE), 4) AS distinct_ratio, {named} AND COUNT(DISTINCT {c}) = COUNT(*) AS is_key FROM {{cons_target}}"
        for c, named in _COMMON.items()
    ),
)
def _(t: Inputs):
    return consolidate.infer_keys(_sources(t), t.cons_target)


def _measured(relation: str, names: tuple[str, ...]) -> str:
    # a row of DuckDB is not NULL when its fields are, so rows with a NULL part are left out
    whole = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"""SELECT '{relation.removeprefix("cons_")}' AS relation_name, '{", ".join(names)}' AS key_columns, COUNT(*) AS row_count,
      COUNT(DISTINCT ({", ".join(names)},)) FILTER (WHERE {whole}) AS distinct_count FROM {{{relation}}}"""


@query(
    "confirm_keys",
    "SELECT *, distinct_count = row_count AS is_key, BOOL_AND(distinct_count = row_count) OVER (PARTITION BY key_columns) AS confirmed FROM ("
    + " UNION ALL ".join(
        _measured(r, names) for r in (*_NAMES, "cons_target") for names in [*[(c,) for c in _COMMON], ("o_orderkey", "o_custkey")]
    )
    + ")",
)
def _(t: Inputs):
    return consolidate.confirm_keys(_sources(t), t.cons_target)
