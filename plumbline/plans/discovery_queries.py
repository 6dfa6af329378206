"""Registered queries: checksum trees, relationships and keys found in data, stored sketches, exact samples, checked loads, footers, reach."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from plumbline.operators import checksum, keys, reach, relationships, samples, sketches
from plumbline.plans.compare_queries import _row_compare
from plumbline.plans.profile_queries import _AS_OF, _NUMBERS, _SPLIT, _START, _TEXTS, _drift_rows
from plumbline.plans.registry import Inputs, query
from plumbline.session import scratch_dir
from plumbline.sources import metadata, publish

# ---------------------------------------------------------------- checksum tree


@query("checksum_compare", _row_compare("orders_old", "orders_new", "*", "EXCEPT"))
def _(t: Inputs):
    return checksum.checksum_compare(t.orders_old, t.orders_new, "orders")


@query("checksum_compare_multiset", _row_compare("lines_old", "lines_new", "*", "EXCEPT ALL"))
def _(t: Inputs):
    return checksum.checksum_compare(t.lines_old, t.lines_new, "orders", multiset=True)


@query("checksum_compare_equal", _row_compare("lineitem", "lineitem", "*", "EXCEPT ALL"))
def _(t: Inputs):
    """A table against itself in another order, by stored digests on one side."""
    held = checksum.table_digests(t.lineitem)
    return checksum.checksum_compare(t.lineitem, t.lineitem.hint("rebalance", "l_partkey"), "orders", multiset=True, main_digests=held)


# ---------------------------------------------------------------- relationships

_COLUMNS = {
    "region": {"r_regionkey": "i", "r_name": "s"},
    "nation": {"n_nationkey": "i", "n_name": "s", "n_regionkey": "i"},
    "customer": {"c_custkey": "i", "c_name": "s", "c_nationkey": "i", "c_acctbal": "f", "c_mktsegment": "s"},
    "supplier": {"s_suppkey": "i", "s_name": "s", "s_nationkey": "i", "s_acctbal": "f"},
    "part": {"p_partkey": "i", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "i", "p_retailprice": "f"},
    "orders": {"o_orderkey": "i", "o_custkey": "i", "o_orderstatus": "s", "o_totalprice": "f", "o_orderdate": "t", "o_orderpriority": "s"},
    "lineitem": {
        "l_orderkey": "i", "l_partkey": "i", "l_suppkey": "i", "l_linenumber": "i", "l_quantity": "f", "l_extendedprice": "f", "l_discount": "f",
        "l_tax": "f", "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t",
    },
    "events": {"event_id": "i", "ts": "t", "user_id": "i", "event_type": "s", "value": "f", "props": "s"},
}


def _inclusions(share: float) -> str:
    cells = []
    for table, columns in _COLUMNS.items():
        for c, kind in columns.items():
            # whole numbers meet whatever their type; a day is told apart from text and number
            value = f"CAST({c} AS DOUBLE)" if kind in "if" else c
            cells.append(
                f"SELECT '{table}' AS t, '{c}' AS c, '{'n' if kind in 'if' else kind}' || CAST({value} AS VARCHAR) AS v, COUNT(*) AS n FROM {{{table}}} WHERE {c} IS NOT NULL GROUP BY {value}"
            )
    return f"""WITH cells AS ({" UNION ALL ".join(cells)}),
      sizes AS (SELECT t, c, COUNT(*) AS n, MAX(n) = 1 AS is_unique FROM cells GROUP BY t, c),
      pairs AS (SELECT a.t, a.c, b.t AS bt, b.c AS bc, COUNT(*) AS n FROM cells a JOIN cells b ON a.v = b.v AND (a.t, a.c) <> (b.t, b.c) GROUP BY 1, 2, 3, 4)
      SELECT p.t AS table_name, p.c AS column_name, bt AS in_table, bc AS in_column, s.n AS distinct_values, p.n AS contained_values,
        ROUND(p.n / CAST(s.n AS DOUBLE), 4) AS share, u.is_unique AS in_column_is_unique
      FROM pairs p JOIN sizes s ON s.t = p.t AND s.c = p.c JOIN sizes u ON u.t = bt AND u.c = bc WHERE p.n >= {share} * s.n"""


@query("inclusion_dependencies", _inclusions(1.0))
def _(t: Inputs):
    return relationships.inclusion_dependencies({name: getattr(t, name) for name in _COLUMNS})


@query("partial_inclusions", _inclusions(0.25))
def _(t: Inputs):
    return relationships.inclusion_dependencies({name: getattr(t, name) for name in _COLUMNS}, min_share=0.25)


# ---------------------------------------------------------------- keys

_LINE_COLUMNS = list(_COLUMNS["lineitem"])


def _lattice(table: str, columns: list[str], size: int, wanted: str) -> str:
    """Every set of columns counted by itself (``ks``: unique ones), then ``wanted`` of those that have no smaller key inside."""
    sets = [s for k in range(1, size + 1) for s in combinations(range(len(columns)), k)]
    parts = []
    for s in sets:
        names = ", ".join(columns[i] for i in s)
        mask = sum(1 << i for i in s)
        parts.append(f"SELECT '{names}' AS key_columns, {len(s)} AS size, {mask} AS mask, (SELECT COUNT(*) FROM (SELECT DISTINCT {names} FROM {{{table}}})) AS n")
    groups = [" UNION ALL ".join(parts[k : k + 50]) for k in range(0, len(parts), 50)]
    every = " UNION ALL ".join(f"SELECT * FROM ({g})" for g in groups)
    return f"""WITH counted AS ({every}), ks AS (SELECT *, n = (SELECT COUNT(*) FROM {{{table}}}) AS is_key FROM counted)
      SELECT {wanted.replace("FROM", "FROM ks k WHERE NOT EXISTS (SELECT 1 FROM ks j WHERE j.is_key AND j.mask <> k.mask AND j.mask & k.mask = j.mask)")}"""


@query("minimal_keys", _lattice("lineitem", _LINE_COLUMNS, 4, "key_columns, size, n AS row_count FROM AND is_key"))
def _(t: Inputs):
    return keys.minimal_keys(t.lineitem, 4).keys


@query("minimal_keys_levels", _lattice("orders", list(_COLUMNS["orders"]), 4, "size, COUNT(*) AS candidates, COUNT(*) FILTER (is_key) AS keys, TRUE AS adds_up FROM GROUP BY size"))
def _(t: Inputs):
    """Candidates and keys of each level that has any candidates, and whether every one was ruled out or counted."""
    fate = F.col("by_bound") + F.col("by_agreement") + F.col("counted")
    return keys.minimal_keys(t.orders, 4).levels.filter("candidates > 0").select("size", "candidates", "keys", (F.col("candidates") == fate).alias("adds_up"))


# ---------------------------------------------------------------- stored sketches

_OVERLAP = f"""SELECT 'event_type' AS column_name, 'categorical' AS data_type, 'value_overlap' AS metric, CAST(common AS VARCHAR) AS recent_value,
  CAST(old AS VARCHAR) AS comparison_value, ROUND(100 - common * 100.0 / new, 2) AS pct_change,
  CASE WHEN 100 - common * 100.0 / new > 5 THEN 'Low' ELSE 'Normal' END AS drift_severity FROM (SELECT
    (SELECT COUNT(DISTINCT event_type) FROM {{events_n}} WHERE ts >= {_SPLIT}) AS new,
    (SELECT COUNT(DISTINCT event_type) FROM {{events_n}} WHERE ts >= {_START} AND ts < {_SPLIT}) AS old,
    (SELECT COUNT(*) FROM (SELECT event_type FROM {{events_n}} WHERE ts >= {_SPLIT} AND event_type IS NOT NULL
      INTERSECT SELECT event_type FROM {{events_n}} WHERE ts >= {_START} AND ts < {_SPLIT})) AS common)"""


def _stored_events(t: Inputs):
    """The state of the events in two batches, of which the first is delivered twice and both hold rows of every day."""
    folder = scratch_dir(t.spark, "sketches")
    for batch, rows in ((0, "event_id % 2 = 0"), (0, "event_id % 2 = 0"), (1, "event_id % 2 <> 0")):
        state = sketches.sketch_state(t.events_n.filter(rows), "ts", [*_NUMBERS, *_TEXTS])
        sketches.add_batch(state, folder, batch)
    return sketches.stored_state(t.spark, folder)


@query(
    "sketched_drift",
    f"SELECT * FROM ({_drift_rows(_NUMBERS, _TEXTS)}) WHERE metric <> 'top_category_change' UNION ALL {_OVERLAP}",
)
def _(t: Inputs):
    return sketches.sketched_drift(_stored_events(t), "10 day", "10 day", _AS_OF, only_drifted=False)


def _sketched(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT({c}) AS n_values, ROUND(AVG({c}), 4) AS avg, ROUND(STDDEV_SAMP({c}), 4) AS stddev,
      CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value, TRUE AS distinct_within_6_percent, TRUE AS median_within_3_percent FROM {{events_n}}"""


@query("sketched_statistics", " UNION ALL ".join(_sketched(c) for c in _NUMBERS))
def _(t: Inputs):
    """Estimates of the whole time from the state, held against exact counts of the rows."""
    found = sketches.figures(sketches.merged_state(_stored_events(t).filter("data_type = 'numeric'")))
    exact = t.events_n.agg(
        *[F.struct(F.count_distinct(c).alias("distinct"), F.percentile(c, [0.47, 0.53]).alias("bounds")).alias(c) for c in _NUMBERS]
    ).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}.distinct"), F.col(f"{c}.bounds")) for c in _NUMBERS])))
    near = F.abs(F.col("distinct_values") - F.col("distinct")) <= F.col("distinct") * 0.06
    ranked = F.col("p50").between(F.col("bounds")[0], F.col("bounds")[1])
    names = ("column_name", "n_rows", "n_values", "avg", "stddev", "min_value", "max_value")
    checks = (near.alias("distinct_within_6_percent"), ranked.alias("median_within_3_percent"))
    return found.join(F.broadcast(exact), "column_name").select(*names, *checks)


# ---------------------------------------------------------------- exact samples


@query("exact_sample", "SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem} ORDER BY md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey) LIMIT 1000")
def _(t: Inputs):
    by = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return samples.exact_sample(t.lineitem, 1000, by).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "exact_sample_by_group",
    """SELECT o_orderpriority, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus
      ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS r FROM {orders}) WHERE r <= 20""",
)
def _(t: Inputs):
    """The sample of every group, merged from those of two halves of the table."""
    groups = ["o_orderpriority", "o_orderstatus"]
    halves = [t.orders.filter(f"o_orderkey % 2 = {k}") for k in (0, 1)]
    parts = [samples.exact_sample(h, 20, "o_orderkey", groups, keep_draw=True) for h in halves]
    return samples.merged_samples(parts, 20, groups).select(*groups, "o_orderkey")


# ---------------------------------------------------------------- loads checked while they are written

_LOAD_CHECKS = """SELECT 'not_null' AS check_name, 'o_orderstatus' AS column_name, (SELECT COUNT(*) FROM {orders_new} WHERE o_orderstatus IS NULL) AS n_failing
  UNION ALL SELECT 'accepted_values', 'o_orderpriority', (SELECT COUNT(*) FROM {orders_new} WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))
  UNION ALL SELECT 'relationship', 'o_custkey', (SELECT COUNT(*) FROM {orders_new} WHERE o_custkey NOT IN (SELECT c_custkey FROM {customer}))
  UNION ALL SELECT 'condition', 'positive key', (SELECT COUNT(*) FROM {orders_new} WHERE NOT o_orderkey >= 0)
  UNION ALL SELECT 'unique', 'o_custkey', (SELECT COUNT(*) FROM (SELECT o_custkey FROM good GROUP BY o_custkey HAVING COUNT(*) > 1))"""
_GOOD = """good AS (SELECT * FROM {orders_new} WHERE o_orderstatus IS NOT NULL AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
  AND o_custkey IN (SELECT c_custkey FROM {customer}) AND o_orderkey >= 0)"""


def _load(t: Inputs, df, table: str, allowed):
    return publish.publish_checked(
        df,
        table,
        not_null=["o_orderstatus"],
        accepted={"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]},
        relationships={"o_custkey": (t.customer, "c_custkey")},
        conditions={"positive key": F.col("o_orderkey") >= 0},
        unique=["o_custkey"],
        allowed=allowed,
    )


@query("publish_checked_report", f"WITH {_GOOD}, checks AS ({_LOAD_CHECKS}) SELECT *, n_failing = 0 AS passed FROM checks")
def _(t: Inputs):
    found = _load(t, t.orders_new, f"{scratch_dir(t.spark, 'published')}", None).report
    return found.select("check_name", "column_name", "n_failing", "passed")


@query("publish_checked", f"WITH {_GOOD} SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n, SUM(o_orderkey) AS keys FROM good GROUP BY 1, 2")
def _(t: Inputs):
    """A refused load of the old version, then an accepted one of the new version: its good rows are the table."""
    table = scratch_dir(t.spark, "published")
    many = 10**9
    labels = ["not_null(o_orderstatus)", "accepted_values(o_orderpriority)", "relationship(o_custkey)", "condition(positive key)", "unique(o_custkey)"]
    _load(t, t.orders_old, table, None)
    _load(t, t.orders_new, table, dict.fromkeys(labels, many))
    found = publish.published_table(t.spark, table)
    return found.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


# ---------------------------------------------------------------- footers


def _footer(table: str) -> str:
    parts = []
    for i, (c, kind) in enumerate(_COLUMNS[table].items()):
        # a footer may hold -0.0 for a least 0.0
        bounds = [f"CAST({f}({c}) AS DOUBLE)" if kind in "if" else "CAST(NULL AS DOUBLE)" for f in ("MIN", "MAX")]
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, {i + 1} AS ordinal, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, "
            f"ROUND({bounds[0]}, 4) AS low, ROUND({bounds[1]}, 4) AS high FROM {{{table}}}"
        )
    return " UNION ALL ".join(parts)


@query("footer_statistics", " UNION ALL ".join(_footer(t) for t in _COLUMNS))
def _(t: Inputs):
    found = metadata.footer_statistics(t.spark, {name: f"{t.sf_dir}/{name}.parquet" for name in _COLUMNS})
    bounds = [(F.col(c).cast("double") + 0.0).alias(n) for c, n in (("min_value", "low"), ("max_value", "high"))]
    return found.select("table_name", "column_name", "ordinal", "row_count", "null_count", *bounds)


@query(
    "footer_row_counts",
    """SELECT 'orders' AS model_a, 'lineitem' AS model_b, a AS model_a_rows, b AS model_b_rows, b - a AS row_diff,
      ROUND((b - a) * 100.0 / NULLIF(a, 0), 2) AS pct_diff FROM (SELECT (SELECT COUNT(*) FROM {orders}) AS a, (SELECT COUNT(*) FROM {lineitem}) AS b)""",
)
def _(t: Inputs):
    paths = [f"{t.sf_dir}/{name}.parquet" for name in ("orders", "lineitem")]
    return metadata.footer_row_counts(t.spark, *paths, ("orders", "lineitem"))


# ---------------------------------------------------------------- reach


@query(
    "reach_counts",
    """WITH RECURSIVE known AS (SELECT e.* FROM {edges} e JOIN {nodes} a ON a.node_id = e.upstream_id JOIN {nodes} b ON b.node_id = e.downstream_id),
    walk AS (SELECT upstream_id AS a, downstream_id AS b FROM known UNION SELECT w.a, k.downstream_id FROM walk w JOIN known k ON k.upstream_id = w.b)
    SELECT model_name, (SELECT COUNT(*) FROM walk WHERE b = n.node_id AND a <> b) AS upstream_models,
      (SELECT COUNT(*) FROM walk WHERE a = n.node_id AND a <> b) AS downstream_models,
      EXISTS (SELECT 1 FROM walk WHERE a = n.node_id AND b = n.node_id) AS in_cycle FROM {nodes} n""",
)
def _(t: Inputs):
    """Exact up to 2 ** 16 reached models, more than this graph has at sf0.1; on larger ones, counts beyond are estimates."""
    return reach.reach_counts(t.nodes, t.edges, entries=16)
