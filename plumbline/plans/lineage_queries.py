"""Registered queries: graph walks, references, vestigial relations."""

from __future__ import annotations

from plumbline.operators import lineage
from plumbline.plans.registry import Inputs, query


def _walk(start: str, direction: str, bound: str = "", union: str = "UNION") -> str:
    here, there = ("downstream_id", "upstream_id") if direction == "up" else ("upstream_id", "downstream_id")
    return f"""WITH RECURSIVE walk AS (
      SELECT n.model_name AS start_name, n.node_id AS unique_id, n.model_name AS name, CAST(NULL AS VARCHAR) AS referenced_by, 0 AS depth
      FROM {{nodes}} n WHERE n.model_name IN (SELECT model_name FROM {{{start}}})
      {union} SELECT w.start_name, n.node_id, n.model_name, w.name, w.depth + 1 FROM walk w
      JOIN {{edges}} e ON e.{here} = w.unique_id JOIN {{nodes}} n ON n.node_id = e.{there} {bound})"""


@query("upstream_closure", _walk("leaf_models", "up") + " SELECT DISTINCT start_name, unique_id, name, referenced_by, depth FROM walk")
def _(t: Inputs):
    return lineage.upstream_closure(t.nodes, t.edges, t.leaf_models)


@query("upstream_closure_paths", _walk("large_models", "up", union="UNION ALL") + " SELECT * FROM walk")
def _(t: Inputs):
    return lineage.upstream_closure(t.nodes, t.edges, t.large_models, dedupe="paths")


@query(
    "column_lineage",
    _walk("leaf_models", "up")
    + """ SELECT DISTINCT w.start_name, w.unique_id, w.name, w.referenced_by, w.depth,
      contains(LOWER(regexp_extract(n.model_sql, '(?is)select.*?from')), 'large') AS in_select
    FROM walk w JOIN {nodes} n ON n.node_id = w.unique_id WHERE contains(LOWER(n.model_sql), 'large')""",
)
def _(t: Inputs):
    return lineage.column_lineage(t.nodes, t.edges, t.leaf_models, "LARGE")


@query(
    "upstream_bounded",
    _walk("leaf_models", "up", "WHERE w.depth < 3")
    + " SELECT DISTINCT start_name, unique_id, name, n.resource_type, depth FROM walk w JOIN {nodes} n ON n.node_id = w.unique_id",
)
def _(t: Inputs):
    return lineage.upstream_bounded(t.nodes, t.edges, t.leaf_models)


@query(
    "subgraph_edges",
    _walk("large_models", "up", "WHERE w.depth < 3")
    + """ SELECT DISTINCT a.start_name, a.name AS source_name, b.name AS target_name FROM {edges} e
      JOIN walk a ON a.unique_id = e.upstream_id JOIN walk b ON b.unique_id = e.downstream_id AND a.start_name = b.start_name""",
)
def _(t: Inputs):
    return lineage.subgraph_edges(t.nodes, t.edges, t.large_models)


_DOWN = _walk("large_models", "down", "WHERE n.resource_type = 'model' AND w.depth < 3")


@query("downstream_impact", _DOWN + " SELECT DISTINCT start_name, name, depth FROM walk WHERE depth > 0")
def _(t: Inputs):
    return lineage.downstream_impact(t.nodes, t.edges, t.large_models)


@query(
    "impact_by_level",
    _DOWN
    + """, impact AS (SELECT DISTINCT start_name, name, depth FROM walk WHERE depth > 0)
    SELECT start_name, depth, COUNT(*) AS models, CAST(SUM(COUNT(*)) OVER (PARTITION BY start_name) AS BIGINT) AS total_models FROM impact GROUP BY 1, 2""",
)
def _(t: Inputs):
    return lineage.impact_by_level(lineage.downstream_impact(t.nodes, t.edges, t.large_models))


@query(
    "immediate_children",
    """SELECT DISTINCT s.model_name AS start_name, c.model_name AS name FROM {nodes} s JOIN {edges} e ON e.upstream_id = s.node_id
    JOIN {nodes} c ON c.node_id = e.downstream_id WHERE c.resource_type = 'model'""",
)
def _(t: Inputs):
    return lineage.immediate_children(t.nodes, t.edges, t.nodes.select("model_name"))


@query(
    "find_references",
    """SELECT file_path FROM {model_files} WHERE ends_with(file_path, '.sql')
    AND (contains(LOWER(file_content), 'ref(''model_7'')') OR contains(LOWER(file_content), 'ref("model_7")'))""",
)
def _(t: Inputs):
    return lineage.find_references(t.model_files, "Model_7")


@query(
    "reference_edges",
    """SELECT file_path, r AS referenced, COUNT(*) AS mentions FROM (SELECT file_path,
      unnest(regexp_extract_all(file_content, '(?i)ref\\([''"]([^''"]+)[''"]\\)', 1)) AS r FROM {model_files} WHERE ends_with(file_path, '.sql')) GROUP BY 1, 2""",
)
def _(t: Inputs):
    return lineage.reference_edges(t.model_files)


@query(
    "reference_edges_pages",
    """SELECT file_path, r AS referenced, COUNT(*) AS mentions FROM (SELECT url AS file_path, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS r FROM {pages}) GROUP BY 1, 2""",
)
def _(t: Inputs):
    files = t.pages.withColumnsRenamed({"url": "file_path", "html": "file_content"})
    return lineage.reference_edges(files, r'href="([^"]*)"', suffix=None)


@query(
    "vestigial_relations",
    """SELECT i.schema_name, i.ref_name, i.ref_type FROM {inventory} i WHERE i.schema_name IN (SELECT schema_name FROM {expected})
    AND i.schema_name <> 'Brand#3' AND i.schema_name || '.' || i.ref_name NOT IN ('BUILDING.v11', 'BUILDING.v12')
    AND NOT EXISTS (SELECT 1 FROM {expected} e WHERE e.schema_name = i.schema_name AND e.ref_name = i.ref_name)""",
)
def _(t: Inputs):
    return lineage.vestigial_relations(t.inventory, t.expected, "Brand#3", ["BUILDING.v11", "BUILDING.v12"])
