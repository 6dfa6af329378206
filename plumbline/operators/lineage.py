"""Walks over dependency graphs, references in files, relations unknown to the graph.

Graphs are frames: nodes ``(node_id, model_name[, resource_type, model_sql])`` and edges
``(upstream_id, downstream_id)``. A walk follows all its start models together, one join of
the frontier with the edges per level. Sides that grow with the graph are shuffled, as a walk
would broadcast them once a level.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.functions.columns import as_list
from plumbline.session import cut_lineage

FIRST_CHECK = 16  # level at which an unbounded walk first compares its depth with the number of models

# Patterns of a reference in a file, of the select list, and the suffix of model files.
REFERENCE = r"""(?i)ref\(['"]([^'"]+)['"]\)"""
SELECT_LIST = r"(?is)select.*?from"
MODEL_FILE = ".sql"


def _start_ids(nodes: DataFrame, start: str | Sequence[str] | DataFrame) -> DataFrame:
    if isinstance(start, DataFrame):
        names = start.select(F.col(start.columns[0]).alias("model_name")).distinct()
        chosen = nodes.join(names.hint("merge"), "model_name", "left_semi")
    else:
        chosen = nodes.filter(F.col("model_name").isin(as_list(start)))
    return chosen.select(F.col("node_id").alias("start_id"), F.col("node_id"))


def _steps(nodes: DataFrame, edges: DataFrame, direction: str, resource_type: str | None) -> DataFrame:
    """Distinct (from_id, to_id) of the wanted direction between nodes that exist."""
    if direction not in ("upstream", "downstream"):
        raise ValueError("direction is 'upstream' or 'downstream'")
    ends = ("downstream_id", "upstream_id") if direction == "upstream" else ("upstream_id", "downstream_id")
    reachable = nodes if resource_type is None else nodes.filter(F.col("resource_type") == resource_type)
    return (
        edges.select(F.col(ends[0]).alias("from_id"), F.col(ends[1]).alias("to_id"))
        .join(reachable.select(F.col("node_id").alias("to_id")).hint("merge"), "to_id", "left_semi")
        .select("from_id", "to_id")
    )


def graph_walk(
    nodes: DataFrame,
    edges: DataFrame,
    start: str | Sequence[str] | DataFrame,
    direction: str = "upstream",
    max_depth: int | None = None,
    dedupe: str = "depth",
    resource_type: str | None = None,
) -> DataFrame:
    """Models reachable from each start: ``start_name, unique_id, name, referenced_by, depth``.

    ``dedupe='depth'`` reports a model once per depth and referrer, ``'paths'`` once per path,
    ``'first'`` only at its smallest depth (which also ends on cyclic graphs). Without
    ``max_depth`` the walk goes on until nothing new is reached. Each level is computed once and written to
    the shared folder, so lost executors do not restart the walk; the jobs run before the result is returned.
    """
    if dedupe not in ("depth", "paths", "first"):
        raise ValueError("dedupe is 'depth', 'paths' or 'first'")
    steps = _steps(nodes, edges, direction, resource_type)
    frontier = _start_ids(nodes, start).select(
        "start_id", "node_id", F.lit(None).cast(nodes.schema["node_id"].dataType).alias("via_id"), F.lit(0).alias("depth")
    )
    steps, frontier = cut_lineage(steps), cut_lineage(frontier)
    levels = [frontier]
    reached = frontier.select("start_id", "node_id")
    depth, longest = 0, FIRST_CHECK
    while max_depth is None or depth < max_depth:
        depth += 1
        if max_depth is None and dedupe != "first" and depth == longest:
            # a walk of as many steps as there are models has met one of them twice
            models = nodes.select("node_id").distinct().count()
            if depth > models:
                raise RuntimeError(f"a walk of {depth - 1} steps repeats a model: the graph has a cycle, use dedupe='first'")
            longest = max(depth, models) + 1
        heads = frontier.select("start_id", F.col("node_id").alias("via_id"))
        if dedupe != "paths":
            heads = heads.distinct()
        following = heads.join(steps.hint("merge"), heads["via_id"] == steps["from_id"], "inner").select(
            "start_id", F.col("to_id").alias("node_id"), "via_id", F.lit(depth).alias("depth")
        )
        if dedupe != "paths":
            following = following.distinct()
        if dedupe == "first":
            following = following.join(reached.hint("merge"), ["start_id", "node_id"], "left_anti").select(*frontier.columns)
        following = cut_lineage(following)
        if following.isEmpty():
            break
        if dedupe == "first":
            reached = reached.union(following.select("start_id", "node_id").distinct())
        levels.append(following)
        frontier = following
    found = reduce(DataFrame.union, levels)
    names = nodes.select("node_id", "model_name")

    def named(id_column: str, name_column: str) -> DataFrame:
        return names.select(F.col("node_id").alias(id_column), F.col("model_name").alias(name_column)).hint("merge")

    return (
        found.join(named("start_id", "start_name"), "start_id", "inner")
        .join(named("node_id", "name"), "node_id", "inner")
        .join(named("via_id", "referenced_by"), "via_id", "left")
        .select("start_name", F.col("node_id").alias("unique_id"), "name", "referenced_by", "depth")
    )


def upstream_closure(
    nodes: DataFrame, edges: DataFrame, start: str | Sequence[str] | DataFrame, dedupe: str = "depth"
) -> DataFrame:
    """All models upstream of each start, the start itself at depth 0."""
    return graph_walk(nodes, edges, start, "upstream", None, dedupe)


def column_lineage(
    nodes: DataFrame, edges: DataFrame, start: str | Sequence[str] | DataFrame, column: str
) -> DataFrame:
    """Upstream models whose SQL text mentions the column, and whether their select list does."""
    walked = upstream_closure(nodes, edges, start)
    wanted = column.lower()
    text = F.lower("model_sql")
    mentioning = nodes.filter(text.contains(wanted)).select(
        F.col("node_id").alias("unique_id"),
        F.lower(F.regexp_extract("model_sql", SELECT_LIST, 0)).contains(wanted).alias("in_select"),
    )
    return walked.join(mentioning.hint("merge"), "unique_id", "inner").select(
        "start_name", "unique_id", "name", "referenced_by", "depth", "in_select"
    )


def upstream_bounded(
    nodes: DataFrame, edges: DataFrame, start: str | Sequence[str] | DataFrame, max_depth: int = 3
) -> DataFrame:
    """Distinct models within ``max_depth`` levels upstream of each start."""
    walked = graph_walk(nodes, edges, start, "upstream", max_depth)
    kinds = nodes.select(F.col("node_id").alias("unique_id"), "resource_type")
    return (
        walked.select("start_name", "unique_id", "name", "depth")
        .distinct()
        .join(kinds.hint("merge"), "unique_id", "inner")
        .select("start_name", "unique_id", "name", "resource_type", "depth")
    )


def subgraph_edges(
    nodes: DataFrame, edges: DataFrame, start: str | Sequence[str] | DataFrame, max_depth: int = 3
) -> DataFrame:
    """Distinct edges, by model name, between models of each start's bounded upstream set."""
    walked = graph_walk(nodes, edges, start, "upstream", max_depth)
    inside = cut_lineage(walked.select("start_name", "unique_id", "name").distinct())
    sources = inside.select("start_name", F.col("unique_id").alias("upstream_id"), F.col("name").alias("source_name"))
    targets = inside.select("start_name", F.col("unique_id").alias("downstream_id"), F.col("name").alias("target_name"))
    return (
        edges.join(targets, "downstream_id", "inner")
        .join(sources, ["start_name", "upstream_id"], "inner")
        .select("start_name", "source_name", "target_name")
        .distinct()
    )


def downstream_impact(
    nodes: DataFrame,
    edges: DataFrame,
    start: str | Sequence[str] | DataFrame,
    max_depth: int | None = 3,
    resource_type: str | None = "model",
) -> DataFrame:
    """Distinct (start, model, depth) downstream of each start, the start itself left out."""
    walked = graph_walk(nodes, edges, start, "downstream", max_depth, resource_type=resource_type)
    return walked.filter(F.col("depth") > 0).select("start_name", "name", "depth").distinct()


def impact_by_level(impact: DataFrame) -> DataFrame:
    """Affected models per start and level, with the total of the start."""
    levels = impact.groupBy("start_name", "depth").agg(F.count(F.lit(1)).alias("models"))
    # a start has no more rows here than levels
    total = F.sum("models").over(Window.partitionBy("start_name"))
    return levels.select("start_name", "depth", "models", total.alias("total_models"))


def immediate_children(
    nodes: DataFrame, edges: DataFrame, start: str | Sequence[str] | DataFrame, resource_type: str | None = "model"
) -> DataFrame:
    """Models directly downstream of each start."""
    return downstream_impact(nodes, edges, start, 1, resource_type).select("start_name", "name")


def find_references(files: DataFrame, model: str, suffix: str | None = MODEL_FILE) -> DataFrame:
    """Paths of files ``(file_path, file_content)`` that refer to the model, in any case."""
    content = F.lower("file_content")
    name = model.lower()
    found = content.contains(f"ref('{name}')") | content.contains(f'ref("{name}")')
    if suffix:
        found = found & F.endswith(F.col("file_path"), F.lit(suffix))
    return files.filter(found).select("file_path")


def reference_edges(files: DataFrame, pattern: str = REFERENCE, group: int = 1, suffix: str | None = MODEL_FILE) -> DataFrame:
    """Every (file, referenced name) with its number of mentions; feeds the walks as an edge table."""
    if suffix:
        files = files.filter(F.endswith(F.col("file_path"), F.lit(suffix)))
    names = F.regexp_extract_all("file_content", F.lit(pattern), F.lit(group))
    return (
        files.select("file_path", F.explode(names).alias("referenced"))
        .groupBy("file_path", "referenced")
        .agg(F.count(F.lit(1)).alias("mentions"))
    )


def vestigial_relations(
    inventory: DataFrame,
    expected: DataFrame,
    exclude_schemas: str | Sequence[str] = (),
    allowed: Sequence[str] = (),
) -> DataFrame:
    """Relations present in schemas the graph uses but unknown to the graph.

    ``inventory`` is ``(schema_name, ref_name, ref_type)``, ``expected`` has the first two;
    ``allowed`` lists ``schema.name`` of relations to keep.
    """
    excluded = as_list(exclude_schemas)
    in_use = expected.select("schema_name").distinct()
    if excluded:
        in_use = in_use.filter(~F.col("schema_name").isin(excluded))
    found = inventory.join(in_use, "schema_name", "left_semi").join(
        expected.select("schema_name", "ref_name"), ["schema_name", "ref_name"], "left_anti"
    )
    if allowed:
        found = found.filter(~F.concat_ws(".", "schema_name", "ref_name").isin(list(allowed)))
    return found.select("schema_name", "ref_name", "ref_type").orderBy("schema_name", "ref_name")

