"""How many models each model reaches, for all models at once and without a row per start and reached model.

Every model carries one sketch of the models it reaches. A round hands the sketches that changed to the models one step away, which
unite them; nothing changes any more once every sketch holds all there is to reach, on graphs with cycles too. What travels in a
round is one sketch per edge into a changed model, combined in the tasks before the shuffle. No side of a join is broadcast, as steps
and sketches grow with the graph and would reach the driver once a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.operators.lineage import _steps
from plumbline.session import stored

ENTRIES = 12  # 2 ** ENTRIES reached models are counted exactly, more are estimated (standard error about 1.6 %)


def reach_sketches(nodes: DataFrame, edges: DataFrame, direction: str = "downstream", entries: int = ENTRIES, resource_type: str | None = None) -> DataFrame:
    """(node_id, reached): the theta sketch of the models at least one step away, for every model that reaches any.

    Each round is written to the shared folder; there are as many as the longest shortest way has steps.
    """
    steps = _steps(nodes, edges, direction, resource_type).distinct()
    steps = stored(steps.join(nodes.select(F.col("node_id").alias("from_id")).hint("merge"), "from_id", "left_semi"), "reach-steps")
    labels = stored(steps.groupBy(F.col("from_id").alias("node_id")).agg(F.theta_sketch_agg("to_id", F.lit(entries)).alias("reached")), "reach")
    changed = labels
    while True:
        sent = steps.join(changed.hint("merge"), steps["to_id"] == changed["node_id"])
        news = sent.groupBy("from_id").agg(F.theta_union_agg("reached", F.lit(entries)).alias("news"))
        united = F.theta_union(F.col("reached"), F.col("news"), F.lit(entries))
        after = labels.join(news.hint("merge"), labels["node_id"] == news["from_id"], "left").select(
            "node_id",
            F.when(F.col("news").isNull(), F.col("reached")).otherwise(united).alias("reached"),
            (F.col("news").isNotNull() & (united != F.theta_union(F.col("reached"), F.col("reached"), F.lit(entries)))).alias("changed"),
        )
        after = stored(after, "reach")
        labels, changed = after.drop("changed"), after.filter("changed").drop("changed")
        if changed.isEmpty():
            return labels


def reach_counts(nodes: DataFrame, edges: DataFrame, entries: int = ENTRIES, resource_type: str | None = None) -> DataFrame:
    """(model_name, upstream_models, downstream_models, in_cycle) of every model.

    Counts leave the model itself out, also where it reaches itself (``in_cycle``). Both are exact up to 2 ** entries reached models; beyond,
    counts are estimates and a cycle may be missed. Only models of ``resource_type`` are counted and passed through, if given.
    """
    found = nodes.select("node_id", "model_name")
    own = F.theta_sketch_agg("node_id", F.lit(entries))
    singles = nodes.select("node_id").distinct().groupBy("node_id").agg(own.alias("own"))
    for name, direction in (("up", "upstream"), ("down", "downstream")):
        reach = reach_sketches(nodes, edges, direction, entries, resource_type).join(singles.hint("merge"), "node_id")
        itself = F.theta_sketch_estimate(F.theta_intersection("reached", "own")) > 0
        counted = reach.select("node_id", F.theta_sketch_estimate("reached").alias(f"{name}_n"), itself.alias(f"{name}_self"))
        found = found.join(counted.hint("merge"), "node_id", "left")
    def others(name: str):
        return F.coalesce(F.col(f"{name}_n") - F.col(f"{name}_self").cast("int"), F.lit(0)).cast("bigint")

    return found.select(
        "model_name",
        others("up").alias("upstream_models"),
        others("down").alias("downstream_models"),
        (F.coalesce("up_self", F.lit(False)) | F.coalesce("down_self", F.lit(False))).alias("in_cycle"),
    )
