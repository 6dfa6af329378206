"""Schema comparison, snapshots, change logs and semantic versions over column catalogs.

A catalog holds ``model_name, column_name, data_type, char_len, is_nullable, ordinal`` of
any number of models; every operator treats all of them in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.columns import STRING, col, family, in_rows
from plumbline.operators.lineage import graph_walk

# Names of changes, bumps and risks.
ADDED, REMOVED, CHANGED = "added", "removed", "changed"
MAJOR, MINOR, PATCH = "major", "minor", "patch"
RISKS = {"removed": "High", "changed": "Medium", "added": "Low"}


def column_catalog(models: Mapping[str, DataFrame], measure: bool = False) -> DataFrame:
    """The catalog of the given frames.

    Declared types come from the schema. With ``measure`` one scan per frame adds what the
    data shows: the longest text and whether a NULL occurs (else both come from the schema).
    """
    parts = []
    for name, df in models.items():
        fields = df.schema.fields
        aggregates: list[Column] = [F.count(F.lit(1)).alias("rows")]
        rows = []
        for i, field in enumerate(fields):
            is_text = family(field.dataType) == STRING
            length, nullable = F.lit(None).cast("bigint"), F.lit(field.nullable)
            if measure:
                aggregates.append(F.count(col(field.name)).alias(f"n{i}"))
                nullable = F.col(f"n{i}") < F.col("rows")
                if is_text:
                    aggregates.append(F.max(F.length(col(field.name))).cast("bigint").alias(f"l{i}"))
                    length = F.col(f"l{i}")
            described = [F.lit(name), F.lit(field.name), F.lit(field.dataType.simpleString())]
            rows.append([*described, length, nullable, F.lit(i + 1).cast("bigint")])
        base = df.agg(*aggregates) if measure else df.sparkSession.range(1)
        names = ("model_name", "column_name", "data_type", "char_len", "is_nullable", "ordinal")
        parts.append(in_rows(base, rows, names))
    return reduce(DataFrame.unionByName, parts)


def _paired(old: DataFrame, new: DataFrame, lower_names: bool = False) -> DataFrame:
    """Full outer join of two catalogs on (model, column) with ``old_`` and ``new_`` attributes."""

    def side(catalog: DataFrame, prefix: str) -> DataFrame:
        name = F.lower("column_name") if lower_names else F.col("column_name")
        described = [
            F.col(c).alias(prefix + c) for c in catalog.columns if c not in ("model_name", "column_name", "ordinal")
        ]
        return catalog.select("model_name", name.alias("column_name"), *described, F.lit(True).alias(prefix + "here"))

    return side(old, "old_").join(side(new, "new_"), ["model_name", "column_name"], "full_outer")


def _change(compare: Sequence[str]) -> Column:
    differs = reduce(lambda a, b: a | b, [~F.col("old_" + c).eqNullSafe(F.col("new_" + c)) for c in compare])
    return (
        F.when(F.col("old_here").isNull(), ADDED)
        .when(F.col("new_here").isNull(), REMOVED)
        .when(differs, CHANGED)
    )


def schema_diff(
    old: DataFrame, new: DataFrame, compare: Sequence[str] = ("data_type", "char_len", "is_nullable")
) -> DataFrame:
    """Columns added, removed or changed between two catalogs."""
    shown = [F.col(side + c) for c in compare for side in ("old_", "new_")]
    return (
        _paired(old, new)
        .withColumn("change", _change(compare))
        .filter(F.col("change").isNotNull())
        .select("model_name", "column_name", "change", *shown)
    )


def schema_diff_types(old: DataFrame, new: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Type-only difference per model: how many columns are common, added, removed, retyped."""
    change = F.coalesce(_change(["data_type"]), F.lit("common"))
    return (
        _paired(old, new, ignore_case)
        .groupBy("model_name")
        .agg(
            F.count_if(change == "common").alias("common_columns"),
            F.count_if(change == ADDED).alias("added_columns"),
            F.count_if(change == REMOVED).alias("removed_columns"),
            F.count_if(change == CHANGED).alias("type_changes"),
        )
    )


def schema_hash() -> Column:
    """MD5 of the JSON list of ``name:type`` in column order, as an aggregate over a catalog.

    The list is as long as a table is wide, whatever the number of rows.
    """
    described = F.struct("ordinal", F.concat_ws(":", "column_name", "data_type").alias("text"))
    return F.md5(F.to_json(F.transform(F.array_sort(F.collect_list(described)), lambda e: e["text"])))


def schema_snapshot(
    catalog: DataFrame,
    row_counts: DataFrame | None,
    snapshot_date: object = None,
    by: Sequence[str] = ("model_name",),
) -> DataFrame:
    """History rows ``(model_name, snapshot_date, row_count, column_count, hash_value)`` of every model."""
    taken = (F.current_date() if snapshot_date is None else F.lit(snapshot_date)).cast("date")
    hashed = catalog.groupBy(*by).agg(F.count(F.lit(1)).alias("column_count"), schema_hash().alias("hash_value"))
    if row_counts is None:
        hashed = hashed.withColumn("row_count", F.lit(None).cast("bigint"))
    else:
        hashed = hashed.join(row_counts.select(*by, "row_count"), list(by), "left")
    return hashed.select(*by, taken.alias("snapshot_date"), "row_count", "column_count", "hash_value")


def content_hash(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row ``(row_count, content_hash)`` that tells the content of a table, whatever the order of its rows.

    The hash is the sum of 60 bits of the MD5 of every row, so repeated rows do not cancel. A cell counts as its text
    with its length in front, a NULL as ``n``; an empty table has hash 0. Map columns are not supported.
    """
    cells = [col(c).cast("string") for c in (columns or df.columns)]
    texts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("n")) for c in cells]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 15), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(bits), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), total.cast("string").alias("content_hash"))


def schema_change_log(history: DataFrame, order: str = "snapshot_date") -> DataFrame:
    """Snapshots whose hash differs from the model's previous one."""
    in_time = Window.partitionBy("model_name").orderBy(order)
    return (
        history.select(
            "model_name",
            F.col(order),
            F.lag("hash_value").over(in_time).alias("previous_hash"),
            "hash_value",
            F.lag("column_count").over(in_time).alias("previous_column_count"),
            "column_count",
        )
        .filter(F.col("previous_hash").isNotNull() & (F.col("previous_hash") != F.col("hash_value")))
    )


def semantic_version(history: DataFrame, version: str = "version_no") -> DataFrame:
    """Semantic version of every schema version of every model.

    ``history`` is a catalog with a version number per row. A column removed, retyped or
    tightened to NOT NULL is a major bump; a column added or relaxed a minor one; anything
    else a patch. The first version is 1.0.0. A version that follows a gap has no schema to
    compare with and counts as minor.
    """
    v = F.col(version)
    present = history.select("model_name", v.alias("v")).distinct()
    columns = history.select("model_name", v.alias("v"), "column_name", "data_type", "is_nullable")
    before = columns.select(
        "model_name",
        (F.col("v") + 1).alias("v"),
        "column_name",
        F.col("data_type").alias("old_type"),
        F.col("is_nullable").alias("old_nullable"),
        F.lit(True).alias("was"),
    )
    paired = columns.withColumn("here", F.lit(True)).join(before, ["model_name", "v", "column_name"], "full_outer")
    retyped = F.col("data_type") != F.col("old_type")
    tightened = F.col("old_nullable") & ~F.col("is_nullable")
    relaxed = ~F.col("old_nullable") & F.col("is_nullable")
    bump = (
        F.when(F.col("here").isNull(), 2)
        .when(F.col("was").isNull(), 1)
        .when(retyped | tightened, 2)
        .when(relaxed, 1)
        .otherwise(0)
    )
    bumps = paired.groupBy("model_name", "v").agg(F.max(bump).alias("bump"))
    in_time = Window.partitionBy("model_name").orderBy("v")
    ordered = present.join(bumps, ["model_name", "v"], "left").withColumn("prev", F.lag("v").over(in_time))
    kind = (
        F.when(F.col("prev").isNull(), "first")
        .when(F.col("prev") != F.col("v") - 1, MINOR)
        .when(F.col("bump") == 2, MAJOR)
        .when(F.col("bump") == 1, MINOR)
        .otherwise(PATCH)
    )
    by_major = Window.partitionBy("model_name", "major").orderBy("v")
    by_minor = Window.partitionBy("model_name", "major", "minor").orderBy("v")

    def running(what: str, over) -> Column:
        return F.sum(F.when(F.col("bump_kind") == what, 1).otherwise(0)).over(over).cast("bigint")

    return (
        ordered.withColumn("bump_kind", kind)
        .withColumn("major", F.lit(1).cast("bigint") + running(MAJOR, in_time))
        .withColumn("minor", running(MINOR, by_major))
        .withColumn("patch", running(PATCH, by_minor))
        .select(
            "model_name",
            F.col("v").alias(version),
            "bump_kind",
            F.concat_ws(".", "major", "minor", "patch").alias("version"),
        )
    )


def migration_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed (type or nullability), removed and added columns with old and new attributes."""
    return schema_diff(old, new, ("data_type", "is_nullable"))


def migration_impact(
    nodes: DataFrame,
    edges: DataFrame,
    old: DataFrame,
    new: DataFrame,
    max_depth: int | None = None,
) -> DataFrame:
    """Downstream models of every model whose columns changed, with depth and risk.

    Risk is High if the model lost a column, Medium if one changed, else Low. Catalogs name
    models as ``nodes`` does; models without any difference are not walked.
    """
    severity = F.max(
        F.when(F.col("change") == REMOVED, 3).when(F.col("change") == CHANGED, 2).otherwise(1)
    )
    changed = migration_columns(old, new).groupBy("model_name").agg(severity.alias("severity"))
    risk = F.element_at(F.array(*[F.lit(RISKS[k]) for k in (ADDED, CHANGED, REMOVED)]), F.col("severity"))
    walked = graph_walk(
        nodes,
        edges,
        changed.select("model_name"),
        direction="downstream",
        max_depth=max_depth,
        resource_type="model",
    )
    affected = walked.filter(F.col("depth") > 0).select("start_name", "name", "referenced_by", "depth").distinct()
    return affected.join(changed.withColumnRenamed("model_name", "start_name"), "start_name", "inner").select(
        F.col("start_name").alias("changed_model"), "name", "referenced_by", "depth", risk.alias("risk")
    )
