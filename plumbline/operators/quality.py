"""Data-quality checks, check suggestions and model health."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions import values as V
from plumbline.functions.columns import any_null, as_list, col, in_rows, zero_if_null
from plumbline.functions.tally import on_side, side_tally, total

# What marks a foreign key, the field it points at, and the size of a value list.
FOREIGN_KEY_PART = "_id"
PARENT_FIELD = "id"
MAX_ACCEPTED_VALUES = 9
KEY_PREFIX, KEY_SUFFIX = "pk_", "_id"
FAILED = "fail"
HEALTH_DAYS = 30

_CHECK = ("check_name", "column_name", "n_failing")


def check_not_null(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Rows with a NULL, per column; all columns in one scan."""
    columns = as_list(columns)
    wide = df.agg(*[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    return in_rows(wide, [[F.lit("not_null"), F.lit(c), F.col(f"n{i}")] for i, c in enumerate(columns)], _CHECK)


def check_unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Non-null values that occur more than once, per column; all columns in one value ledger."""
    columns = as_list(columns)
    repeated = V.value_ledger(df, columns, nulls=False).groupBy(V.COLUMN).agg(
        F.count_if(F.col(V.COUNT) > 1).alias("n")
    )
    wide = repeated.agg(
        *[zero_if_null(F.max(F.when(F.col(V.COLUMN) == i, F.col("n")))).alias(f"n{i}") for i in range(len(columns))]
    )
    return in_rows(wide, [[F.lit("unique"), F.lit(c), F.col(f"n{i}")] for i, c in enumerate(columns)], _CHECK)


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value combinations without NULL that occur more than once."""
    columns = list(columns)
    groups = df.filter(~any_null(columns)).groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.lit("unique_combination").alias("check_name"),
        F.lit(", ".join(columns)).alias("column_name"),
        F.count_if(F.col("n") > 1).alias("n_failing"),
    )


def check_relationship(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows, and distinct values, whose non-null value the parent field lacks.

    Both sides meet as counted values, so a value held by a large share of the child rows
    is one row per map task.
    """
    children = child.select(col(column).alias("__value"))
    parents = parent.select(col(field).alias("__value"))
    n_child, n_parent = F.col(on_side(0)), F.col(on_side(1))
    orphan = F.col("__value").isNotNull() & (n_child > 0) & (n_parent == 0)
    return side_tally([children, parents], ["__value"]).agg(
        F.lit("relationship").alias("check_name"),
        F.lit(column).alias("column_name"),
        total(F.when(orphan, n_child)).alias("n_failing"),
        F.count_if(orphan).alias("n_failing_values"),
    )


def check_accepted_values(df: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    """Values outside the accepted set with their number of rows; NULL passes."""
    value = col(column)
    return (
        df.filter(value.isNotNull() & ~value.isin(list(accepted)))
        .groupBy(value.cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_failing"))
        .select(F.lit("accepted_values").alias("check_name"), F.lit(column).alias("column_name"), "value", "n_failing")
    )


def suggest_checks(
    df: DataFrame,
    checks: Sequence[str] = ("not_null", "unique", "relationships", "accepted_values"),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Proposed checks per column with their arguments and, where known, the failures today.

    not_null for every column, unique for the first, relationships for columns named like a
    foreign key, accepted values where a column holds one to nine distinct values. All
    numbers come from one value ledger.
    """
    columns = list(columns or df.columns)
    ledger = V.value_ledger(df, columns)
    per_column = ledger.groupBy(V.COLUMN).agg(
        total(F.when(~V.has_value(), F.col(V.COUNT))).alias("n_null"),
        F.count_if(V.has_value() & (F.col(V.COUNT) > 1)).alias("n_repeated"),
    )
    name = V.name_column(columns, F.col(V.COLUMN))
    fields = ("check_name", "args", "n_failing")

    def proposal(check: str, args: Column, failing: Column) -> Column:
        values = (F.lit(check), args.cast("string"), failing.cast("bigint"))
        return F.struct(*[v.alias(f) for v, f in zip(values, fields)])

    none = F.lit(None)
    foreign = F.contains(F.lower(name), F.lit(FOREIGN_KEY_PART))
    parent = F.concat(F.replace(name, F.lit(FOREIGN_KEY_PART), F.lit("")), F.lit("." + PARENT_FIELD))
    proposals = {
        "not_null": proposal("not_null", none, F.col("n_null")),
        "unique": F.when(F.col(V.COLUMN) == 0, proposal("unique", none, F.col("n_repeated"))),
        "relationships": F.when(foreign, proposal("relationships", parent, none)),
    }
    wanted = F.array(*[p for check, p in proposals.items() if check in checks])
    result = per_column.select(name.alias("column_name"), F.explode(F.array_compact(wanted)).alias("p")).select(
        "column_name", "p.*"
    )
    if "accepted_values" in checks:
        # NULL ranks last; at most eleven values per column and task survive, before any shuffle.
        order = Window.partitionBy(V.COLUMN).orderBy((~V.has_value()).cast("int"), *V.VALUE)
        few = (
            ledger.withColumn("rank", F.row_number().over(order))
            .filter((F.col("rank") <= MAX_ACCEPTED_VALUES + 2) & V.has_value() & (F.col(V.COUNT) > 0))
            .select(V.COLUMN, *V.VALUE, "rank")
        )
        # by value: the rank of long texts that begin alike goes by their digests
        in_order = F.array_sort(F.collect_list(F.struct(*V.VALUE, V.shown_value(df, columns).alias("text"))))
        lists = (
            V.restore_texts(df, columns, few)
            .groupBy(V.COLUMN)
            .agg(
                F.max("rank").alias("found"),
                F.array_join(F.transform(in_order, lambda e: e["text"]), ", ").alias("list"),
            )
            .filter(F.col("found") <= MAX_ACCEPTED_VALUES)
        )
        accepted = lists.select(
            name.alias("column_name"), proposal("accepted_values", F.col("list"), F.lit(0)).alias("p")
        )
        result = result.unionByName(accepted.select("column_name", "p.*"))
    return result.orderBy("column_name", "check_name")


def model_health(
    nodes: DataFrame,
    edges: DataFrame,
    runs: DataFrame,
    test_results: DataFrame,
    relation_stats: DataFrame,
    catalog: DataFrame,
    as_of: object = None,
    days: int = HEALTH_DAYS,
) -> DataFrame:
    """Dependencies, size, key columns, run times and test outcomes of every model in one job.

    Inputs: nodes ``(node_id, model_name)``, edges ``(upstream_id, downstream_id)``, runs
    ``(model_name, created_at, execution_time)``, test_results ``(model_name, created_at,
    status)``, relation_stats ``(model_name, row_count)``, catalog ``(model_name,
    column_name)``. Everything is aggregated per model before it meets the nodes, so no join
    sees more than one row per model.
    """
    now = (F.current_timestamp() if as_of is None else F.lit(as_of)).cast("timestamp_ntz")
    since = (now.cast("date") - F.make_dt_interval(F.lit(days))).cast("timestamp_ntz")
    ids = nodes.select("node_id")
    upstream_known = edges.join(ids.withColumnRenamed("node_id", "upstream_id"), "upstream_id", "left_semi")
    downstream_known = edges.join(ids.withColumnRenamed("node_id", "downstream_id"), "downstream_id", "left_semi")
    counted = F.count(F.lit(1))
    upstream = upstream_known.groupBy(F.col("downstream_id").alias("node_id")).agg(counted.alias("n_up"))
    downstream = downstream_known.groupBy(F.col("upstream_id").alias("node_id")).agg(counted.alias("n_down"))
    is_key = F.startswith(F.col("column_name"), F.lit(KEY_PREFIX)) | F.endswith(
        F.col("column_name"), F.lit(KEY_SUFFIX)
    )
    columns = catalog.groupBy("model_name").agg(
        counted.alias("column_count"), F.count_if(is_key).alias("key_column_count")
    )
    recent_runs = (
        runs.filter(F.col("created_at") >= since)
        .groupBy("model_name")
        .agg(
            F.max("created_at").alias("last_run"),
            F.avg("execution_time").alias("avg_execution_time"),
            F.max("execution_time").alias("max_execution_time"),
        )
    )
    recent_tests = (
        test_results.filter(F.col("created_at") >= since)
        .groupBy("model_name")
        .agg(counted.alias("n_tests"), F.count_if(F.col("status") == FAILED).alias("n_failed"))
    )
    return (
        nodes.select("node_id", "model_name")
        .join(upstream, "node_id", "left")
        .join(downstream, "node_id", "left")
        .join(relation_stats.select("model_name", "row_count"), "model_name", "left")
        .join(columns, "model_name", "left")
        .join(recent_runs, "model_name", "left")
        .join(recent_tests, "model_name", "left")
        .select(
            "model_name",
            zero_if_null(F.col("n_up")).alias("upstream_dependencies"),
            zero_if_null(F.col("n_down")).alias("downstream_dependencies"),
            "row_count",
            "column_count",
            "key_column_count",
            "last_run",
            "avg_execution_time",
            "max_execution_time",
            zero_if_null(F.col("n_tests")).alias("total_tests"),
            zero_if_null(F.col("n_failed")).alias("failed_tests"),
            now.alias("report_generated_at"),
        )
    )


def run_checks(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (), combinations: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Several declared checks of one table as one frame ``(check_name, column_name, n_failing)``."""
    parts = []
    if not_null:
        parts.append(check_not_null(df, not_null))
    if unique:
        parts.append(check_unique(df, unique))
    parts += [check_unique_combination(df, c) for c in combinations]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def declared_checks(models: Mapping[str, tuple[DataFrame, dict]]) -> DataFrame:
    """:func:`run_checks` over several tables, with the table name in front."""
    parts = [
        run_checks(df, **checks).select(F.lit(name).alias("model_name"), "*") for name, (df, checks) in models.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
