"""Verification that several sources were consolidated into one target without loss."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.functions import values as V
from plumbline.functions.columns import any_null, as_list, col, comparable_cell, ratio, zero_if_null
from plumbline.functions.tally import on_side, side_counts, side_tally, total

# Name parts that mark a key column, and the status texts.
KEY_PARTS = ["id", "key", "pk", "primary_key"]
STATUS_OK = "OK"
STATUS_WARNING = "WARNING: Target has fewer rows than union of sources"


def _held_by_a_source(sources: int):
    return reduce(lambda a, b: a | b, [F.col(on_side(i)) > 0 for i in range(sources)])


def consolidation_check(
    sources: Mapping[str, DataFrame], target: DataFrame, key: str, target_name: str = "target"
) -> DataFrame:
    """One row: target rows, distinct source keys, rows and missing rows per source, status.

    Sources and target share one tally: one scan each and one shuffle of keys.
    """
    names = list(sources)
    last = len(names)
    in_target = F.col(on_side(last)) > 0
    no_key = any_null([key])
    per_source = []
    for i, name in enumerate(names):
        n = F.col(on_side(i))
        per_source.append(total(n).alias(f"{name}_row_count"))
        per_source.append(total(F.when(no_key | ~in_target, n)).alias(f"{name}_missing_count"))
    tally = side_tally([*sources.values(), target], [key])
    found = tally.agg(
        total(F.col(on_side(last))).alias("target_row_count"),
        F.count_if(~no_key & _held_by_a_source(last)).alias("union_row_count"),
        *per_source,
    )
    enough = F.col("union_row_count") <= F.col("target_row_count")
    return found.select(
        F.lit(", ".join(names)).alias("source_models"),
        F.lit(target_name).alias("target_model"),
        *[col(c) for c in found.columns],
        F.when(enough, STATUS_OK).otherwise(STATUS_WARNING).alias("validation_status"),
    )


def consolidation_missing_rows(
    sources: Mapping[str, DataFrame], target: DataFrame, keys: str | Sequence[str], mode: str = "set"
) -> DataFrame:
    """Per source, the keys the target lacks.

    ``set`` counts distinct key tuples with NULLs comparing equal (EXCEPT); ``rows`` counts
    every source row and a NULL key never matches (outer join).
    """
    if mode not in ("set", "rows"):
        raise ValueError("mode is 'set' or 'rows'")
    keys = as_list(keys)
    names = list(sources)
    in_target = F.col(on_side(len(names))) > 0
    counts = []
    for i in range(len(names)):
        n = F.col(on_side(i))
        if mode == "set":
            counts.append(F.count_if((n > 0) & ~in_target).alias(f"m{i}"))
        else:
            counts.append(total(F.when(any_null(keys) | ~in_target, n)).alias(f"m{i}"))
    wide = side_tally([*sources.values(), target], keys).agg(*counts)
    structs = [
        F.struct(F.lit(name).alias("source_model"), F.col(f"m{i}").alias("missing_row_count"))
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*structs)))


def consolidation_missing_sample(
    sources: Mapping[str, DataFrame], target: DataFrame, keys: str | Sequence[str], limit: int = 5
) -> DataFrame:
    """Up to ``limit`` whole rows per source whose key the target lacks, lowest keys first."""
    keys = as_list(keys)
    target_keys = target.select(*[col(k) for k in keys])
    samples = []
    for name, source in sources.items():
        order = [col(c) for c in [*keys, *[c for c in source.columns if c not in keys]]]
        lacking = source.join(target_keys, keys, "left_anti").orderBy(*order).limit(limit)
        samples.append(lacking.select(F.lit(name).alias("source_model"), *[col(c) for c in source.columns]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), samples)


def _missing_union(sources: Mapping[str, DataFrame], target: DataFrame, keys: list[str]) -> DataFrame:
    count = len(sources)
    tally = side_tally([*sources.values(), target], keys)
    return tally.filter(_held_by_a_source(count) & (F.col(on_side(count)) == 0)).select(*[col(k) for k in keys])


def consolidation_missing_union(
    sources: Mapping[str, DataFrame], target: DataFrame, keys: str | Sequence[str], sample: int | None = None
) -> DataFrame:
    """Distinct key tuples of all sources that the target lacks: their number, or a sample of them."""
    keys = as_list(keys)
    missing = _missing_union(sources, target, keys)
    if sample is not None:
        return missing.orderBy(*[col(k) for k in keys]).limit(sample)
    return missing.agg(F.count(F.lit(1)).alias("missing_union_count"))


def consolidation_missing_columns(
    source_catalog: DataFrame, target_catalog: DataFrame, key_columns: Sequence[str] = ()
) -> DataFrame:
    """Source columns, over column catalogs, that no target has and that are not keys.

    Catalogs have ``model_name, column_name, data_type, ordinal``; the first source (by model
    name) wins where several sources hold a column of the same name.
    """
    described = F.struct("model_name", "ordinal", "data_type")
    first = source_catalog.groupBy("column_name").agg(F.min(described).alias("first"))
    lacking = first.join(target_catalog.select("column_name"), "column_name", "left_anti")
    if key_columns:
        lacking = lacking.filter(~F.col("column_name").isin(list(key_columns)))
    return lacking.select(
        "column_name", F.col("first.data_type").alias("data_type"), F.col("first.model_name").alias("source_model")
    )


def consolidation_summary(
    sources: Mapping[str, DataFrame], target: DataFrame, target_name: str = "target"
) -> DataFrame:
    """One row per source and one for the target with row and column counts."""
    names = list(sources)
    counted = side_counts([*sources.values(), target])
    joined_names = F.lit(",".join(names))
    held = set(target.columns)
    structs = []
    for i, (name, columns) in enumerate([*((n, sources[n].columns) for n in names), (target_name, target.columns)]):
        is_source = i < len(names)
        common = len([c for c in columns if c in held])
        structs.append(
            F.struct(
                F.lit(name).alias("model_name"),
                joined_names.alias("source_models"),
                F.lit(target_name).alias("target_model"),
                F.col(on_side(i)).alias("row_count"),
                F.lit(len(columns)).cast("bigint").alias("column_count"),
                F.lit(common if is_source else None).cast("bigint").alias("common_columns"),
                F.lit(len(columns) - common if is_source else None).cast("bigint").alias("missing_columns"),
            )
        )
    return counted.select(F.inline(F.array(*structs)))


def common_columns(sources: Mapping[str, DataFrame], target: DataFrame) -> list[str]:
    """Columns that the target and every source have, in the order of the first source."""
    frames = list(sources.values())
    return [c for c in frames[0].columns if all(c in f.columns for f in [*frames[1:], target])]


def named_like_key(column: str) -> bool:
    return any(part in column.lower() for part in KEY_PARTS)


def key_columns_by_name(sources: Mapping[str, DataFrame], target: DataFrame, fallback: str = "all") -> list[str]:
    """Common columns named like keys; without any, all common columns (or the first)."""
    common = common_columns(sources, target)
    found = [c for c in common if named_like_key(c)]
    if found:
        return found
    return common if fallback == "all" else common[:1]


def infer_keys(sources: Mapping[str, DataFrame], target: DataFrame) -> DataFrame:
    """Candidate keys: common columns by name, with the distinct ratio the target's data shows."""
    common = common_columns(sources, target)
    totals = V.ledger_totals(V.value_ledger(target, common))
    matches = F.element_at(F.array(*[F.lit(named_like_key(c)) for c in common]), F.col(V.COLUMN) + 1)
    share = ratio(F.col("distinct"), F.col("rows"))
    return V.named(totals.withColumn("name_matches", matches), common).select(
        "column_name",
        "name_matches",
        F.col("rows").alias("row_count"),
        F.col("distinct").alias("distinct_count"),
        share.alias("distinct_ratio"),
        (F.col("name_matches") & (F.col("distinct") == F.col("rows"))).alias("is_key"),
    )


def confirm_keys(sources: Mapping[str, DataFrame], target: DataFrame, target_name: str = "target") -> DataFrame:
    """Candidate keys measured on every source and the target: single common columns and pairs of those named like keys.

    A candidate is a key of a relation if its values are distinct and never NULL there, and confirmed
    if it is so in all relations. Without a column named like a key, pairs of all common columns are measured.
    An empty relation confirms every candidate.
    """
    common = common_columns(sources, target)
    paired = [c for c in common if named_like_key(c)] or common
    candidates = [(c,) for c in common] + list(combinations(paired, 2))
    names = [", ".join(c) for c in candidates]
    measured = []
    for name, df in [*sources.items(), (target_name, target)]:
        single = {n: col(c[0]) for n, c in zip(names, candidates) if len(c) == 1}
        # a NULL part makes the pair NULL; the length tells where the first part ends
        pairs = {}
        for n, c in zip(names, candidates):
            if len(c) == 2:
                first, second = (comparable_cell(df, part).cast("string") for part in c)
                pairs[n] = F.concat(F.length(first).cast("string"), F.lit(":"), first, second)
        cells = df.select(*[value.alias(n) for n, value in {**single, **pairs}.items()])
        rows = df.agg(F.count(F.lit(1)).alias("row_count"))
        totals = V.named(V.ledger_totals(V.value_ledger(cells, names, nulls=False)), names)
        listed = rows.select("row_count", F.explode(F.array(*[F.lit(n) for n in names])).alias("column_name"))
        found = listed.join(totals.select("column_name", "non_null", "distinct"), "column_name", "left")
        measured.append(found.withColumn("relation_name", F.lit(name)))
    every = Window.partitionBy("column_name")  # one row per relation
    is_key = zero_if_null(F.col("distinct")) == F.col("row_count")
    return reduce(DataFrame.unionByName, measured).select(
        "relation_name",
        F.col("column_name").alias("key_columns"),
        "row_count",
        zero_if_null(F.col("distinct")).alias("distinct_count"),
        is_key.alias("is_key"),
        F.bool_and(is_key).over(every).alias("confirmed"),
    )
