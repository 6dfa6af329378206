"""Comparison of two versions (or N environments) of one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions import values as V
from plumbline.functions.columns import (
    any_null,
    as_list,
    col,
    comparable_cell,
    dtype_of,
    family,
    holds_map,
    percent,
    ratio,
    without_maps,
    zero_if_null,
)
from plumbline.functions.tally import SIDE, on_side, side_counts, side_tally, tag_sides, total
from plumbline.session import cut_lineage

# The labels of a compared cell.
SAME = "SAME"
NULL_TO_VALUE = "NULL→VALUE"
VALUE_TO_NULL = "VALUE→NULL"
DIFFERENT = "DIFFERENT"

BROADCAST_KEYS = 100_000  # repeated keys that are broadcast, most frequent first

_OLD, _NEW = "__old_", "__new_"


# ---------------------------------------------------------------- column comparison


def _compared(old: DataFrame, new: DataFrame, keys: list[str], columns: Sequence[str] | None) -> list[str]:
    return [c for c in (columns or [c for c in old.columns if c in new.columns]) if c not in keys]


def _same_kind(old: DataFrame, new: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Columns whose types cannot be compared as they are become text on both sides, maps their entries in order of the keys."""
    mixed = [c for c in columns if family(dtype_of(old, c)) != family(dtype_of(new, c))]
    as_text = {c: col(c).cast("string") for c in mixed}
    maps = [c for c in columns if c not in mixed and holds_map(dtype_of(old, c))]
    sides = [df.withColumns({**as_text, **{c: without_maps(col(c), dtype_of(df, c)) for c in maps}}) for df in (old, new)]
    return sides[0], sides[1]


def _survey_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[list[DataFrame], bool]:
    """Keys with several rows on a side, and whether NULL keys occur; reads key columns only.

    Up to BROADCAST_KEYS repeated keys are one list to broadcast. Beyond that the most frequent
    ones are broadcast and the rest, each holding at most 1 / BROADCAST_KEYS of the rows, is
    a second list to shuffle.
    """
    most = F.greatest(on_side(0), on_side(1))
    tally = side_tally([old, new], keys).select(*[col(k) for k in keys], most.alias("__most"))
    odd = cut_lineage(tally.filter((F.col("__most") > 1) | any_null(keys)))
    found = odd.agg(F.count_if(any_null(keys)), F.count_if(~any_null(keys))).first()
    null_keys, repeated = found[0] > 0, odd.filter(~any_null(keys))
    names = [col(k) for k in keys]
    if found[1] == 0:
        return [], null_keys
    if found[1] <= BROADCAST_KEYS:
        return [F.broadcast(repeated.select(*names))], null_keys
    hot = cut_lineage(repeated.orderBy(F.col("__most").desc(), *names).limit(BROADCAST_KEYS).select(*names))
    # a table of keys in memory, so that rows are not sorted to be looked up
    rest = repeated.select(*names).join(F.broadcast(hot), keys, "left_anti").hint("shuffle_hash")
    return [F.broadcast(hot), rest], null_keys


def _without(df: DataFrame, repeated: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(lambda left, listed: left.join(listed, keys, "left_anti"), repeated, df)


def _only(df: DataFrame, repeated: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(DataFrame.union, [df.join(listed, keys, "left_semi") for listed in repeated])


def _sides(
    old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]
) -> tuple[DataFrame, DataFrame]:
    def side(df: DataFrame, prefix: str, flag: str) -> DataFrame:
        cells = [comparable_cell(df, c).alias(f"{prefix}{i}") for i, c in enumerate(columns)]
        return df.select(*[col(k) for k in keys], *cells, F.lit(True).alias(flag))

    return side(old, _OLD, "__in_old"), side(new, _NEW, "__in_new")


def _keyless(old_side: DataFrame, new_side: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a NULL key match nothing, so they bypass the join instead of meeting in one task."""
    return old_side.filter(any_null(keys)).unionByName(new_side.filter(any_null(keys)), allowMissingColumns=True)


def _matched_once(
    old_side: DataFrame, new_side: DataFrame, keys: list[str], repeated: list[DataFrame]
) -> DataFrame:
    old_side, new_side = (_without(side.filter(~any_null(keys)), repeated, keys) for side in (old_side, new_side))
    return old_side.join(new_side, keys, "full_outer")


def _label(i: int) -> Column:
    old, new = F.col(f"{_OLD}{i}"), F.col(f"{_NEW}{i}")
    return (
        F.when(old.eqNullSafe(new), SAME)
        .when(old.isNull(), NULL_TO_VALUE)
        .when(new.isNull(), VALUE_TO_NULL)
        .otherwise(DIFFERENT)
    )


_COUNTERS = ("same_count", "diff_count", "null_to_value_count", "value_to_null_count")


def _cell_counters(i: int) -> list[Column]:
    old, new = F.col(f"{_OLD}{i}"), F.col(f"{_NEW}{i}")
    return [
        F.count_if(old.eqNullSafe(new)),
        F.count_if(old != new),
        F.count_if(old.isNull() & new.isNotNull()),
        F.count_if(old.isNotNull() & new.isNull()),
    ]


def _pair_counters(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key and column the counters of all row pairs, from value counts instead of pairs.

    ``rows`` are both sides with their side number. With o and n rows of a key, a value held
    by a and b of them adds a*b equal pairs; a key absent on one side pairs with one all-NULL
    row, and so does every row with a NULL key.
    """
    key_names = [f"__k{i}" for i in range(len(keys))]
    carried = [col(k).alias(n) for k, n in zip(keys, key_names)]
    by_value = (
        V.value_rows(rows, columns, *carried, F.col(SIDE))
        .groupBy(*key_names, V.COLUMN, *V.VALUE)
        .agg(F.count_if(F.col(SIDE) == 0).alias("o"), F.count_if(F.col(SIDE) == 1).alias("n"))
    )
    empty = ~V.has_value()
    by_key = by_value.groupBy(*key_names, V.COLUMN).agg(
        F.sum("o").alias("o"),
        F.sum("n").alias("n"),
        total(F.when(empty, F.col("o"))).alias("o_null"),
        total(F.when(empty, F.col("n"))).alias("n_null"),
        total(F.when(~empty, F.col("o") * F.col("n"))).alias("equal"),
    )
    o, n, o_null, n_null, equal = (F.col(c) for c in ("o", "n", "o_null", "n_null", "equal"))
    unmatched = any_null(key_names) | (o == 0) | (n == 0)

    def either(alone: Column, paired: Column, name: str) -> Column:
        return F.when(unmatched, alone).otherwise(paired).alias(name)

    zero = F.lit(0).cast("bigint")
    return by_key.select(
        *[F.col(n_).alias(k) for k, n_ in zip(keys, key_names)],
        V.COLUMN,
        either(o_null + n_null, equal + o_null * n_null, _COUNTERS[0]),
        either(zero, (o - o_null) * (n - n_null) - equal, _COUNTERS[1]),
        either(n - n_null, o_null * (n - n_null), _COUNTERS[2]),
        either(o - o_null, (o - o_null) * n_null, _COUNTERS[3]),
        either(o, zero, "only_in_old"),
        either(n, zero, "only_in_new"),
    )


def _repeated_counters(
    old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], repeated: list[DataFrame]
) -> DataFrame:
    rows = _only(tag_sides([old, new], [*keys, *columns]), repeated, keys)
    counted = [*_COUNTERS, "only_in_old", "only_in_new"]
    return _pair_counters(rows, keys, columns).groupBy(V.COLUMN).agg(*[total(F.col(c)).alias(c) for c in counted])


def column_compare_by_key(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The counters of :func:`column_compare` per key and column, in long form.

    For keys with many rows on both sides, whose pairs :func:`column_compare_rows` would list:
    here they are counted without being formed.
    """
    keys = as_list(key)
    columns = _compared(old, new, keys, columns)
    old, new = _same_kind(old, new, columns)
    found = _pair_counters(tag_sides([old, new], [*keys, *columns]), keys, columns)
    return V.named(found, columns).select(*[col(k) for k in keys], "column_name", *_COUNTERS)


def column_compare(
    old: DataFrame,
    new: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str] | None = None,
    labels: tuple[str, str] = ("old", "new"),
    row_status: bool = False,
    keys_are_unique: bool = False,
) -> DataFrame:
    """One row of cell counters per compared column over the full outer join on the key.

    A pass over the key columns finds repeated and NULL keys. Repeated keys are settled from
    value counts, rows with a NULL key match nothing, the rest is one shuffle join of unique
    keys. ``keys_are_unique`` skips that pass where the caller already knows. ``row_status`` adds the number of rows present on one side only.
    """
    keys = as_list(key)
    columns = _compared(old, new, keys, columns)
    old, new = _same_kind(old, new, columns)
    repeated, null_keys = ([], True) if keys_are_unique else _survey_keys(old, new, keys)
    old_side, new_side = _sides(old, new, keys, columns)
    joined = _matched_once(old_side, new_side, keys, repeated)
    if null_keys:
        joined = joined.unionByName(_keyless(old_side, new_side, keys))
    name = F.lit(f"{labels[0]} vs {labels[1]}").alias("comparison_name")
    status = [
        F.count_if(F.col("__in_new").isNull()).alias("only_in_old"),
        F.count_if(F.col("__in_old").isNull()).alias("only_in_new"),
    ]
    counters = [
        counter.alias(f"{c}_{suffix}")
        for i, c in enumerate(columns)
        for suffix, counter in zip(_COUNTERS, _cell_counters(i))
    ]
    once = joined.agg(*counters, *status)
    shown = [f"{c}_{suffix}" for c in columns for suffix in _COUNTERS]
    extra = ["only_in_old", "only_in_new"] if row_status else []
    if not repeated:
        return once.select(name, *[col(c) for c in shown + extra])
    per_column = _repeated_counters(old, new, keys, columns, repeated)
    more = per_column.agg(
        *[
            F.sum(F.when(F.col(V.COLUMN) == i, F.col(suffix))).alias(f"{c}_{suffix}")
            for i, c in enumerate(columns)
            for suffix in _COUNTERS
        ],
        *[F.sum(F.when(F.col(V.COLUMN) == 0, F.col(s))).alias(s) for s in ("only_in_old", "only_in_new")],
    )
    both = once.unionByName(more)
    return both.agg(*[F.sum(col(c)).alias(c) for c in [*shown, "only_in_old", "only_in_new"]]).select(
        name, *[col(c) for c in shown + extra]
    )


def column_compare_rows(
    old: DataFrame,
    new: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str] | None = None,
    keys_are_unique: bool = False,
    max_pairs: int | None = None,
) -> DataFrame:
    """The labelled rows behind :func:`column_compare`: key plus ``<column>_comparison``.

    A repeated key yields one row per pair, which is what the full outer join is defined to
    give. With ``max_pairs``, more rows than that raise an error instead;
    :func:`column_compare_by_key` answers such keys exactly without forming pairs.
    """
    keys = as_list(key)
    columns = _compared(old, new, keys, columns)
    old, new = _same_kind(old, new, columns)
    repeated, null_keys = ([], True) if keys_are_unique else _survey_keys(old, new, keys)
    old_side, new_side = _sides(old, new, keys, columns)
    parts = [_matched_once(old_side, new_side, keys, repeated)]
    if null_keys:
        parts.append(_keyless(old_side, new_side, keys))
    if repeated:
        found = 0.0
        if max_pairs is not None:
            tally = _only(side_tally([old, new], keys), repeated, keys)
            pairs = F.col(on_side(0)).cast("double") * F.col(on_side(1)).cast("double")
            found = tally.agg(F.sum(pairs)).first()[0]
        if max_pairs is not None and found > max_pairs:
            raise ValueError(f"{found:.0f} pairs of rows share a key: use column_compare_by_key, or raise max_pairs")
        several_old, several_new = _only(old_side, repeated, keys), _only(new_side, repeated, keys)
        parts += [
            several_old.join(several_new, keys, "inner"),
            several_old.join(several_new, keys, "left_anti"),
            several_new.join(several_old, keys, "left_anti"),
        ]
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return joined.select(
        *[col(k) for k in keys], *[_label(i).alias(f"{c}_comparison") for i, c in enumerate(columns)]
    )


# ---------------------------------------------------------------- key reconciliation


def _key_counts(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """old_rows, new_rows, old_only, new_only; a NULL key never matches."""
    keys = as_list(key)
    n_old, n_new = F.col(on_side(0)), F.col(on_side(1))
    alone = any_null(keys)
    return side_tally([old, new], keys).agg(
        total(n_old).alias("old_rows"),
        total(n_new).alias("new_rows"),
        total(F.when(alone | (n_new == 0), n_old)).alias("old_only"),
        total(F.when(alone | (n_old == 0), n_new)).alias("new_only"),
    )


def _difference() -> list[Column]:
    gap = F.abs(F.col("new_rows") - F.col("old_rows"))
    return [
        gap.alias("record_count_difference"),
        percent(gap, F.col("old_rows"), 2).alias("percentage_change"),
    ]


def key_reconcile(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], labels: tuple[str, str] = ("old", "new")
) -> DataFrame:
    """Row counts of both versions, rows whose key is missing on the other side, relative change."""
    return _key_counts(old, new, key).select(
        F.lit(labels[0]).alias("old_model"),
        F.lit(labels[1]).alias("new_model"),
        F.col("old_rows").alias("old_record_count"),
        F.col("new_rows").alias("new_record_count"),
        F.col("old_only").alias("records_in_old_not_in_new"),
        F.col("new_only").alias("records_in_new_not_in_old"),
        *_difference(),
    )


def key_reconcile_min(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], labels: tuple[str, str] = ("old", "new")
) -> DataFrame:
    """:func:`key_reconcile` without difference and percentage."""
    return _key_counts(old, new, key).select(
        F.lit(labels[0]).alias("old_model"),
        F.lit(labels[1]).alias("new_model"),
        F.col("old_rows").alias("old_record_count"),
        F.col("new_rows").alias("new_record_count"),
        F.col("old_only").alias("keys_missing_in_new"),
        F.col("new_only").alias("keys_missing_in_old"),
    )


def key_reconcile_schemas(
    a: DataFrame, b: DataFrame, key: str | Sequence[str], model: str, schemas: tuple[str, str] = ("a", "b")
) -> DataFrame:
    """:func:`key_reconcile` of one table held in two schemas."""
    return _key_counts(a, b, key).select(
        F.lit(model).alias("model_name"),
        F.lit(schemas[0]).alias("schema_a"),
        F.lit(schemas[1]).alias("schema_b"),
        F.col("old_rows").alias("schema_a_row_count"),
        F.col("new_rows").alias("schema_b_row_count"),
        F.col("old_only").alias("rows_in_a_not_in_b"),
        F.col("new_only").alias("rows_in_b_not_in_a"),
        *_difference(),
    )


def missing_key_sample(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], limit: int = 5
) -> DataFrame:
    """Up to ``limit`` whole rows per direction whose key the other side lacks, lowest keys first.

    Only keys are compared; the rows of the ``limit`` lowest ones are read again.
    """
    keys = as_list(key)

    def one_way(left: DataFrame, right: DataFrame, direction: str) -> DataFrame:
        order = [col(c) for c in [*keys, *[c for c in left.columns if c not in keys]]]
        names = [col(k) for k in keys]
        lowest = left.select(*names).join(right.select(*names), keys, "left_anti").orderBy(*names).limit(limit)
        lowest = lowest.distinct().select(*[col(k).alias(f"__low{i}") for i, k in enumerate(keys)])
        same = reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"__low{i}")) for i, k in enumerate(keys)])
        lacking = left.join(F.broadcast(lowest), same, "left_semi").orderBy(*order).limit(limit)
        return lacking.select(F.lit(direction).alias("direction"), *[col(c) for c in left.columns])

    return one_way(old, new, "missing_in_new").unionByName(
        one_way(new, old, "missing_in_old"), allowMissingColumns=True
    )


# ---------------------------------------------------------------- whole rows, environments


def same_type_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of ``b`` that ``a`` has under the same name and type."""
    types = {f.name: f.dataType for f in a.schema.fields}
    return [f.name for f in b.schema.fields if types.get(f.name) == f.dataType]


def row_compare(
    main: DataFrame | None,
    current: DataFrame | None,
    model: str,
    schemas: tuple[str, str] = ("main", "current"),
    multiset: bool = False,
) -> DataFrame:
    """Row counts and whole-row differences both ways over the common columns of equal type.

    Distinct rows are compared (EXCEPT); ``multiset`` counts surplus copies instead (EXCEPT
    ALL). A missing side (None) gives the counts that exist and NULL differences.
    """
    names = [
        F.lit(model).alias("model_name"),
        F.lit(schemas[0]).alias("main_schema"),
        F.lit(schemas[1]).alias("current_schema"),
    ]
    outputs = ("main_row_count", "current_row_count", "rows_in_main_not_current", "rows_in_current_not_main")
    if main is None or current is None:
        present = main if main is not None else current
        if present is None:
            raise ValueError("row_compare needs at least one side")
        absent = F.lit(None).cast("bigint")
        counted = F.count(F.lit(1))
        row_counts = [counted if main is not None else absent, counted if current is not None else absent]
        return present.agg(*[c.alias(n) for c, n in zip([*row_counts, absent, absent], outputs)]).select(
            *names, *outputs
        )
    columns = same_type_columns(main, current)
    n_main, n_current = F.col(on_side(0)), F.col(on_side(1))
    if multiset:
        lost, gained = F.greatest(n_main - n_current, F.lit(0)), F.greatest(n_current - n_main, F.lit(0))
    else:
        lost = F.when((n_main > 0) & (n_current == 0), 1).otherwise(0)
        gained = F.when((n_current > 0) & (n_main == 0), 1).otherwise(0)
    whole_rows = [df.select(*[comparable_cell(df, c).alias(c) for c in columns]) for df in (main, current)]
    return (
        side_tally(whole_rows, columns)
        .agg(
            total(n_main).alias(outputs[0]),
            total(n_current).alias(outputs[1]),
            total(lost).alias(outputs[2]),
            total(gained).alias(outputs[3]),
        )
        .select(*names, *outputs)
    )


def env_chain_compare(
    environments: Mapping[str, DataFrame | None], model: str, key_columns: Sequence[str] | None = None
) -> DataFrame:
    """Compare each environment with the one before it; one row per adjacent pair.

    All environments are tallied together, so a chain of any length costs one scan per
    environment and one shuffle. With ``key_columns`` the distinct keys lacking on either side
    are counted too. An environment that is None gives NULL differences.
    """
    names = list(environments)
    present = [n for n in names if environments[n] is not None]
    sides = [environments[n] for n in present]
    rows_of = {n: F.col(f"rows{present.index(n)}") if n in present else F.lit(None).cast("bigint") for n in names}
    pairs = list(zip(names, names[1:]))
    if key_columns is None:
        counted = side_counts(sides)
        flat = counted.select(*[F.col(on_side(i)).alias(f"rows{i}") for i in range(len(present))])
    else:
        aggregates = [total(F.col(on_side(i))).alias(f"rows{i}") for i in range(len(present))]
        for p, (before, after) in enumerate(pairs):
            if before in present and after in present:
                held = F.col(on_side(present.index(before))) > 0, F.col(on_side(present.index(after))) > 0
                aggregates += [
                    F.count_if(held[0] & ~held[1]).alias(f"lost{p}"),
                    F.count_if(held[1] & ~held[0]).alias(f"gained{p}"),
                ]
        flat = side_tally(sides, list(key_columns)).agg(*aggregates)
    structs = []
    for p, (before, after) in enumerate(pairs):
        known = before in present and after in present
        gap = rows_of[after] - rows_of[before] if known else F.lit(None).cast("bigint")
        fields = [
            F.lit(model).alias("model_name"),
            F.lit(before).alias("baseline_env"),
            F.lit(after).alias("compare_env"),
            rows_of[before].alias("baseline_rows"),
            rows_of[after].alias("compare_rows"),
            gap.alias("absolute_diff"),
            percent(gap, rows_of[before], 2).alias("percent_diff"),
        ]
        if key_columns is not None:
            nothing = F.lit(None).cast("bigint")
            fields += [
                (F.col(f"lost{p}") if known else nothing).alias("rows_in_baseline_not_compare"),
                (F.col(f"gained{p}") if known else nothing).alias("rows_in_compare_not_baseline"),
            ]
        structs.append(F.struct(*fields))
    return flat.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- column statistics


def _two_ledgers(a: DataFrame, b: DataFrame, a_columns: list[str], b_columns: list[str]) -> DataFrame:
    """Totals per side and column position, both sides in one shuffle."""
    rows = V.value_rows(a, a_columns, F.lit(0).alias(SIDE)).union(V.value_rows(b, b_columns, F.lit(1).alias(SIDE)))
    ledger = rows.groupBy(SIDE, V.COLUMN, *V.VALUE).agg(F.count(F.lit(1)).alias(V.COUNT))
    return V.ledger_totals(ledger, SIDE)


def _sketched_totals(a: DataFrame, b: DataFrame, a_columns: list[str], b_columns: list[str]) -> DataFrame:
    """The same totals with sketched distinct counts: one scan per side and no shuffle of values."""

    def one(df: DataFrame, columns: list[str], side: int) -> DataFrame:
        found = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(col(c)).alias(f"f{i}") for i, c in enumerate(columns)],
            *[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(columns)],
        )
        cells = [
            F.struct(
                F.lit(side).alias(SIDE),
                F.lit(i).alias(V.COLUMN),
                F.col("rows"),
                F.col(f"f{i}").alias("non_null"),
                F.col(f"d{i}").alias("distinct"),
            )
            for i in range(len(columns))
        ]
        return found.select(F.inline(F.array(*cells)))

    return one(a, a_columns, 0).union(one(b, b_columns, 1))


def stat_compare(main: DataFrame, current: DataFrame, approx: bool = False) -> DataFrame:
    """One wide row: row counts, added and removed columns, non-null and distinct counts per column.

    Columns are matched by name regardless of case. ``approx`` sketches the distinct counts.
    """
    by_lower = {c.lower(): c for c in current.columns}
    common = [c for c in main.columns if c.lower() in by_lower]
    lowered = {c.lower() for c in main.columns}
    removed = [c for c in main.columns if c.lower() not in by_lower]
    added = [c for c in current.columns if c.lower() not in lowered]
    totals = (_sketched_totals if approx else _two_ledgers)(main, current, common, [by_lower[c.lower()] for c in common])

    def picked(side: int, position: int, what: str) -> Column:
        return zero_if_null(F.max(F.when((F.col(SIDE) == side) & (F.col(V.COLUMN) == position), F.col(what))))

    cells = []
    for i, c in enumerate(common):
        for what, suffix in (("non_null", "non_null"), ("distinct", "distinct")):
            cells.append(picked(0, i, what).alias(f"main_{c}_{suffix}"))
            cells.append(picked(1, i, what).alias(f"current_{c}_{suffix}"))
    wide = totals.agg(picked(0, 0, "rows").alias("main_rows"), picked(1, 0, "rows").alias("current_rows"), *cells)
    return wide.select(
        "main_rows",
        "current_rows",
        (F.col("current_rows") - F.col("main_rows")).alias("row_difference"),
        F.lit(", ".join(removed)).alias("columns_removed"),
        F.lit(", ".join(added)).alias("columns_added"),
        *[col(c) for c in wide.columns if c not in ("main_rows", "current_rows")],
    )


def ab_row_count(a: DataFrame, b: DataFrame, labels: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Row counts of two variants with signed difference and percentage."""
    n_a, n_b = F.col(on_side(0)), F.col(on_side(1))
    return side_counts([a, b]).select(
        F.lit(labels[0]).alias("model_a"),
        F.lit(labels[1]).alias("model_b"),
        n_a.alias("model_a_rows"),
        n_b.alias("model_b_rows"),
        (n_b - n_a).alias("row_diff"),
        percent(n_b - n_a, n_a, 2).alias("pct_diff"),
    )


def ab_data_quality(a: DataFrame, b: DataFrame, approx: bool = False) -> DataFrame:
    """Null and distinct counts of both variants per common column of equal type."""
    columns = same_type_columns(b, a)
    totals = (_sketched_totals if approx else _two_ledgers)(a, b, columns, columns)

    def picked(side: int, value: Column) -> Column:
        return zero_if_null(F.max(F.when(F.col(SIDE) == side, value)))

    nulls, distinct = F.col("rows") - F.col("non_null"), F.col("distinct")
    per_column = totals.groupBy(V.COLUMN).agg(
        picked(0, nulls).alias("a_null_count"),
        picked(1, nulls).alias("b_null_count"),
        picked(0, distinct).alias("a_distinct_count"),
        picked(1, distinct).alias("b_distinct_count"),
    )
    return V.named(per_column, columns).select(
        "column_name",
        "a_null_count",
        "b_null_count",
        (F.col("b_null_count") - F.col("a_null_count")).alias("null_diff"),
        "a_distinct_count",
        "b_distinct_count",
        (F.col("b_distinct_count") - F.col("a_distinct_count")).alias("distinct_diff"),
    )


def row_count_gate(old: DataFrame, new: DataFrame, threshold: float = 0.1) -> DataFrame:
    """A row only where the relative change of the row count exceeds ``threshold``."""
    shown = f"{threshold * 100:g}"
    n_old, n_new = F.col(on_side(0)), F.col(on_side(1))
    return (
        side_counts([old, new])
        .select(
            F.lit(f"FAIL: Row count changed by more than {shown}%").alias("status"),
            n_old.alias("old_row_count"),
            n_new.alias("new_row_count"),
            F.abs(n_new - n_old).alias("row_count_diff"),
            ratio(F.abs(n_new - n_old), n_old).alias("row_count_pct_change"),
        )
        .filter(F.col("row_count_pct_change") > threshold)
    )
