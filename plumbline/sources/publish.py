"""Loads that are checked while they are written, and published only if they pass.

One job reads the load once: it splits rows that fail a check from the others, counts the failures of every check as observed metrics, and
writes both parts. Then the gate decides. A load that passes becomes the next version of the table in one step; a refused one leaves
the table as it was, with its report and its failing rows kept beside it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from plumbline.functions.columns import any_null, as_list, col
from plumbline.sources.snapshots import _file, _Folder, _numbers, _widened

OK, FAILED = "_ok", "_failed"
REPORT = "check_name string, column_name string, n_failing long, allowed long, passed boolean"


class Load(NamedTuple):
    accepted: bool
    version: int  # of the table after the load
    n_rows: int
    n_failing: int  # rows that fail a check of single rows
    report: DataFrame  # check_name, column_name, n_failing, allowed, passed
    rejected: DataFrame  # failing rows with the names of the checks they fail


class _Check(NamedTuple):
    name: str
    column: str
    fails: Column

    @property
    def label(self) -> str:
        return f"{self.name}({self.column})"


def _current(folder: _Folder) -> dict:
    numbers = _numbers(folder)
    return json.loads(folder.read(_file(max(numbers)))) if numbers else {"version": 0, "schema": None, "folders": []}


def _row_checks(
    df: DataFrame, not_null: Sequence[str], accepted: Mapping, relationships: Mapping, conditions: Mapping[str, Column]
) -> tuple[DataFrame, list[_Check]]:
    checks = [_Check("not_null", c, col(c).isNull()) for c in not_null]
    checks += [_Check("accepted_values", c, col(c).isNotNull() & ~col(c).isin(list(v))) for c, v in accepted.items()]
    # a condition that is NULL is not met, as in a filter
    checks += [_Check("condition", name, ~F.coalesce(met, F.lit(False))) for name, met in conditions.items()]
    for i, (c, (parent, field)) in enumerate(relationships.items()):
        known = parent.select(col(field).alias(f"__p{i}")).distinct().withColumn(f"__k{i}", F.lit(True))
        df = df.join(known, col(c) == F.col(f"__p{i}"), "left").drop(f"__p{i}")
        checks.append(_Check("relationship", c, col(c).isNotNull() & F.col(f"__k{i}").isNull()))
    return df, checks


def publish_checked(
    df: DataFrame,
    table: str,
    not_null: str | Sequence[str] = (),
    accepted: Mapping[str, Sequence[object]] | None = None,
    relationships: Mapping[str, tuple[DataFrame, str]] | None = None,
    conditions: Mapping[str, Column] | None = None,
    unique: Sequence[str | Sequence[str]] = (),
    allowed: Mapping[str, int] | None = None,
    replace: bool = False,
) -> Load:
    """Append a load to a table, or put it in its place, if its checks pass.

    A check fails if more rows (for ``unique``: more repeated values) than ``allowed`` for its label, ``not_null(o_custkey)`` say, fail it;
    0 without a mention. Rows that fail a check of single rows are never published; with an accepted load the others are. ``unique`` columns or lists of columns are
    counted over the written good rows, which reads their key columns only; with ``replace=False`` they are unique inside the load, not
    against the table. NULL passes all but ``not_null`` and conditions. An empty load passes.
    """
    spark, allowed, columns = df.sparkSession, dict(allowed or {}), df.columns
    folder = _Folder(spark, table)
    state = _current(folder)
    schema = _widened(None if replace or state["schema"] is None else T.StructType.fromJson(state["schema"]), df.schema)
    tested, checks = _row_checks(df, as_list(not_null), accepted or {}, relationships or {}, conditions or {})
    names = [F.when(c.fails, F.lit(c.label)) for c in checks]
    failed = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    seen = Observation()
    counted = [F.count(F.lit(1)).alias("n"), F.count_if(F.size(FAILED) > 0).alias("bad")]
    counted += [F.count_if(F.array_contains(FAILED, c.label)).alias(f"c{i}") for i, c in enumerate(checks)]
    marked = tested.select(*[col(c) for c in columns], failed.alias(FAILED)).observe(seen, *counted)
    name = uuid.uuid4().hex
    path = f"{folder.path}/data/{name}"
    marked.withColumn(OK, F.size(FAILED) == 0).write.partitionBy(OK).parquet(path)
    found = seen.get
    # folders by name: a part that has no rows has none
    parts = {p: f"{name}/{p}" for p in folder.names(f"data/{name}") if p.startswith(f"{OK}=")}
    good = [parts[f"{OK}=true"]] if f"{OK}=true" in parts else []
    rows = [(c.name, c.column, found[f"c{i}"], c.label) for i, c in enumerate(checks)]
    written = _read(spark, folder, good, schema)
    for keys in unique:
        keys = as_list(keys)
        groups = written.filter(~any_null(keys)).groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
        label = ", ".join(keys)
        rows.append(("unique", label, groups.filter("__n > 1").count(), f"unique({label})"))
    report = [(check, column, n, allowed.pop(label, 0)) for check, column, n, label in rows]
    if allowed:
        raise ValueError(f"no check is called {sorted(allowed)}")
    verdict = [(*r, r[2] <= r[3]) for r in report]
    passed = all(r[-1] for r in verdict)
    version = state["version"]
    if passed:
        version += 1
        after = {"version": version, "schema": schema.jsonValue(), "folders": [*([] if replace else state["folders"]), *good]}
        folder.publish(_file(version), json.dumps(after))
    bad = [parts[f"{OK}=false"]] if f"{OK}=false" in parts else []
    kept = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in df.schema.fields], T.StructField(FAILED, T.ArrayType(T.StringType()))])
    return Load(passed, version, found["n"], found["bad"], spark.createDataFrame(verdict, REPORT), _read(spark, folder, bad, kept))


def _read(spark: SparkSession, folder: _Folder, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder.path}/data/{p}" for p in paths])


def published_table(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The rows of the last accepted load's version, or of an earlier version."""
    folder = _Folder(spark, table)
    state = _current(folder) if version is None else json.loads(folder.read(_file(version)))
    if state["schema"] is None:
        raise ValueError(f"{table} has no version yet")
    return _read(spark, folder, state["folders"], T.StructType.fromJson(state["schema"]))
