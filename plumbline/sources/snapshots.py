"""Tables merged by key in place: partitioned, versioned, switched at once.

A table is a folder with ``data`` (Parquet, never changed once written) and ``versions`` (one small file each). A version names the
folders that make up every partition, oldest first, the high-water mark, and the last batch applied of each source. A
batch is written as one more folder of the partitions it touches, and the next version is then published by a rename
that fails if the version is there: readers and restarted writers see the old table or the new one. A partition that
has gathered ``fold`` folders is rewritten as one, so a batch costs what it holds and, now and then, the partitions it
touches; the rest of the table is neither read nor written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from plumbline.functions.columns import as_list, col
from plumbline.operators.leave import latest_rows

FOLD = 8  # folders a partition may have before it is rewritten
BUCKETS = 64  # partitions of a table whose partition is not given
PART, SEQUENCE = "_part", "_version"  # partition of a row, and the version that brought it
EMPTY = {"version": 0, "schema": None, "mark": None, "applied": {}, "parts": {}}


class Conflict(Exception):
    """Another writer has published the version that this one was about to publish."""


class _Folder:
    """Files of a table in whatever store Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        """Names below a folder, none if it does not exist."""
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a whole file under a name nobody has taken; raises :class:`Conflict` otherwise."""
        folder, last = name.rsplit("/", 1)
        self.fs.mkdirs(self._at(folder))
        draft = self._at(f"{folder}/.{last}-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.conf)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        plain = self.jvm.java.lang.reflect.Array.newInstance(getattr(rename, "NONE").getClass(), 1)
        plain[0] = getattr(rename, "NONE")
        try:
            files.rename(draft, self._at(name), plain)
        except Exception as error:
            self.fs.delete(draft, False)
            if self.fs.exists(self._at(name)):
                raise Conflict(f"{self.path}: {name} has been published by another writer") from error
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _file(version: int) -> str:
    return f"versions/{version:012d}.json"


def _numbers(folder: _Folder) -> list[int]:
    return [int(n[:-5]) for n in folder.names("versions") if n.endswith(".json") and not n.startswith(".")]


def _state(folder: _Folder, version: int | None = None) -> dict:
    numbers = _numbers(folder)
    if version is None:
        version = max(numbers, default=0)
    elif version not in numbers and version != 0:
        raise ValueError(f"{folder.path} has no version {version}")
    return json.loads(folder.read(_file(version))) if version else dict(EMPTY)


def _schema(state: dict) -> T.StructType | None:
    return None if state["schema"] is None else T.StructType.fromJson(state["schema"])


def _widened(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The old columns and behind them the new ones; a column may not change its type."""
    if old is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in new.fields])
    known = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if f.name in known and known[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {known[f.name].simpleString()} in the table, {f.dataType.simpleString()} in the batch")
    return T.StructType([*old.fields, *[T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]])


def _frame(spark: SparkSession, folder: _Folder, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of some folders with the version that brought them. Their files are listed by Spark, beyond a few in parallel."""
    stored = T.StructType([*schema.fields, T.StructField(SEQUENCE, T.LongType())])
    if not paths:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(*[f"{folder.path}/data/{p}" for p in paths])


def _reduced(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The latest row per key; at equal times, or without any, that of the later version."""
    rest = [c for c in rows.columns if c not in (order, SEQUENCE)]
    merged = rows.select(F.struct(col(order).alias("at"), col(SEQUENCE).alias("seq")).alias("__order"), *[col(c) for c in rest])
    best = latest_rows(merged, keys, "__order")
    back = {order: F.col("__order.at"), SEQUENCE: F.col("__order.seq")}
    return best.select(*[back.get(c, col(c)).alias(c) for c in rows.columns])


def current_version(spark: SparkSession, table: str) -> int:
    """The number of the published version, 0 for a table without any."""
    return max(_numbers(_Folder(spark, table)), default=0)


def high_water_mark(spark: SparkSession, table: str) -> str | None:
    """The highest ``order`` merged so far, as text; read from the version alone."""
    return _state(_Folder(spark, table))["mark"]


def snapshot(spark: SparkSession, table: str, version: int | None = None, only: str | None = None) -> DataFrame:
    """The rows of the published version, or of an earlier one that has not been expired.

    Partitions of one folder are read as they are; only those of several are reduced to the latest row per key. ``only``
    restricts the result to partitions whose value begins so; files of others are not read.
    """
    folder = _Folder(spark, table)
    state = _state(folder, version)
    schema = _schema(state)
    if schema is None:
        raise ValueError(f"{table} has no version yet")
    parts = [p for name, p in state["parts"].items() if name.startswith(f"{PART}={only or ''}")]
    single = _frame(spark, folder, [p[0] for p in parts if len(p) == 1], schema)
    several = _frame(spark, folder, [f for p in parts if len(p) > 1 for f in p], schema)
    return single.unionByName(_reduced(several, state["keys"], state["order"])).drop(SEQUENCE)


def merge_batch(
    updates: DataFrame,
    table: str,
    keys: str | Sequence[str],
    order: str,
    partition: Column | str | None = None,
    late: str = "drop",
    source: str = "batch",
    batch_id: int | None = None,
    fold: int = FOLD,
) -> int:
    """Merge rows into a table by key and publish the result; the number of the version that holds them.

    The row with the highest ``order`` per key wins; at equal times that of the later batch, inside a batch that of the
    greatest other columns. Rows with a NULL key all stay. Rows at or below the high-water mark of earlier
    batches, and those without a time once there is a mark, are dropped, or merged with ``late='upsert'``. ``partition`` must follow from the key (its date, say); without it, keys
    are dealt by hash into BUCKETS partitions. A batch of a ``source`` is applied once: a ``batch_id`` that is not above its last
    one changes nothing. Columns that the table lacks are added to it, those that the batch lacks are NULL.
    """
    if late not in ("drop", "upsert"):
        raise ValueError("late is 'drop' or 'upsert'")
    spark, keys = updates.sparkSession, as_list(keys)
    folder = _Folder(spark, table)
    state = _state(folder)
    if batch_id is not None and batch_id <= state["applied"].get(source, -1):
        return state["version"]
    if state["version"] and (state["keys"], state["order"]) != (keys, order):
        raise ValueError(f"{table} is merged by {state['keys']} and {state['order']}")
    if late == "drop" and state["mark"] is not None:
        updates = updates.filter(col(order) > F.lit(state["mark"]).cast(updates.schema[order].dataType))
    schema = _widened(_schema(state), updates.schema)
    version = state["version"] + 1
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in updates.columns]
    latest = latest_rows(updates, keys, order).select("*", *lacking).select(*[col(f.name) for f in schema.fields])
    seen = Observation()
    if partition is None:
        partition = F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(BUCKETS))
    part = (col(partition) if isinstance(partition, str) else partition).cast("string").alias(PART)
    rows = latest.observe(seen, F.max(col(order)).cast("string").alias("mark"), F.count(F.lit(1)).alias("n"))
    rows = rows.select("*", F.lit(version).cast("bigint").alias(SEQUENCE), part)
    touched = _written(folder, rows, version)
    parts = {name: list(paths) for name, paths in state["parts"].items()}
    for name, path in touched.items():
        parts.setdefault(name, []).append(path)
    full = {name: parts[name] for name in touched if len(parts[name]) >= max(fold, 2)}
    if full:
        parts |= _folded(spark, folder, full, schema, keys, order, part, version)
    found = seen.get if touched else {"mark": None}
    mark = _later(spark, state["mark"], found["mark"], schema[order].dataType)
    applied = state["applied"] if batch_id is None else {**state["applied"], source: batch_id}
    after = {"version": version, "schema": schema.jsonValue(), "mark": mark, "applied": applied, "parts": parts, "keys": keys, "order": order}
    folder.publish(_file(version), json.dumps(after))
    return version


def _written(folder: _Folder, rows: DataFrame, version: int) -> dict[str, str]:
    """Rows written by partition below one new folder: partition name to its path. Hot partitions are split by size."""
    name = f"{version:012d}-{uuid.uuid4().hex[:8]}"
    rows.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{folder.path}/data/{name}")
    return {p: f"{name}/{p}" for p in folder.names(f"data/{name}") if p.startswith(f"{PART}=")}


def _folded(
    spark: SparkSession, folder: _Folder, full: dict, schema: T.StructType, keys: list[str], order: str, part: Column, version: int
) -> dict[str, list[str]]:
    rows = _reduced(_frame(spark, folder, [p for paths in full.values() for p in paths], schema), keys, order)
    written = _written(folder, rows.select("*", part), version)
    if set(written) != set(full):
        raise ValueError(f"the partition does not follow from the key: {sorted(set(written) ^ set(full))[:3]}")
    return {name: [path] for name, path in written.items()}


def _later(spark: SparkSession, old: str | None, new: str | None, kind: T.DataType) -> str | None:
    if old is None or new is None:
        return new if old is None else old
    one = spark.range(1).select(F.greatest(F.lit(old).cast(kind), F.lit(new).cast(kind)).cast("string").alias("mark"))
    return one.first()["mark"]


def versions(spark: SparkSession, table: str) -> DataFrame:
    """version, mark, partitions, folders, widest (most folders of a partition) of every version not expired."""
    folder = _Folder(spark, table)
    rows = []
    for number in _numbers(folder):
        state = _state(folder, number)
        sizes = [len(p) for p in state["parts"].values()]
        rows.append((number, state["mark"], len(sizes), sum(sizes), max(sizes, default=0)))
    return spark.createDataFrame(rows, "version long, mark string, partitions long, folders long, widest long")


def expire_versions(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Remove all but the last versions and every folder that none of these names; how many folders went.

    Also removes what writers that failed have left. No other writer may be at work; readers of the kept versions go on.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    folder = _Folder(spark, table)
    numbers = _numbers(folder)
    used = {p for n in numbers[-keep:] for paths in _state(folder, n)["parts"].values() for p in paths}
    gone = 0
    for number in numbers[:-keep]:
        folder.delete(_file(number))
    for name in folder.names("data"):
        inside = [f"{name}/{p}" for p in folder.names(f"data/{name}")]
        if not used.intersection(inside):
            folder.delete(f"data/{name}")
            gone += 1
            continue
        for path in inside:
            if path.rsplit("/", 1)[1].startswith(f"{PART}=") and path not in used:
                folder.delete(f"data/{path}")
                gone += 1
    return gone


def stream_source(batch: DataFrame, fallback: str) -> str:
    """What tells a restarted stream from a new one: the id that its checkpoint holds."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or fallback

