"""Sharding by fixed virtual slots: keys hash to slots for good, and only the map from slots to shards changes.

A map is a small versioned table (version, virtual_slot, shard) of a row per slot, kept as Parquet by version. Growing by a shard, or
evening out bytes, makes a new version in which few slots have moved. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SLOTS = 16_384
ROW_BYTES = 16  # of a record beside its text


def slot_of(key: Column, instead: Column, slots: int = SLOTS) -> Column:
    """The slot of a key for good; rows without a key are spread by ``instead``."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.concat(F.lit("\x00"), instead.cast("string")))), F.lit(slots)).cast("int")


def _map(spark: SparkSession, shard_of: list[int], version: int) -> DataFrame:
    return spark.createDataFrame([(version, slot, shard) for slot, shard in enumerate(shard_of)], "version int, virtual_slot int, shard int")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt to the shards in turn; decided by the two numbers alone."""
    return _map(spark, [slot % shards for slot in range(slots)], 1)


def store_map(slot_map: DataFrame, folder: str) -> DataFrame:
    """Write a map beside the earlier versions in ``folder`` and give it back as it was stored; a version that is there is refused."""
    version = slot_map.first()["version"]
    slot_map.select("virtual_slot", "shard").coalesce(1).write.mode("error").parquet(f"{folder}/version={version}")
    return stored_map(slot_map.sparkSession, folder, version)


def stored_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The stored map of a version, the latest if none is given; ValueError if it is not there."""
    maps = spark.read.schema("virtual_slot int, shard int, version int").parquet(folder)
    latest = maps.where(F.lit(True) if version is None else F.col("version") == version).agg(F.max("version")).first()[0]
    if latest is None:
        raise ValueError(f"no slot map {version or ''} in {folder}")
    return maps.where(F.col("version") == latest).select("version", "virtual_slot", "shard")


def _shards(slot_map: DataFrame) -> tuple[int, list[int]]:
    rows = slot_map.orderBy("virtual_slot").collect()  # a row per slot
    return rows[0]["version"], [r["shard"] for r in rows]


def grown_map(slot_map: DataFrame) -> DataFrame:
    """The next version, with one shard more: it takes an equal share of slots, evenly from all others.

    Decided by the map alone, so that the same key has the same new shard whatever else is stored.
    """
    version, shard_of = _shards(slot_map)
    new = max(shard_of) + 1
    share, per_shard = len(shard_of) // (new + 1), {}
    for slot, shard in enumerate(shard_of):
        per_shard.setdefault(shard, []).append(slot)
    for _ in range(share):
        donor = max(per_shard, key=lambda s: (len(per_shard[s]), -s))
        shard_of[per_shard[donor].pop()] = new
    return _map(slot_map.sparkSession, shard_of, version + 1)


def rebalanced_map(slot_map: DataFrame, loads: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """The next version, evened out by the bytes of each slot (virtual_slot, bytes).

    Moves a slot from the fullest shard to the emptiest while that narrows the gap by more than
    ``tolerance`` of a mean shard. Slots missing from ``loads`` are empty; the version rises even if nothing moves.
    """
    version, shard_of = _shards(slot_map)
    size = {r["virtual_slot"]: int(r["bytes"] or 0) for r in loads.select("virtual_slot", "bytes").collect()}  # a row per slot
    total = {s: 0 for s in shard_of}
    for slot, shard in enumerate(shard_of):
        total[shard] += size.get(slot, 0)
    mean = sum(total.values()) / len(total)
    while True:
        full, empty = max(total, key=total.get), min(total, key=total.get)
        gap = total[full] - total[empty]
        fitting = [s for s, shard in enumerate(shard_of) if shard == full and 0 < size.get(s, 0) < gap]
        if gap <= tolerance * mean or not fitting:
            return _map(slot_map.sparkSession, shard_of, version + 1)
        slot = min(fitting, key=lambda s: abs(size[s] - gap / 2))
        shard_of[slot] = empty
        total[full] -= size[slot]
        total[empty] += size[slot]


def slot_loads(records: DataFrame) -> DataFrame:
    """(virtual_slot, rows, bytes) of records with ``virtual_slot`` and ``size``; one row per slot at most."""
    return records.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def sharded(docs: DataFrame, slot_map: DataFrame, grown: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, virtual_slot, shard, slot, grown_shard) of every row.

    ``size`` is the UTF-8 length of the text (null: none) plus ROW_BYTES. ``slot`` counts the rows of a shard from 0 without
    gaps, by virtual slot, id, size and checksum. Rows without id are spread by their text; equal rows are counted before the
    shuffle and take consecutive places; an id has one shard, however often it occurs. ``grown_shard`` follows the
    map ``grown`` (null without one). Other columns are not read.
    """
    value = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        (F.octet_length(value) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(value).alias("crc"),
    )
    rows = rows.withColumn("virtual_slot", slot_of(F.col("id"), F.col("crc")))
    alike = rows.groupBy("virtual_slot", "id", "size", "crc").agg(F.count("*").alias("copies"))
    inner = Window.partitionBy("virtual_slot").orderBy("id", "size", "crc").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("inner", F.coalesce(F.sum("copies").over(inner), F.lit(0)))

    loads = slot_map.select("virtual_slot", "shard").join(slot_loads(rows).select("virtual_slot", "rows", "bytes"), "virtual_slot", "left")
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)  # slots, not rows
    loads = loads.withColumn("base", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    if grown is not None:
        loads = loads.join(F.broadcast(grown.select("virtual_slot", F.col("shard").alias("grown_shard"))), "virtual_slot")
    else:
        loads = loads.withColumn("grown_shard", F.lit(None).cast("int"))
    placed = alike.join(F.broadcast(loads.select("virtual_slot", "shard", "grown_shard", "base", F.col("bytes").alias("slot_bytes"))), "virtual_slot")
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    return placed.select("*", copy).select(
        F.col("id").alias(doc_id),
        "size",
        F.col("crc").alias("text_crc32"),
        "virtual_slot",
        "slot_bytes",
        "shard",
        (F.col("base") + F.col("inner") + F.col("copy")).alias("slot"),
        "grown_shard",
    )
