"""File drops: classification, dates, normalisation, aligned append, manifest and summary."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions.columns import col, zero_if_null
from plumbline.session import cut_lineage

# File types with their name patterns, suffixes, date pattern, required and default columns.
LEAVE, TIME_OFF = "loa", "to"
NAME_PATTERNS = {LEAVE: r"leave\s+of\s+absence", TIME_OFF: r"time\s+off"}
SHEET_SUFFIXES = [".xlsx", ".xls"]
DATE_PATTERN = r"(\d{8})"
REQUIRED = {
    LEAVE: ["Employee ID", "Effective Date", "First Day of Leave"],
    TIME_OFF: ["Employee ID", "Time Off Date", "Duration"],
}
TIME_OFF_DEFAULTS = {"Status": "Approved", "Unit of Time": "Hours"}
BLANKED_PARTS = ["Date", "Day"]
TIMESTAMP = "timestamp_unix"

NUMBER_DIGITS = 16  # hexadecimal digits of the number in front of an archive name
NUMBERED_NAME = rf"^\d{{8}}_\d{{6}}_([0-9a-f]{{{NUMBER_DIGITS}}})[._]"


def file_type(name: Column) -> Column:
    """``loa``, ``to`` or NULL by the lower-cased file name; the first pattern wins."""
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(NAME_PATTERNS.items()):
        found = F.when(F.lower(name).rlike(pattern), kind).otherwise(found)
    return found


def classify_files(files: DataFrame, name: str = "file_name", suffixes: Sequence[str] = SHEET_SUFFIXES) -> DataFrame:
    """Files of a known type and suffix, with ``file_type``; others are skipped."""
    known_suffix = F.lit(False)
    for suffix in suffixes:
        known_suffix = known_suffix | F.endswith(col(name), F.lit(suffix))
    return files.filter(known_suffix).withColumn("file_type", file_type(col(name))).filter(F.col("file_type").isNotNull())


def name_date(name: Column) -> Column:
    """The first eight digits of a name as a date, NULL where they are none."""
    return F.try_to_date(F.regexp_extract(name, DATE_PATTERN, 1), "yyyyMMdd")


def file_date(files: DataFrame, name: str = "file_name") -> DataFrame:
    return files.withColumn("file_date", name_date(col(name)))


def _checked(df: DataFrame, kind: str, mapping: Mapping[str, str] | None, now: object) -> DataFrame:
    df = df.withColumnsRenamed(dict(mapping or {}))
    missing = [c for c in REQUIRED[kind] if c not in df.columns]
    if missing:
        raise ValueError(f"a drop of type {kind!r} lacks {missing}; its columns are {df.columns}")
    ingested = F.unix_timestamp() if now is None else F.lit(now)
    return df if TIMESTAMP in df.columns else df.withColumn(TIMESTAMP, ingested.cast("bigint"))


def normalize_loa(df: DataFrame, mapping: Mapping[str, str] | None = None, now: object = None) -> DataFrame:
    """A leave drop with renamed columns, an ingest time, and blanks for missing dates."""
    df = _checked(df, LEAVE, mapping, now)
    blanked = {
        c: F.coalesce(col(c).cast("string"), F.lit("")) for c in df.columns if any(p in c for p in BLANKED_PARTS)
    }
    return df.withColumns(blanked)


def normalize_time_off(df: DataFrame, mapping: Mapping[str, str] | None = None, now: object = None) -> DataFrame:
    """A time-off drop with renamed columns, an ingest time, and default columns where absent."""
    df = _checked(df, TIME_OFF, mapping, now)
    return df.withColumns({c: F.lit(v) for c, v in TIME_OFF_DEFAULTS.items() if c not in df.columns})


def append_aligned(target: DataFrame | None, new: DataFrame) -> DataFrame:
    """Target plus new rows: columns in the target's order, new ones at the end, absent ones NULL."""
    return new if target is None else target.unionByName(new, allowMissingColumns=True)


def append_to(new: DataFrame, path: str) -> None:
    """Append to a Parquet table whose readers merge schemas, so new columns widen it."""
    new.write.mode("append").parquet(path)


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def _csv_files(paths: str | Sequence[str]) -> list[str]:
    """Paths for a reader; those of a list are file names, in which pattern characters mean themselves."""
    return [paths] if isinstance(paths, str) else [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def headings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The column names of every CSV file: ``file_path, headings``, as long as the widest, filled with ''.

    Files without any line are left out.

    The heading is the first line of the first block of its file. Rows of one block stay in order
    within their task, so the least running number finds it without a sort.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(_csv_files(paths))
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("number"),
            "value",
        )
        .filter(F.col("start") == 0)
    )
    first = lines.groupBy("file_path").agg(F.min_by("value", "number").alias("line"))
    first = cut_lineage(first.withColumn("line", F.regexp_replace("line", "^\ufeff|\\r$", "")))
    widest = first.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1
    cells = F.from_csv("line", F.lit(_positions(widest)))
    return first.select("file_path", F.array(*[F.coalesce(cells[f"c{i}"], F.lit("")) for i in range(widest)]).alias("headings"))


def _positions(width: int) -> str:
    return ", ".join(f"c{i} string" for i in range(width))


def lacking(found: DataFrame, kind: str, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Files of :func:`headings` without all columns that their type requires, with ``lacking``."""
    called = {want: [want, *[raw for raw, to in (mapping or {}).items() if to == want]] for want in REQUIRED[kind]}
    absent = F.array_compact(
        F.array(
            *[
                F.when(~F.arrays_overlap(F.col("headings"), F.array(*[F.lit(r) for r in raws])), F.lit(want))
                for want, raws in called.items()
            ]
        )
    )
    return found.withColumn("lacking", absent).filter(F.size("lacking") > 0)


def read_drops(spark: SparkSession, paths: str | Sequence[str], found: DataFrame | None = None) -> DataFrame:
    """CSV drops below a folder, or given files, by heading: texts, with the name of the drop in ``file_name``.

    Every file is read under its own heading, in whatever order its columns stand; a column that
    only some files have is NULL in the others. Rows are read once, by position; the names of
    their file say which cell is which, and the first of two equal names counts. ``found``
    restricts the result to files of :func:`headings`. Without any heading there are no columns but ``file_name``.
    """
    found = headings(spark, paths) if found is None else found
    first_seen = found.select("file_path", F.posexplode("headings").alias("place", "name"))
    ordered = first_seen.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name")
    names = [r["name"] for r in ordered.collect() if r["name"]]
    width = found.agg(F.max(F.size("headings"))).first()[0] or 1
    reader = spark.read.option("header", "true").option("enforceSchema", "true").option("recursiveFileLookup", "true")
    rows = reader.schema(_positions(width)).csv(_csv_files(paths)).select(
        F.col("_metadata.file_path").alias("file_path"),
        drop_name().alias("file_name"),
        F.array(*[F.col(f"c{i}") for i in range(width)]).alias("cells"),
    )
    # array_position is 0 for an absent name, and get gives NULL at -1
    cells = [F.get("cells", (F.array_position("headings", F.lit(n)) - 1).cast("int")).alias(n) for n in names]
    return rows.join(found.select("file_path", "headings"), "file_path").select(*cells, "file_name")


def drop_name() -> Column:
    """The drop's own name, decoded: of its file, or of the folder that holds it as part files.

    Folders further up do not take part in its classification.
    """
    path = F.split(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "/")
    own = F.element_at(path, -1)
    return F.when(own.rlike(r"^part-\d+"), F.element_at(path, -2)).otherwise(own)


def ingest_manifest(
    files: DataFrame,
    existing: DataFrame | None,
    archived_at: object = None,
    archived_by: str = "ingest",
    name: str = "file_name",
    order: str = "file_path",
) -> DataFrame:
    """Archive records of classified files; a name already taken gets a timestamp and a number in front.

    A name is taken by an existing record of the same type or by an earlier file (by ``order``,
    which tells the files of a batch apart) of this batch. The number is the beginning of the
    SHA-256 of type and ``order``, so no task has to count the files of one name; a file archived before
    under that number also carries how often. Archive names are distinct per type.
    """
    stamp = F.current_timestamp() if archived_at is None else F.lit(archived_at).cast("timestamp_ntz")
    named = files.select(F.col("file_type"), col(name).alias("original_filename"), col(order).alias("__order"))
    number = F.substring(F.sha2(F.concat_ws("|", "file_type", F.col("__order").cast("string")), 256), 1, NUMBER_DIGITS)
    named = named.withColumn("__number", number)
    holder = named.groupBy("file_type", "original_filename").agg(F.min("__order").alias("__first"))
    before = F.lit(0)
    if existing is None:
        holder = holder.withColumn("__taken", F.lit(False))
    else:
        taken = existing.select("file_type", F.col("archived_filename").alias("original_filename")).distinct()
        holder = holder.join(taken.withColumn("__held", F.lit(True)), ["file_type", "original_filename"], "left")
        holder = holder.withColumn("__taken", F.col("__held").isNotNull())
        numbered = existing.select("file_type", F.regexp_extract("archived_filename", NUMBERED_NAME, 1).alias("__number"))
        numbered = numbered.filter("__number <> ''").groupBy("file_type", "__number").agg(F.count(F.lit(1)).alias("__before"))
        named = named.join(numbered, ["file_type", "__number"], "left")
        before = zero_if_null(F.col("__before"))
    clash = F.col("__taken") | (F.col("__order") != F.col("__first"))
    again = F.when(before > 0, F.concat(F.lit("."), before.cast("string"))).otherwise(F.lit(""))
    prefix = [F.date_format(stamp, "yyyyMMdd_HHmmss"), F.lit("_"), F.col("__number"), again, F.lit("_")]
    prefixed = F.concat(*prefix, F.col("original_filename"))
    return named.join(holder, ["file_type", "original_filename"], "inner").select(
        "original_filename",
        F.when(clash, prefixed).otherwise(F.col("original_filename")).alias("archived_filename"),
        "file_type",
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss").alias("archived_timestamp"),
        F.lit(archived_by).alias("archived_by"),
    )


def ingest_summary(files: DataFrame, records: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Per classified file: date, type, records, success, archived and error.

    ``files`` has ``file_name, file_type`` and optionally ``error``; ``records`` has one row
    per ingested record with its ``file_name``.
    """
    error = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    listed = files.select("file_name", "file_type", error.alias("error")).distinct()
    counted = records.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    result = listed.join(counted, "file_name", "left")
    if manifest is None:
        result = result.withColumn("__kept", F.lit(None).cast("boolean"))
    else:
        kept = manifest.select(F.col("original_filename").alias("file_name")).distinct()
        result = result.join(kept.withColumn("__kept", F.lit(True)), "file_name", "left")
    shown_date = F.coalesce(F.date_format(name_date(F.col("file_name")), "yyyy-MM-dd"), F.lit("unknown date"))
    success = F.col("n").isNotNull() & F.col("error").isNull()
    return result.select(
        F.col("file_name").alias("file"),
        shown_date.alias("date"),
        F.col("file_type").alias("type"),
        F.when(success, zero_if_null(F.col("n"))).otherwise(F.lit(0).cast("bigint")).alias("records"),
        success.alias("success"),
        (success & F.col("__kept").isNotNull()).alias("archived"),
        "error",
    )

