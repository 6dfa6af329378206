"""Session construction, lineage cutting and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the operators are tested under."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master without that setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use.rstrip("/")
    if _is_local(spark):
        created = tempfile.mkdtemp(prefix="plumbline-")
        spark.sparkContext.setCheckpointDir(created)
        return created
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing folder below the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that losing an executor costs no recomputation."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, computed once."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
