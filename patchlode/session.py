"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None, app: str = "patchlode", **conf: str
) -> SparkSession:
    """A session with adaptive execution, UTC time and, if given, a local master."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, or a fresh one if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = found.get() if found.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="patchlode-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back: the lineage ends at files that outlive executors."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
