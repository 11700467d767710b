"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job of this library relies on. They can be set on a
# session that already exists, so a cluster's own session works as well.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings that only a new session can take.
START_SETTINGS = {
    # Skips recording a call site for every column expression built from Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tripkit", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, visible to every executor.

    Only a local-mode session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost together with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tripkit-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def saved(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a fixed state that outlives lost executors."""
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
