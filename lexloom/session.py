"""Session settings the library is written for."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(master: str = "local[*]", app: str = "lexloom", **settings: str) -> SparkSession:
    """A session with the defaults; further settings as keyword arguments with _ for the dots."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in (DEFAULTS | {k.replace("_", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), _ROOT]))


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share; a local one only where none is named."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lexloom-shared-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: this cuts the lineage."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
