"""Session settings the operators are tuned for, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Beyond this many rows a sorted page is taken from a distributed sort
    # rather than from one in-memory heap.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    # Keep the last of repeated JSON keys, as JSON readers commonly do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Building a plan takes thousands of column calls; do not trace each to its line.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "foliant", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session with ``SETTINGS``; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    A machine-local folder is only ever chosen for a local master without the
    setting: on a cluster other executors could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="foliant-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/foliant/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a costly upstream (page parsing) feeds two branches. Unlike a
    cache or a local checkpoint the files survive the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
