"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and turns a shuffled join into a
# broadcast one when the measured side is small; nothing here forces a join strategy.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# The fused loop of a damage run is one long method, and HotSpot leaves methods above
# 8000 bytes interpreted unless told otherwise. Set before the JVMs start.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"


def get_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    given = {key.replace("__", "."): value for key, value in conf.items()}
    for side in ("driver", "executor"):
        # added to the caller's options, not in their place
        name = f"spark.{side}.extraJavaOptions"
        given[name] = f"{given.get(name, '')} {JVM_OPTIONS}".strip()
    for key, value in given.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``.

    Where that setting is absent the session's warehouse serves, which executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}"
