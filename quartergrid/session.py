"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans are built from many small column calls; do not record each call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "quartergrid", master: str | None = None, **extra) -> SparkSession:
    """A session with the settings the operators rely on.

    ``extra`` names settings with double underscores for dots, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: all wall-clock arithmetic is done in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session that names none (tests, local runs) gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """One folder per process, removed when it ends."""
    held = tempfile.TemporaryDirectory(prefix="quartergrid-", ignore_cleanup_errors=True)
    atexit.register(held.cleanup)
    return held.name
