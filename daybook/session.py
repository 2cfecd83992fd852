"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings for the mart jobs: whole days must not depend on a local zone,
    malformed text must raise, and skewed shuffles must be split at run time."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="daybook-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for data written between two steps of a job.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Only a local session without that setting falls back to a local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
