"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on; all of them can be set on a live session.
RUNTIME_SETTINGS = {
    # Dates are derived from timestamps in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing, measured broadcasts, skew splits.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot customer must be split even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Writers ask for a rebalance; AQE splits a day that is too big for one file.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stored tables and steps are smaller by a quarter or more than with snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    # Operators write every step to the shared folder; what its job has shuffled is of no use once it is written.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    They stay set: results are lazy and run under them. The time zone is among them.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "ringledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    """One folder per process, deleted when it ends."""
    folder = tempfile.mkdtemp(prefix="ringledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    A cluster names its shared folder in ``spark.checkpoint.dir``; what is written
    there is its owner's to delete, as results are read from it lazily. Only a
    plain local session may go without: there one process is the whole cluster.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_scratch()
    return f"{shared.rstrip('/')}/ringledger-{label}-{uuid.uuid4().hex[:12]}"
