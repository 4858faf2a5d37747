"""Spark sessions and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings every session gets; a caller's own value wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "4g",
}

MIB = 1024 * 1024


def sizes_for(input_bytes: int) -> dict[str, str]:
    """Settings for a job that reads about ``input_bytes``.

    Scans: 128 MiB a task, more from 25 TB on, which keeps a stage near 200,000 tasks; scans hold
    a batch at a time, whatever the size of a task. Shuffles: 256 MiB a partition at any size, so a
    task that sorts or aggregates needs about that much, three times as much uncompressed. AQE
    merges partitions that turn out small. The driver keeps one entry per scan task and partition:
    give it memory for that, 100 TB are 373,000 partitions.
    """
    scan = max(input_bytes // 200_000, 128 * MIB)
    partitions = max(-(-input_bytes // (256 * MIB)), 200)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def get_spark(
    app_name: str,
    *,
    local: bool | None = None,
    cores: str | int = "*",
    input_bytes: int | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Open (or return) the session for a job.

    ``local=None`` looks at the environment variable ``ENV``: ``local`` builds a standalone
    session, anything else uses the master the cluster supplies. ``input_bytes`` sizes scans and
    shuffles for jobs that know how much they read.
    """
    if local is None:
        local = os.environ.get("ENV") == "local"
    builder = SparkSession.builder.appName(app_name)
    settings = dict(DEFAULTS)
    if local:
        builder = builder.master(f"local[{cores}]")
        settings |= LOCAL_DEFAULTS
        n_cores = os.cpu_count() if cores == "*" else int(cores)
        settings["spark.sql.shuffle.partitions"] = str(n_cores)
    if input_bytes is not None:
        settings |= sizes_for(input_bytes)
    for key, value in (settings | dict(conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stratalake-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/stratalake/{label}-{uuid.uuid4().hex}"
