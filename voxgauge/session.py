"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings the library's plans lean on; size-dependent ones stay with the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "voxgauge", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: list[str] = []  # of this process, where a local session names no folder; gone at its end


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder, ``spark.checkpoint.dir``.

    Where it is unset a cluster raises; a local session, whose one process sees the same disk, gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="voxgauge-"))
            atexit.register(shutil.rmtree, _local_root[0], ignore_errors=True)
        root = _local_root[0]
    return f"{root.rstrip('/')}/voxgauge/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """The rows written once in the shared folder and read back, for a result that several steps use."""
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
