"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_dir: str | None = None


def build_session(app: str = "shoalgrid", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on (UTC, AQE, skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is used only in local mode, where driver and executors share the disk.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="shoalgrid-")
    return _local_dir


_jobs: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the job's folder, or the shared one; never reused, so no overwrite is needed."""
    return f"{_jobs[-1] if _jobs else shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Owner of all staged tables made inside the block: they lie in one folder, which goes when the block ends.

    Results that read staged tables must be written inside the block, to a place of their own.
    """
    path = f"{shared_dir(spark)}/job-{uuid.uuid4().hex}"
    _jobs.append(path)
    try:
        yield path
    finally:
        _jobs.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
