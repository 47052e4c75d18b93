"""Session helpers: defaults, scratch space, and task spreading for small inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages and articles are wide rows: bound an Arrow batch by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "broadsheet", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local temporary folder stands in only for a local master, where every task runs on
    this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="broadsheet-")
    return f"{base.rstrip('/')}/broadsheet-{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds; nothing happens where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder name like :func:`scratch_path` whose folder is removed at the end."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy work one task per core when the scan yields fewer splits than cores.

    A large input has more splits than the cluster has cores, so nothing is moved there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
