"""Tables that are replaced as a whole, with readers looking on.

A table is a folder with one folder per version and a small file, the pointer, that lists the versions in use, the
current one first. A new version is written completely before a rename puts the new pointer in the place of the old
one, so a reader sees all rows of one version; an aborted run changes nothing that readers see. The version before
the current one is kept for readers that opened it; older ones are removed. Names begin with an underscore, which
keeps a plain read of the folder from taking several versions for one table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from broadsheet.session import remove

POINTER = "_current"
VERSION = "_v-"

# Versions a pointer lists, and the age from which a version no pointer lists counts as left by an aborted run.
KEPT = 2
ABANDONED_HOURS = 24


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(part.rstrip("/") for part in parts))


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the versions in use, the current one first; none where there is no pointer."""
    pointer = _path(spark, root, POINTER)
    files = _files(spark, pointer)
    if not files.exists(pointer):
        return []
    stream = files.open(pointer)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read(spark: SparkSession, root: str) -> DataFrame:
    """The current version, or a plain Parquet folder as it is. What is opened stays that version."""
    listed = versions(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/{listed[0]}" if listed else root)


def replace(df: DataFrame, root: str) -> None:
    """Make the rows of ``df``, which may be read from the table itself, its next version."""
    spark = df.sparkSession
    name = f"{VERSION}{uuid.uuid4().hex}"
    try:
        df.write.parquet(f"{root.rstrip('/')}/{name}")
        listed = versions(spark, root)
        _publish(spark, root, [name, *listed][:KEPT])
    except BaseException:
        remove(spark, f"{root.rstrip('/')}/{name}")
        raise
    for old in listed[KEPT - 1 :]:
        remove(spark, f"{root.rstrip('/')}/{old}")
    if listed:
        _sweep(spark, root)


def _publish(spark: SparkSession, root: str, names: list[str]) -> None:
    """Put a pointer in place by a rename that replaces."""
    jvm = spark._jvm
    written, pointer = _path(spark, root, f"{POINTER}-{uuid.uuid4().hex}"), _path(spark, root, POINTER)
    stream = _files(spark, written).create(written, True)
    try:
        jvm.org.apache.commons.io.IOUtils.write(json.dumps(names), stream, "UTF-8")
    finally:
        stream.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(option, 1)
    overwrite[0] = option.OVERWRITE
    conf = spark._jsc.hadoopConfiguration()
    qualified = [_files(spark, path).makeQualified(path) for path in (written, pointer)]
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified[0].toUri(), conf).rename(*qualified, overwrite)


def _sweep(spark: SparkSession, root: str) -> None:
    """Remove what lies beside the versions in use: those of aborted runs, and files from before there were any."""
    folder = _path(spark, root)
    files, listed = _files(spark, folder), versions(spark, root)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        hidden = name.startswith(("_", "."))
        abandoned = name.startswith((VERSION, f"{POINTER}-")) and name not in listed
        if not hidden or abandoned and now - status.getModificationTime() > ABANDONED_HOURS * 3_600_000:
            files.delete(status.getPath(), True)


def present(spark: SparkSession, root: str) -> bool:
    """Whether there is a version, or a plain table, to read."""
    try:
        read(spark, root)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
