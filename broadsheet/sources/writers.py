"""Sinks. A failed write raises; nothing is reported as written that was not."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import scratch
from broadsheet.sources import snapshots


def append_bronze(articles: DataFrame, path: str) -> None:
    """Add articles as JSON lines, a file per partition, non-ASCII text unescaped."""
    articles.write.mode("append").json(path)


# A stream keeps its list of valid files in this folder beside them, or gives each cycle a folder.
STREAM_LOG, CYCLE_FOLDER = "_spark_metadata", "cycle="


def written_by(spark: SparkSession, path: str) -> str | None:
    """``stream`` or ``batch``, by what a folder holds; None for an empty or missing one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    streamed = any(name == STREAM_LOG or name.startswith(CYCLE_FOLDER) for name in names)
    return "stream" if streamed else "batch" if names else None


def refuse(spark: SparkSession, path: str, other: str) -> None:
    """Readers see only a stream's own files in a folder it writes: batch and stream must not share one."""
    if written_by(spark, path) == other:
        raise ValueError(f"{path} is written by a {other} job; give the other job a folder of its own")


def replace_silver(silver: DataFrame, path: str) -> None:
    """All of silver anew; readers see the old rows or the new ones, see :mod:`snapshots`."""
    refuse(silver.sparkSession, path, "stream")
    snapshots.replace(silver, path)


def replace_cycle(df: DataFrame, path: str, cycle: int, form: str = "parquet") -> None:
    """What one cycle of a stream adds, in a folder of its own: written again, it replaces itself.

    Readers of ``path`` see a further column ``cycle``.
    """
    df.write.mode("overwrite").format(form).save(f"{path.rstrip('/')}/{CYCLE_FOLDER}{cycle}")


def messages(articles: DataFrame) -> DataFrame:
    """Articles as JSON messages: one string column ``value``, no key."""
    return articles.select(F.to_json(F.struct(*articles.columns)).alias("value"))


def publish(articles: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send a batch of articles to a Kafka topic; needs Spark's Kafka connector."""
    writer = messages(articles).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).options(**options).save()


@dataclass(frozen=True)
class FileWarehouse:
    """Tables as Parquet folders below a root path, replaced as a whole, see :mod:`snapshots`."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def store(self, df: DataFrame, table: str) -> None:
        snapshots.replace(df, self.path(table))

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return snapshots.read(spark, self.path(table))


@dataclass(frozen=True)
class JdbcWarehouse:
    """Tables of a SQL database; credentials are part of the caller's ``properties``."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    connections: int = 8

    def store(self, df: DataFrame, table: str) -> None:
        # Truncating instead of dropping keeps the table's definition and grants.
        writer = df.write.option("truncate", "true").option("numPartitions", str(self.connections))
        writer.jdbc(self.url, table, mode="overwrite", properties=dict(self.properties))

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.jdbc(self.url, table, properties=dict(self.properties))


def store_counted(df: DataFrame, table: str, warehouse: FileWarehouse | JdbcWarehouse) -> int:
    """Replace one table and return its row count, taken while writing.

    A database is filled from a written copy: its sink reports no counts of its own, and a failure while the rows
    are computed then leaves the table as it was.
    """
    observation = Observation(table)
    counted = df.observe(observation, F.count("*").alias("rows"))
    if isinstance(warehouse, FileWarehouse):
        warehouse.store(counted, table)
    else:
        with scratch(df.sparkSession, "table") as copy:
            counted.write.parquet(copy)
            warehouse.store(df.sparkSession.read.parquet(copy), table)
    return observation.get["rows"]
