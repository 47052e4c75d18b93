"""Batch and streaming sources. Paths, topics and options come from the caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.schema import ARTICLE, ARTICLE_FIELDS, BROKEN, PAGE
from broadsheet.sources import snapshots


def read_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """All JSON records of a folder; absent fields are null, broken lines all-null rows.

    The declared schema saves the pass that inference would make over all of bronze.
    """
    reader = spark.read.schema(ARTICLE).option("mode", "PERMISSIVE")
    return reader.option("pathGlobFilter", "*.json").json(folder)


def read_marked_bronze(spark: SparkSession, folder: str, names: str = "*.json") -> DataFrame:
    """Like :func:`read_bronze`, with the text of a line that is no record in ``broken_line`` and its ``file``."""
    reader = spark.read.schema(BROKEN).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken_line")
    lines = reader.option("pathGlobFilter", names).json(folder)
    # The reader gives the text of a line only to a query that asks for a field, too.
    asked = F.coalesce(F.length("id"), F.lit(0)) >= 0
    return lines.select(*ARTICLE_FIELDS, F.when(asked, F.col("broken_line")).alias("broken_line"), F.col("_metadata.file_path").alias("file"))


def broken_lines(marked: DataFrame) -> DataFrame:
    """``(file, line)`` of the lines of :func:`read_marked_bronze` that are no records."""
    return marked.where(F.col("broken_line").isNotNull()).select("file", F.col("broken_line").alias("line"))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver as it is now; a rewrite does not change what has been opened."""
    return snapshots.read(spark, path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: ``page_id, url, html``."""
    return spark.read.parquet(path).select(*PAGE.fieldNames())


def present(open_source: Callable[[], DataFrame]) -> DataFrame | None:
    """The source, or None when its path does not exist or holds no data file yet.

    Any other failure is raised.
    """
    try:
        source = open_source()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return source if source.rdd.getNumPartitions() else None


def decode_messages(messages: DataFrame) -> DataFrame:
    """Articles out of the ``value`` column (string or binary JSON) of a message table or stream."""
    article = F.from_json(F.col("value").cast("string"), ARTICLE)
    return messages.select(article.alias("article")).select("article.*")


def stream_topic(
    spark: SparkSession, servers: str, topic: str, offsets_per_cycle: int | None = None, **options: str
) -> DataFrame:
    """Articles of a Kafka topic; needs Spark's Kafka connector on the class path.

    A backlog is worked off by so many messages a cycle.
    """
    if offsets_per_cycle is not None:
        options["maxOffsetsPerTrigger"] = str(offsets_per_cycle)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    return decode_messages(reader.options(**options).load())


def _bounded(files_per_cycle: int | None) -> dict[str, str]:
    return {} if files_per_cycle is None else {"maxFilesPerTrigger": str(files_per_cycle)}


def stream_bronze(spark: SparkSession, path: str, files_per_cycle: int | None = None, **options: str) -> DataFrame:
    """Articles of the JSON files arriving in a folder; a backlog is worked off by so many files a cycle."""
    return spark.readStream.schema(ARTICLE).options(**_bounded(files_per_cycle), **options).json(path)


def stream_pages(spark: SparkSession, path: str, files_per_cycle: int | None = None, **options: str) -> DataFrame:
    """Pages of the Parquet files arriving in a folder; a backlog is worked off by so many files a cycle.

    Few files have few splits, whatever their size: the pages of such a cycle are dealt to all cores to be read.
    """
    pages = spark.readStream.schema(PAGE).options(**_bounded(files_per_cycle), **options).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return pages if files_per_cycle is None or files_per_cycle >= cores else pages.repartition(cores)
