"""Streaming forms of extraction, cleaning and the daily count.

Extraction and cleaning are stateless row transformations: the batch functions applied to a streaming DataFrame.
The checkpoint makes a restart go on where the last cycle ended. A flow with several outputs gives each cycle a
folder of its own in each of them, so a cycle that is run again replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from broadsheet.functions.language import Model
from broadsheet.functions.text import publish_day
from broadsheet.operators.extract import (
    STREAM_RULES,
    SiteRule,
    failed_pages,
    has_title,
    is_unmatched,
    read_items,
    to_articles,
    unmatched_hosts,
)
from broadsheet.operators.silver import to_silver
from broadsheet.sources import snapshots
from broadsheet.sources.writers import messages, refuse, replace_cycle

CYCLE = "60 seconds"

# How long after the newest day an article still counts for its own.
LATE = "2 days"


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, mode: str = "append") -> StreamingQuery:
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=CYCLE)
    return writer.start()


def _observed(items: DataFrame) -> DataFrame:
    return items.observe(
        "ingest",
        F.count_if(has_title()).alias("sent"),
        F.count_if(F.col("error").isNotNull()).alias("failed_pages"),
        F.count_if(is_unmatched()).alias("unmatched_pages"),
    )


def ingest(pages: DataFrame, rules: SiteRule | Sequence[SiteRule] = STREAM_RULES) -> DataFrame:
    """Arriving pages to articles; each cycle reports ``sent``, ``failed_pages`` and ``unmatched_pages``."""
    return to_articles(_observed(read_items(pages, rules, unread=True)))


def start_publishing(
    articles: DataFrame,
    checkpoint: str,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Send articles as JSON messages to a topic (``kafka`` options), or to text files in ``path``.

    ``once`` works off what has arrived and ends; otherwise a cycle runs every minute.
    """
    writer = messages(articles).writeStream
    if kafka is not None:
        writer = writer.format("kafka").options(**kafka)
    else:
        writer = writer.format("text").option("path", path)
    return _start(writer, checkpoint, once)


def start_ingest(
    pages: DataFrame,
    checkpoint: str,
    letters: str,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    rules: SiteRule | Sequence[SiteRule] = STREAM_RULES,
    once: bool = False,
) -> StreamingQuery:
    """Arriving pages to messages, and what is no message to the folder ``letters``.

    ``letters/failed`` gets the pages that could not be read, whole and with the error, and ``letters/unmatched`` the
    number of pages per host without a rule. In folders a cycle that is run again, as after a stop between two
    writes, replaces itself; a topic may then get its messages twice.
    """

    def cycle(items: DataFrame, number: int) -> None:
        # Read once for the three outputs; the parsed items are far smaller than the pages.
        items = items.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sent = messages(to_articles(items))
            if kafka is not None:
                sent.write.format("kafka").options(**kafka).save()
            else:
                replace_cycle(sent, path, number, "text")
            replace_cycle(failed_pages(items), f"{letters}/failed", number)
            replace_cycle(unmatched_hosts(items), f"{letters}/unmatched", number)
        finally:
            items.unpersist()

    return _start(_observed(read_items(pages, rules, unread=True)).writeStream.foreachBatch(cycle), checkpoint, once)


def start_cleaning(
    articles: DataFrame, model: Model, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Arriving articles to the silver folder.

    A model too large for one broadcast scores by joins, which a row-wise stream has not: each cycle then is
    cleaned as a batch into a folder of its own.
    """
    refuse(articles.sparkSession, path, "batch")
    if model.tail is None:
        return _start(to_silver(articles, model).writeStream.format("parquet").option("path", path), checkpoint, once)

    def cycle(batch: DataFrame, number: int) -> None:
        replace_cycle(to_silver(batch, model), path, number)

    return _start(articles.writeStream.foreachBatch(cycle), checkpoint, once)


def daily_counts(articles: DataFrame, late: str = LATE) -> DataFrame:
    """``(publish_day, article_count)`` of a stream, in update mode: each cycle gives the days that it changed.

    A day is kept as state until it lies ``late`` behind the newest day of an earlier cycle; articles of days before
    that are dropped, and Spark counts them. Articles without a date are a group of their own, as in the batch.
    """
    days = articles.select(publish_day(F.col("published_date")).cast("timestamp").alias("day"))
    counts = days.withWatermark("day", late).groupBy("day").agg(F.count("*").alias("article_count"))
    return counts.select(F.col("day").cast("date").alias("publish_day"), "article_count")


def start_daily_counts(
    articles: DataFrame, table: str, checkpoint: str, late: str = LATE, once: bool = False
) -> StreamingQuery:
    """Keep a table of articles per day up to date; its readers see the days of one cycle or of the next.

    Counts of a changed day replace those stored before, so a cycle that is run again changes nothing.
    """

    def cycle(changed: DataFrame, number: int) -> None:
        spark = changed.sparkSession
        changed = changed.persist()
        try:
            if snapshots.present(spark, table):
                new = changed.select(F.col("publish_day").alias("_day"))
                stored = snapshots.read(spark, table)
                kept = stored.join(new, F.col("publish_day").eqNullSafe(F.col("_day")), "left_anti")
                snapshots.replace(kept.unionByName(changed), table)
            else:
                snapshots.replace(changed, table)
        finally:
            changed.unpersist()

    return _start(daily_counts(articles, late).writeStream.foreachBatch(cycle), checkpoint, once, "update")
