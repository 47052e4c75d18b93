"""The batch chain: pages to bronze, bronze to silver, silver to gold.

Each stage reads what the stage before it stored. Silver and gold are rebuilt in full on every run; who reads them
meanwhile sees the old rows until the new ones are complete.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.language import Model, load_model
from broadsheet.operators import gold
from broadsheet.operators.extract import (
    BATCH_RULES,
    SiteRule,
    gathered,
    is_unmatched,
    matched_pages,
    read_items,
    to_articles,
)
from broadsheet.operators.quality import accepted_and_observed
from broadsheet.operators.silver import enrich
from broadsheet.session import scratch
from broadsheet.sources import snapshots
from broadsheet.sources.readers import broken_lines, present, read_marked_bronze, read_silver
from broadsheet.sources.writers import (
    FileWarehouse,
    JdbcWarehouse,
    append_bronze,
    replace_silver,
    store_counted,
)


@dataclass(frozen=True)
class Lake:
    """Where the layers live."""

    bronze: str
    silver: str
    warehouse: FileWarehouse | JdbcWarehouse
    # Where broken bronze lines are set apart; none: they are only counted.
    quarantine: str | None = None


# Hosts without a rule that a report names, those with the most pages.
HOSTS_NAMED = 20


def run_extract(pages: DataFrame, bronze: str, rules: Sequence[SiteRule] = BATCH_RULES) -> dict:
    """Append the articles of fetched pages to bronze; returns counts per source and of bad pages.

    If there are pages of hosts without a rule, the report has their number as ``unmatched_pages``, and
    ``unmatched_hosts`` with the pages of each of the ``HOSTS_NAMED`` hosts that have the most.
    """
    items, counts = gathered(read_items(pages, rules, unread=True), rules)
    unmatched = Observation("unmatched")
    items = items.observe(unmatched, F.count_if(is_unmatched()).alias("unmatched_pages"))
    append_bronze(to_articles(items), bronze)
    if not unmatched.get["unmatched_pages"]:
        return counts.get
    hosts = matched_pages(pages, rules).where(~F.col("matched")).orderBy(F.desc("pages"), "host").limit(HOSTS_NAMED)
    return {**counts.get, **unmatched.get, "unmatched_hosts": {row.host: row.pages for row in hosts.collect()}}


def run_clean(spark: SparkSession, bronze: str, silver: str, model: Model, quarantine: str | None = None) -> dict | None:
    """Rebuild silver from all of bronze; None, and nothing written, when there is no bronze yet.

    Lines that are no records count as rejected; if there are any, the report has their number as ``broken``, and
    their text and file replace the table ``quarantine``.
    """
    articles = present(lambda: read_marked_bronze(spark, bronze))
    if articles is None:
        print(f"no bronze data at {bronze}")
        return None
    lines = Observation("lines")
    marked = articles.observe(lines, F.count("broken_line").alias("broken"))
    good, report = accepted_and_observed(marked)
    replace_silver(enrich(good, model), silver)
    if quarantine is not None:
        snapshots.replace(broken_lines(articles), quarantine)
    return {**report.get, **(lines.get if lines.get["broken"] else {})}


def run_aggregate(
    spark: SparkSession, silver: str, warehouse: FileWarehouse | JdbcWarehouse
) -> dict[str, int] | None:
    """Rebuild the six gold tables; returns their row counts, or None when there is no silver yet.

    The five counts come from one scan: they are stored together once and cut apart from there.
    """
    articles = present(lambda: read_silver(spark, silver))
    if articles is None:
        print(f"no silver data at {silver}")
        return None
    with scratch(spark, "dimension-counts") as staged:
        gold.dimension_counts(articles).write.parquet(staged)
        counts = spark.read.parquet(staged)
        rows = {
            table: store_counted(gold.one_dimension(counts, dimension), table, warehouse)
            for table, dimension in gold.GOLD_TABLES.items()
        }
    keywords = gold.top_keywords(articles)
    return {**rows, gold.KEYWORD_TABLE: store_counted(keywords, gold.KEYWORD_TABLE, warehouse)}


def run(
    spark: SparkSession,
    pages: DataFrame,
    profiles: DataFrame,
    lake: Lake,
    rules: Sequence[SiteRule] = BATCH_RULES,
) -> dict:
    """Extract, clean, aggregate, strictly in this order."""
    return {
        "extract": run_extract(pages, lake.bronze, rules),
        "clean": run_clean(spark, lake.bronze, lake.silver, load_model(profiles), lake.quarantine),
        "aggregate": run_aggregate(spark, lake.silver, lake.warehouse),
    }
