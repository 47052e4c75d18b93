"""The registered queries: name -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.html import INSIDE
from broadsheet.functions.language import load_model, with_language
from broadsheet.functions.text import canonical_country, normalize, strip_html
from broadsheet.operators import gold, quality
from broadsheet.operators.extract import (
    AL_JAZEERA,
    AS_IS,
    BATCH_RULES,
    BBC_NEWS,
    STREAM_RULES,
    SiteRule,
    article_url,
    has_title,
    matched_pages,
    read_items,
    to_articles,
)
from broadsheet.operators.profiles import train_profiles
from broadsheet.operators.quality import accepted
from broadsheet.operators.silver import to_silver
from broadsheet.plans import inputs, medallion
from broadsheet.schema import ARTICLE_FIELDS
from broadsheet.session import scratch_path, spread
from broadsheet.sources import readers, snapshots
from broadsheet.sources.writers import FileWarehouse, append_bronze, messages, store_counted
from broadsheet.streaming import flows
from broadsheet.streaming.progress import CycleLog, read_cycles

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(inputs.busy_articles(spark, sf_dir), inputs.model(spark, sf_dir))


def _accepted_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted articles with canonical country: all that the counts below read of silver."""
    return accepted(inputs.articles(spark, sf_dir)).withColumn("country", canonical_country(F.col("country")))


# -- keywords -----------------------------------------------------------------------------------


@_query
def top_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_keywords(spread(inputs.table(spark, sf_dir, "documents", "text")), "text")


@_query
def top_keywords_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_keywords(spread(inputs.table(spark, sf_dir, "documents", "text")), "text", "unicode")


@_query
def unbroken_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of texts whose blanks are gone: each line is one word, however long."""
    documents = spread(inputs.table(spark, sf_dir, "documents", "text"))
    return gold.top_keywords(documents.select(F.translate("text", " ", "").alias("text")), "text")


@_query
def title_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = accepted(inputs.articles(spark, sf_dir)).select(strip_html(F.col("title")).alias("title_clean"))
    return gold.top_keywords(titles)


# -- text ---------------------------------------------------------------------------------------


@_query
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(inputs.table(spark, sf_dir, "pages", "page_id", "html"))
    return pages.select("page_id", strip_html(F.col("html")).alias("text"))


@_query
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(inputs.table(spark, sf_dir, "pages", "page_id", "html"))
    return pages.select("page_id", normalize(strip_html(F.col("html"))).alias("text"))


@_query
def country_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.articles(spark, sf_dir).select("id", canonical_country(F.col("country")).alias("country"))


# -- quality and silver -------------------------------------------------------------------------


@_query
def quality_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(inputs.articles(spark, sf_dir))


@_query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(inputs.articles(spark, sf_dir))


@_query
def silver_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).drop("processed_at")


# -- gold counts --------------------------------------------------------------------------------


@_query
def articles_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.newest_first(gold.articles_per(_accepted_countries(spark, sf_dir), "publish_day"))


@_query
def articles_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.largest_first(gold.articles_per(_accepted_countries(spark, sf_dir), "source"))


@_query
def articles_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.largest_first(gold.articles_per(_accepted_countries(spark, sf_dir), "category"))


@_query
def articles_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.largest_first(gold.articles_per(_accepted_countries(spark, sf_dir), "country"))


@_query
def articles_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.largest_first(gold.articles_per(_silver(spark, sf_dir), "language"))


@_query
def articles_all_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dimension_counts(_silver(spark, sf_dir))


@_query
def events_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.table(spark, sf_dir, "events", "ts").groupBy(F.to_date("ts").alias("publish_day"))
    return gold.newest_first(days.agg(F.count("*").alias("article_count")))


@_query
def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages per host, with and without a rule that reads them; a host of the given pages stands in for a site."""
    pages = inputs.table(spark, sf_dir, "pages", "url")
    return matched_pages(pages, (replace(BBC_NEWS, host="www.ththon.example.org"), AL_JAZEERA))


@_query
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.oldest_first(gold.articles_per(_accepted_countries(spark, sf_dir), "publish_day"))


@_query
def country_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.share_of_total(gold.articles_per(_accepted_countries(spark, sf_dir), "country"))


@_query
def language_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.share_of_total(gold.articles_per(_silver(spark, sf_dir), "language"))


@_query
def source_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.source_totals(inputs.articles(spark, sf_dir))


# -- language -----------------------------------------------------------------------------------


@_query
def language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_profiles(spread(inputs.table(spark, sf_dir, "documents", "text", "lang")))


@_query
def language_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(inputs.table(spark, sf_dir, "documents", "doc_id", "text"))
    return with_language(documents, "text", inputs.model(spark, sf_dir)).drop("text")


@_query
def language_detect_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of ``language_detect`` by a model of which a hundred rows are broadcast and the others joined."""
    documents = spread(inputs.table(spark, sf_dir, "documents", "doc_id", "text"))
    model = load_model(inputs.profiles(spark, sf_dir), most_rows=100)
    return with_language(documents, "text", model).drop("text")


# -- extraction ---------------------------------------------------------------------------------


def _plain_rule(tag: str, css_class: str | None = None) -> SiteRule:
    """All elements of a tag, their own text as title, their first link as it stands."""
    return SiteRule("", "", tag, css_class, None, INSIDE, None, AS_IS, "", "", "", "", "", "")


def _page_items(spark: SparkSession, sf_dir: str, rule: SiteRule) -> DataFrame:
    pages = spread(inputs.table(spark, sf_dir, "pages", "page_id", "html"))
    items = read_items(pages, rule).where(has_title())
    return items.select("page_id", F.col("pos").cast("bigint").alias("pos"), "title", article_url().alias("url"))


@_query
def extract_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_items(spark, sf_dir, _plain_rule("h1")).drop("url")


@_query
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_items(spark, sf_dir, _plain_rule("li"))


@_query
def extract_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_items(spark, sf_dir, _plain_rule("div", "ad"))


def _identified(items: DataFrame) -> DataFrame:
    """Articles with an id made of page and position, and a fixed fetch time."""
    article_id = F.concat_ws("-", "page_id", "pos")
    return to_articles(items, article_id, F.lit("2024-01-01T08:30:00Z").cast("timestamp"))


@_query
def site_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identified(read_items(inputs.site_pages(spark, sf_dir, BATCH_RULES), BATCH_RULES))


@_query
def live_site_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identified(read_items(inputs.site_pages(spark, sf_dir, STREAM_RULES), STREAM_RULES))


# -- sources and sinks --------------------------------------------------------------------------


@_query
def article_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.decode_messages(messages(inputs.articles(spark, sf_dir)))


@_query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    append_bronze(inputs.articles(spark, sf_dir), path)
    return readers.read_bronze(spark, path)


@_query
def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of bronze lines that are no records, and how many lines were read and are good."""
    path = scratch_path(spark, "bronze-with-broken")
    inputs.bronze_lines(spark, sf_dir).write.text(path)
    # Bronze is what other programs write: files by the name of the format.
    marked = readers.read_marked_bronze(spark, path, "*")
    counts = marked.agg(F.count("*").alias("loaded"), (F.count("*") - F.count("broken_line")).alias("good"))
    one = counts.select(F.struct("loaded", "good").alias("c")).scalar()
    return readers.broken_lines(marked).select("line", one["loaded"].alias("loaded"), one["good"].alias("good"))


@_query
def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = FileWarehouse(scratch_path(spark, "gold"))
    by_source = gold.articles_per(_accepted_countries(spark, sf_dir), "source")
    stored = store_counted(by_source, "gold_articles_per_source", warehouse)
    loaded = warehouse.load(spark, "gold_articles_per_source")
    return loaded.withColumn("stored_rows", F.lit(stored).cast("bigint"))


# -- streams ------------------------------------------------------------------------------------


@_query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = scratch_path(spark, "arriving")
    silver = scratch_path(spark, "stream-silver")
    append_bronze(inputs.busy_articles(spark, sf_dir), bronze)
    stream = readers.stream_bronze(spark, bronze)
    model = inputs.model(spark, sf_dir)
    flows.start_cleaning(stream, model, silver, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return readers.read_silver(spark, silver).drop("processed_at")


@_query
def stream_site_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = scratch_path(spark, "arriving-pages")
    topic = scratch_path(spark, "topic")
    inputs.site_pages(spark, sf_dir, STREAM_RULES).write.parquet(pages)
    sent = flows.ingest(readers.stream_pages(spark, pages))
    flows.start_publishing(sent, scratch_path(spark, "offsets"), path=topic, once=True).awaitTermination()
    received = readers.decode_messages(spark.read.text(topic))
    return received.select(*[name for name in ARTICLE_FIELDS if name not in ("id", "published_date")])


@_query
def stream_bounded_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of pages worked off one file a cycle, by what the cycles stored: they add up to the backlog."""
    pages, at = scratch_path(spark, "backlog"), scratch_path(spark, "bounded")
    made = inputs.site_pages(spark, sf_dir, STREAM_RULES)
    stray = made.withColumn("url", F.when(F.col("page_id") % 7 == 0, "https://elsewhere.example/").otherwise(F.col("url")))
    stray.repartition(inputs.BACKLOG_FILES, "page_id").write.parquet(pages)
    with CycleLog(spark, f"{at}/cycles"):
        stream = readers.stream_pages(spark, pages, files_per_cycle=1)
        flows.start_publishing(flows.ingest(stream), f"{at}/offsets", path=f"{at}/topic", once=True).awaitTermination()
    cycles = read_cycles(spark, f"{at}/cycles")
    counts = {name: F.sum(F.col("counts")[name]).alias(name) for name in ("sent", "failed_pages", "unmatched_pages")}
    return cycles.agg(F.count("*").alias("cycles"), F.sum("rows").alias("pages"), *counts.values())


@_query
def stream_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without a message, by host: those that hosts without a rule sent in two cycles."""
    pages, at = scratch_path(spark, "arriving-pages"), scratch_path(spark, "letters")
    made = inputs.site_pages(spark, sf_dir, STREAM_RULES)
    hosts = F.concat(F.lit("https://site"), (F.col("page_id") % 11).cast("string"), F.lit(".example/"))
    for odd in (0, 1):
        part = made.where(F.col("page_id") % 2 == odd)
        part.withColumn("url", F.when(F.col("page_id") % 3 == 0, hosts).otherwise(F.col("url"))).write.mode("append").parquet(pages)
        stream = readers.stream_pages(spark, pages)
        flows.start_ingest(stream, f"{at}/offsets", f"{at}/letters", path=f"{at}/topic", once=True).awaitTermination()
    unmatched = spark.read.parquet(f"{at}/letters/unmatched").groupBy("host").agg(F.sum("pages").alias("pages"))
    sent = spark.read.text(f"{at}/topic").agg(F.count("*")).scalar()
    failed = spark.read.parquet(f"{at}/letters/failed").agg(F.count("*")).scalar()
    return unmatched.select("host", "pages", sent.alias("sent"), failed.alias("failed"))


@_query
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles per day, kept up to date over three cycles: the batch count, as no article is late."""
    bronze, at = scratch_path(spark, "arriving"), scratch_path(spark, "daily")
    articles = inputs.articles(spark, sf_dir)
    for cycle in range(3):
        append_bronze(articles.where(F.pmod(F.col("id").cast("long"), F.lit(3)) == cycle), bronze)
        stream = readers.stream_bronze(spark, bronze)
        flows.start_daily_counts(stream, f"{at}/table", f"{at}/offsets", late="60 days", once=True).awaitTermination()
    return snapshots.read(spark, f"{at}/table")


# -- the whole chain ----------------------------------------------------------------------------


def _long(table: DataFrame, name: str, key: str, value: str) -> DataFrame:
    return table.select(F.lit(name).alias("name"), F.col(key).cast("string").alias("key"), F.col(value).alias("value"))


@_query
def news_run_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three sites through all stages; the gold tables in one list, the run's day left out."""
    warehouse = FileWarehouse(scratch_path(spark, "run-gold"))
    lake = medallion.Lake(scratch_path(spark, "run-bronze"), scratch_path(spark, "run-silver"), warehouse)
    pages = inputs.site_pages(spark, sf_dir, BATCH_RULES)
    medallion.run(spark, pages, inputs.profiles(spark, sf_dir), lake)
    per_day = warehouse.load(spark, "gold_articles_per_day").agg(F.sum("article_count").alias("article_count"))
    parts = [_long(per_day.withColumn("publish_day", F.lit(None)), "gold_articles_per_day", "publish_day", "article_count")]
    for table, dimension in gold.GOLD_TABLES.items():
        if dimension != "publish_day":
            parts.append(_long(warehouse.load(spark, table), table, dimension, "article_count"))
    parts.append(_long(warehouse.load(spark, gold.KEYWORD_TABLE), gold.KEYWORD_TABLE, "word", "frequency"))
    return reduce(DataFrame.unionByName, parts)


@_query
def dashboard_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored gold tables read through the dashboard views."""
    silver = scratch_path(spark, "dashboard-silver")
    warehouse = FileWarehouse(scratch_path(spark, "dashboard-gold"))
    _silver(spark, sf_dir).write.parquet(silver)
    medallion.run_aggregate(spark, silver, warehouse)
    tables = [*gold.GOLD_TABLES, gold.KEYWORD_TABLE]
    gold.register_dashboard_views(spark, {name: warehouse.load(spark, name) for name in tables})
    return spark.sql("""
        SELECT 'daily_trend' AS chart, CAST(publish_day AS string) AS label, CAST(article_count AS double) AS value
        FROM dashboard_daily_trend
        UNION ALL SELECT 'sources', source, article_count FROM dashboard_sources
        UNION ALL SELECT 'country_share', country, share FROM dashboard_country_share
        UNION ALL SELECT 'language_share', language, share FROM dashboard_language_share
        UNION ALL SELECT 'keywords', word, frequency FROM dashboard_keywords
    """)
