"""Inputs of the registered queries, all derived from the given tables by row-local work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.language import Model, load_model
from broadsheet.operators.extract import SiteRule
from broadsheet.operators.profiles import train_profiles
from broadsheet.session import scratch_path, spread
from broadsheet.sources.readers import present

# Articles with gaps of every kind, made of documents. The text runs in Spark SQL and in ANSI SQL.
ARTICLE_VIEW = """
SELECT CAST(doc_id AS string) AS id,
  CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN ''
       WHEN instr(text, chr(10)) > 0
       THEN concat('<b>', substr(text, 1, instr(text, chr(10)) - 1), '</b>')
       ELSE concat('<b>', text, '</b>') END AS title,
  concat(source, ' Staff') AS author,
  CASE WHEN doc_id % 31 = 0 THEN NULL
       ELSE concat('2024-01-', lpad(CAST(doc_id % 28 + 1 AS string), 2, '0'), 'T10:00:00.000001')
       END AS published_date,
  CASE WHEN doc_id % 3 = 0 THEN 'News' WHEN doc_id % 3 = 1 THEN 'General' END AS category,
  text AS content,
  source,
  CASE doc_id % 6 WHEN 0 THEN 'Maroc' WHEN 1 THEN 'MA' WHEN 2 THEN 'morocco'
                  WHEN 3 THEN 'International' WHEN 4 THEN '' END AS country,
  concat('https://example.org/', CAST(doc_id AS string)) AS url
FROM {documents}
"""

# The layout of a made page repeats over its lines: every fourth item lacks a title element, and
# links are site-relative, absolute and absent in turn.
UNTITLED_EVERY = 4
LINK_KINDS = 3

# Files of a backlog of pages.
BACKLOG_FILES = 5

_profile_paths: dict[tuple[str, str], str] = {}
_models: dict[str, Model] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return spark.sql(ARTICLE_VIEW, documents=documents)


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as JSON lines ``(value)``; every seventh line breaks off before its text, which stands there bare."""
    text = F.translate("text", "\n\r", "  ")
    record = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content")))
    broken = F.concat(F.lit('{"id": "'), F.col("doc_id").cast("string"), F.lit('", "content": '), text)
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return documents.select(F.when(F.col("doc_id") % 7 == 0, broken).otherwise(record).alias("value"))


def busy_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles for work that reads every character."""
    documents = spread(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return spark.sql(ARTICLE_VIEW, documents=documents)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language profiles of the labelled documents, trained and stored once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _profile_paths.get(key)
    stored = present(lambda: spark.read.parquet(path)) if path else None
    if stored is None:
        path = scratch_path(spark, "profiles")
        labelled = spread(table(spark, sf_dir, "documents", "text", "lang"))
        train_profiles(labelled).write.parquet(path)
        _profile_paths[key] = path
        stored = spark.read.parquet(path)
    return stored


def model(spark: SparkSession, sf_dir: str) -> Model:
    """The model of the labelled documents, fetched once per stored profile."""
    stored = profiles(spark, sf_dir)
    path = _profile_paths[spark.sparkContext.applicationId, sf_dir]
    if path not in _models:
        _models[path] = load_model(stored)
    return _models[path]


def _escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def site_pages(spark: SparkSession, sf_dir: str, rules: tuple[SiteRule, ...]) -> DataFrame:
    """A page per document in the layout of one of the sites, with an item per line of its text."""
    hosts = F.array(*[F.lit(rule.host) for rule in rules])
    documents = spread(table(spark, sf_dir, "documents", "doc_id", "text"))
    host = F.element_at(hosts, (F.col("doc_id") % len(rules) + 1).cast("int"))

    def item(line: Column, i: Column) -> Column:
        text = _escaped(line)
        target = F.when(i % LINK_KINDS == 0, F.concat(F.lit("/story/"), i.cast("string"))).when(
            i % LINK_KINDS == 1, F.concat(F.lit("https://example.org/story/"), i.cast("string"))
        )
        opened = F.when(target.isNull(), "").otherwise(F.concat(F.lit('<a href="'), target, F.lit('">')))
        closed = F.when(target.isNull(), "").otherwise("</a>")
        heading = F.when(i % UNTITLED_EVERY == UNTITLED_EVERY - 1, "h4").otherwise("h3")
        titled = F.concat(F.lit("<"), heading, F.lit(">"), text, F.lit("</"), heading, F.lit(">"))
        linked = F.concat(opened, F.lit("more"), closed)
        return (
            F.when(host == "www.aljazeera.com", F.concat(F.lit("<article>"), titled, linked, F.lit("</article>")))
            .when(host == "www.bbc.com", F.concat(opened, F.lit("<h3>"), text, F.lit("</h3>"), closed))
            .when(host == "en.hespress.com", F.concat(F.lit('<div class="card big">'), titled, linked, F.lit("</div>")))
            .when(i % 2 == 0, F.concat(F.lit("<h2>"), opened, text, closed, F.lit("</h2>")))
            .otherwise(F.concat(opened, F.lit("<h2>"), text, F.lit("</h2>"), closed))
        )

    body = F.array_join(F.transform(F.split("text", "\n"), item), "")
    return documents.select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit("https://"), host, F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"),
    )
