"""Silver articles to the gold tables and the views dashboards read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions.text import (
    bounded_pieces,
    is_stopword,
    listed_keywords,
    plain_words,
    publish_day,
)
from broadsheet.schema import MIN_KEYWORD_LENGTH, TOP_KEYWORDS

DIMENSIONS = ("publish_day", "source", "category", "country", "language")

GOLD_TABLES = {
    "gold_articles_per_day": "publish_day",
    "gold_articles_per_source": "source",
    "gold_articles_per_category": "category",
    "gold_articles_per_country": "country",
    "gold_articles_per_language": "language",
}
KEYWORD_TABLE = "gold_top_keywords"


def _dimension(name: str) -> Column:
    return publish_day(F.col("published_date")).alias(name) if name == "publish_day" else F.col(name)


def articles_per(silver: DataFrame, dimension: str) -> DataFrame:
    """``(dimension, article_count)``; a null key is a group of its own."""
    return (
        silver.select(_dimension(dimension)).groupBy(dimension).agg(F.count("*").alias("article_count"))
    )


def dimension_counts(silver: DataFrame) -> DataFrame:
    """All five counts from one scan: ``(dimension, <five keys>, article_count)``.

    ``dimension`` names the key a row counts, which tells a null key from a key not in the group.
    """
    counted = (
        silver.select(*[_dimension(name) for name in DIMENSIONS])
        .groupingSets([[name] for name in DIMENSIONS], *DIMENSIONS)
        .agg(F.grouping_id().alias("_absent"), F.count("*").alias("article_count"))
    )
    all_absent = (1 << len(DIMENSIONS)) - 1
    which = F.lit(None).cast("string")
    for position, name in enumerate(DIMENSIONS):
        own_bit = 1 << (len(DIMENSIONS) - 1 - position)
        which = F.when(F.col("_absent") == all_absent - own_bit, name).otherwise(which)
    return counted.select(which.alias("dimension"), *DIMENSIONS, "article_count")


def one_dimension(counts: DataFrame, dimension: str) -> DataFrame:
    """Cut one gold table out of :func:`dimension_counts`."""
    return counts.where(F.col("dimension") == dimension).select(dimension, "article_count")


def newest_first(per_day: DataFrame) -> DataFrame:
    return per_day.orderBy(F.desc("publish_day"))


def oldest_first(per_day: DataFrame) -> DataFrame:
    return per_day.orderBy(F.asc("publish_day"))


def largest_first(counts: DataFrame, count: str = "article_count") -> DataFrame:
    """Descending count; equal counts in ascending key order."""
    keys = [name for name in counts.columns if name != count]
    return counts.orderBy(F.desc(count), *keys)


def share_of_total(counts: DataFrame) -> DataFrame:
    """Adds ``share``. The total is a one-row scalar subquery, so no single task sees all keys."""
    total = counts.agg(F.sum("article_count")).scalar()
    return counts.withColumn("share", F.round(F.col("article_count") / total, 6))


def word_frequency(texts: DataFrame, text: str, mode: str = "ascii") -> DataFrame:
    """``(word, frequency)``, however long texts and words are.

    Texts are read once and counted in bounded pieces. Parts of words that a cut went through travel among the
    words, marked as such, and are put together after the count.
    """
    counted = (
        _pieces(texts.select(plain_words(F.col(text), mode).alias("plain")))
        .select(F.explode(F.concat(listed_keywords(F.col("inner"), mode), "parts")).alias("word"))
        .where(~is_stopword(F.col("word")))
        .groupBy("word")
        .agg(F.count("*").alias("frequency"))
    )
    # Both halves ask about the count, too, so that the question stays above it and the one count serves both.
    is_part = F.when(F.col("frequency") > 0, F.col("word").startswith(MARK))
    cut = _cut_words(counted.where(is_part)).where(~is_stopword(F.col("word")))
    both = counted.where(~is_part).union(cut.where(F.length("word") >= MIN_KEYWORD_LENGTH))
    return both.groupBy("word").agg(F.sum("frequency").alias("frequency"))


# What parts of words begin with, and what stands between their fields; part of no word.
MARK = "\0"


def _pieces(plain: DataFrame) -> DataFrame:
    """``(inner, parts)`` of the pieces of texts ``(plain)`` of words and white space.

    ``inner`` holds the words no cut went through; ``parts`` those of others, marked: the ``head`` of a piece, the rest
    of a word that began in an earlier one, and its ``tail``, the beginning of a word that goes on in the next. A
    piece inside one word is a head that does not end it.
    """
    cut = plain.select("plain", bounded_pieces(F.col("plain")).alias("pieces"))

    def joined(left: Column, right: Column) -> Column:
        """Whether a word goes on from one piece to the next."""
        return F.coalesce(left.rlike(r"\S\z") & right.rlike(r"\A\S"), F.lit(False))

    def marked(piece: Column, i: Column) -> Column:
        before, after = F.get("pieces", i - 1), F.get("pieces", i + 1)
        return F.struct(i.alias("i"), piece.alias("piece"), joined(before, piece).alias("goes_on"), joined(piece, after).alias("is_cut"))

    alone = F.struct(F.lit(0).alias("i"), F.col("plain").alias("piece"), F.lit(False).alias("goes_on"), F.lit(False).alias("is_cut"))
    several = F.size("pieces") > 1
    listed = cut.select(
        # Equal texts share a number, and their parts are counted together.
        F.when(several, F.sha2("plain", 256)).alias("text"),
        F.explode(F.when(several, F.transform("pieces", marked)).otherwise(F.array(alone))).alias("p"),
    ).select("text", "p.*")
    inside = F.col("goes_on") & F.col("is_cut") & ~F.col("piece").rlike(r"\s")
    head = F.when(F.col("goes_on"), F.regexp_extract("piece", r"\A\S*+", 0))
    tail = F.when(F.col("is_cut") & ~inside, F.regexp_extract("piece", r"\S*+\z", 0))
    parts = F.array_compact(F.array(
        _marked("text", "i", F.when(inside, "inside").otherwise("head"), head), _marked("text", "i", F.lit("tail"), tail)
    ))
    length = {name: F.coalesce(F.length(part), F.lit(0)) for name, part in (("head", head), ("tail", tail))}
    inner = F.substring("piece", length["head"] + 1, F.length("piece") - length["head"] - length["tail"])
    whole = ~F.col("goes_on") & ~F.col("is_cut")
    return listed.select(
        F.when(whole, F.col("piece")).otherwise(inner).alias("inner"),
        F.when(whole, F.array().cast("array<string>")).otherwise(parts).alias("parts"),
    )


def _marked(text: str, i: str, kind: Column, part: Column) -> Column:
    fields = [F.col(text), F.col(i).cast("string"), kind, part]
    return F.when(part.isNotNull(), F.concat(*[column for field in fields for column in (F.lit(MARK), field)]))


def _cut_words(parts: DataFrame) -> DataFrame:
    """``(word, frequency)``: words put together from marked parts ``(word, frequency)``."""
    fields = F.split("word", MARK)
    names = ("text", "i", "kind", "part")
    parts = parts.select(*[F.get(fields, F.lit(at + 1)).alias(name) for at, name in enumerate(names)], "frequency")
    parts = parts.withColumn("i", F.col("i").cast("int"))
    # The words of a text that were cut are numbered by those that ended before: a tail begins one, a head ends it.
    before = Window.partitionBy("text").orderBy("i", "kind").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum((F.col("kind") == "head").cast("int")).over(before), F.lit(0))
    in_order = F.array_sort(F.collect_list(F.struct("i", "part")))
    words = parts.withColumn("ended", ended).groupBy("text", "ended")
    return words.agg(F.array_join(in_order["part"], "").alias("word"), F.max("frequency").alias("frequency")).select("word", "frequency")


def top_keywords(
    texts: DataFrame, text: str = "title_clean", mode: str = "ascii", limit: int = TOP_KEYWORDS
) -> DataFrame:
    """The most frequent words; words tied at the last place enter in ascending order."""
    return word_frequency(texts, text, mode).orderBy(F.desc("frequency"), "word").limit(limit)


def source_totals(articles: DataFrame) -> DataFrame:
    """Articles per source plus the grand total, which alone has ``is_total`` = 1."""
    return (
        articles.rollup("source")
        .agg(F.grouping("source").cast("int").alias("is_total"), F.count("*").alias("article_count"))
        .select("source", "is_total", "article_count")
    )


def register_dashboard_views(spark: SparkSession, gold: dict[str, DataFrame]) -> list[str]:
    """Temp views, one per dashboard chart, over the stored gold tables."""
    views = {
        "dashboard_daily_trend": oldest_first(gold["gold_articles_per_day"]),
        "dashboard_sources": largest_first(gold["gold_articles_per_source"]),
        "dashboard_country_share": largest_first(
            share_of_total(gold["gold_articles_per_country"]).drop("article_count"), "share"
        ),
        "dashboard_language_share": largest_first(
            share_of_total(gold["gold_articles_per_language"]).drop("article_count"), "share"
        ),
        "dashboard_keywords": largest_first(gold[KEYWORD_TABLE], "frequency"),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
