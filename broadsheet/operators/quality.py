"""Completeness and validity rules for bronze articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from broadsheet.schema import MIN_CONTENT_LENGTH


def is_complete() -> Column:
    return (
        F.col("title").isNotNull()
        & (F.col("title") != "")
        & F.col("published_date").isNotNull()
        & F.col("content").isNotNull()
    )


def is_valid() -> Column:
    """Length in characters of the raw content, tags included."""
    return F.length("content") >= MIN_CONTENT_LENGTH


def accepted(articles: DataFrame) -> DataFrame:
    return articles.where(is_complete() & is_valid())


def quality_counts() -> list[Column]:
    passed = F.count_if(is_complete() & is_valid())
    return [
        F.count("*").alias("loaded"),
        passed.alias("accepted"),
        (F.count("*") - passed).alias("rejected"),
    ]


def quality_report(articles: DataFrame) -> DataFrame:
    """One row: loaded, accepted, rejected."""
    return articles.agg(*quality_counts())


def accepted_and_observed(articles: DataFrame) -> tuple[DataFrame, Observation]:
    """Accepted rows plus the report, both from the one pass that writes the rows."""
    observation = Observation("quality")
    return accepted(articles.observe(observation, *quality_counts())), observation
