"""The corpus pipeline: five stages over ``documents``, each of them one operator.

A stage takes all its predecessor kept and returns the columns of documents; the last returns a row for each pass of the
mix over a document and adds its number. Null and empty texts do not pass the first stage, as they have no language.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import decontamination, language_id, line_dedup, minhash, mixing
from broadsheet.llm.tables import Workspace, read

# The models and draws of the stages are not expressible in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat a line of an earlier place; those left without any line go."""
    deduped = line_dedup.dedup_lines(docs, every=True)
    left = deduped.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    return _with_length(left, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return minhash.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that are little else go."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return _with_length(decontamination.decontaminate(docs, items), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passes of the mix over the documents: complete ones, and the beginnings that fill its targets."""
    return mixing.epochs(docs)


def _with_length(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; the number of characters is that of the text as it is now."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*docs.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
