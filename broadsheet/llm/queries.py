"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm import (
    bpe,
    decontamination,
    fertility,
    language_id,
    lexical,
    line_dedup,
    minhash,
    mixing,
    pii,
    token_counts,
    url_filters,
    whitening,
    wrappers,
)
from broadsheet.llm.tables import read


URL_RULES = (
    url_filters.Rule("net", "/", block=True),
    url_filters.Rule("example.net", "/en/", block=False),
    url_filters.Rule("example.com", "/de/", block=True),
    url_filters.Rule("org", "/fr/", block=False),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page.

    The number in a page's url is that of the document it shows; a label of that document labels the url: bad
    is toxic or of low quality.
    """
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    bad = F.greatest(F.col("toxic"), F.lit(1) - F.col("quality"))
    labels = read(spark, sf_dir, "labels", "doc_id", "quality", "toxic").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    number = F.regexp_extract(url_filters.path(F.col("url")), r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    labelled = pages.withColumn("doc_id", F.nullif(number, F.lit("")).cast("long")).join(labels, "doc_id", "left")
    judged = url_filters.judge(labelled.select("page_id", "url", "bad"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "bad_share")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.digest(read(spark, sf_dir, "documents", "doc_id", "text"), items)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat, nearly or exactly, a line kept elsewhere."""
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"), every=True)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the folds that are not held out."""
    return language_id.predict(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every context limit means for the documents."""
    return token_counts.token_counts(read(spark, sf_dir, "documents", "text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and fertility verdict of every document."""
    return fertility.judge(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of valid numbers and dates. The key is for tests only."""
    return pii.pseudonymise(read(spark, sf_dir, "documents", "doc_id", "text"), key="registered query")


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    extracted = wrappers.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", "n_chars")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that rank highest for each benchmark item."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return lexical.search(read(spark, sf_dir, "documents", "doc_id", "text"), items)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding along the first 16 components, whitened."""
    return whitening.whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    return bpe.digest(read(spark, sf_dir, "documents", "doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_url_filters,
        op2_token_counts,
        op3_minhash,
        op4_extraction,
        op5_pii,
        op6_decontamination,
        op7_line_dedup,
        op8_language_id,
        op9_mixing,
        op10_quality,
        op11_lexical_search,
        op12_whitening,
        op13_bpe,
        pipeline,
    )
    return {query.__name__: query for query in listed}
