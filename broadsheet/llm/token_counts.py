"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are encoded whole and only their lengths are counted. Sums over the histogram, from below and from
above, give for every length the documents and tokens within that limit, the tokens left of all documents
when each is truncated there, and the length's place among the quantiles.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm import tokenizers
from broadsheet.llm.tables import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Running sums go over blocks of lengths first, then inside a block, so that no task sorts all lengths.
BLOCK = 4096


def encoded_length(text: Column, folder: str = tokenizers.FOLDER, name: str = tokenizers.BYTE_BPE) -> Column:
    """Tokens of the whole text; 0 for null and empty texts."""
    return _counter(folder, name)(text.cast("string"))


def _counter(folder: str, name: str) -> Callable:
    loaded: dict = {}

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        tokenizer = loaded.get((folder, name))
        if tokenizer is None:
            tokenizer = loaded[folder, name] = tokenizers.byte_bpe(folder, name)
        return pa.array([len(tokenizer.encode_ordinary(text.as_py() or "")) for text in texts], pa.int64())

    return count


def histogram(lengths: DataFrame) -> DataFrame:
    """``(length, n_docs)`` from ``(length)``."""
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def limits(counts: DataFrame, work: Workspace) -> DataFrame:
    """For every length of a histogram, taken as a context limit:

    ``docs_within`` and ``tokens_within``: documents that fit, and their tokens; ``docs_beyond``: the others;
    ``tokens_truncated``: tokens left when each document is cut at the limit; ``tokens_lost``: those cut off;
    ``quantile``: share of documents that fit.
    """
    counts = work.keep(counts.withColumn("block", F.floor(F.col("length") / BLOCK)))
    sums = {"d": F.sum("n_docs"), "t": F.sum(F.col("n_docs") * F.col("length"))}
    blocks = counts.groupBy("block").agg(*[total.alias(name) for name, total in sums.items()])
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name in sums],
        *[F.sum(name).over(everything).alias(f"{name}_all") for name in sums],
    )
    inside = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.select("block", "length", "n_docs", *[t.over(inside).alias(n) for n, t in sums.items()])
    summed = summed.join(blocks, "block")
    docs, tokens = F.col("d_before") + F.col("d"), F.col("t_before") + F.col("t")
    beyond = F.col("d_all") - docs
    truncated = tokens + beyond * F.col("length")
    return summed.select(
        "length",
        "n_docs",
        docs.alias("docs_within"),
        tokens.alias("tokens_within"),
        beyond.alias("docs_beyond"),
        truncated.alias("tokens_truncated"),
        (F.col("t_all") - truncated).alias("tokens_lost"),
        (docs / F.col("d_all")).alias("quantile"),
    )


def token_counts(
    docs: DataFrame,
    folder: str = tokenizers.FOLDER,
    name: str = tokenizers.BYTE_BPE,
    label: str = "token-counts",
) -> DataFrame:
    """:func:`limits` of the encoded lengths of all ``docs`` ``(text, ...)``.

    Null and empty texts have the length 0 and are counted. Repeated rows count each time. No document gives
    no row. Other columns are ignored. A limit between two lengths answers as the next smaller length, but for
    ``tokens_truncated``, which grows by ``docs_beyond`` with each token of the limit.
    """
    work = Workspace(docs.sparkSession, label)
    return limits(histogram(docs.select(encoded_length(F.col("text"), folder, name).alias("length"))), work)
