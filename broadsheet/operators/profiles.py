"""Training of language profiles from labelled text."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.language import in_one_piece, joined_windows, letters, unpacked

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WEIGHT_SCALE = 1_000_000

# Different grams of a language that a task counts before it passes them on.
GRAMS_HELD = 1 << 21


class _Counts:
    """Sorted grams of one language and how often each was met."""

    def __init__(self):
        self.grams, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def add(self, grams: np.ndarray) -> None:
        new, n = np.unique(grams, return_counts=True)
        both, place = np.unique(np.concatenate([self.grams, new]), return_inverse=True)
        counts = np.zeros(len(both), dtype=np.int64)
        counts[place[: len(self.grams)]] = self.counts
        counts[place[len(self.grams) :]] += n
        self.grams, self.counts = both, counts

    def rows(self, lang: str) -> pa.RecordBatch:
        real = in_one_piece(self.grams)
        grams, counts = self.grams[real].astype(np.int64), self.counts[real]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
            names=["lang", "packed", "n"],
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of a task's texts, counted per language."""
    held: dict[str, _Counts] = {}
    for batch in batches:
        names = batch.column("lang").dictionary_encode()
        for number, lang in enumerate(names.dictionary.to_pylist()):
            texts = batch.column("letters").filter(pc.equal(names.indices, number)).to_pylist()
            for grams in joined_windows(texts):
                counts = held.setdefault(lang, _Counts())
                counts.add(grams)
                if len(counts.grams) >= GRAMS_HELD:
                    yield held.pop(lang).rows(lang)
    for lang, counts in held.items():
        yield counts.rows(lang)


def train_profiles(labelled: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """``(lang, gram, gram_count, weight)`` of every gram; weight is the scaled log ratio to an unseen gram.

    An unseen gram counts as half a gram of the language with the most grams, which is the same share for all
    languages, and below that of every gram seen. A task counts packed grams and hands on each of them once, so
    only distinct grams are shuffled, as integers; they become text again at the end. The totals, one per
    language, reach the counts as a one-row map.
    """
    texts = labelled.where(F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("lang"), letters(F.col(text)).alias("letters")
    )
    counted = texts.mapInArrow(_counted, "lang string, packed long, n long")
    counts = counted.groupBy("lang", "packed").agg(F.sum("n").alias("gram_count"))
    totals = counts.groupBy("lang").agg(F.sum("gram_count").alias("total"))
    by_lang = totals.agg(F.map_from_entries(F.collect_list(F.struct("lang", "total")))).scalar()
    most = totals.agg(F.max("total")).scalar()
    ratio = (F.col("gram_count") * 2 * most).cast("double") / F.element_at(by_lang, F.col("lang")).cast("double")
    return counts.select(
        "lang",
        unpacked(F.col("packed")).alias("gram"),
        "gram_count",
        F.round(F.log(ratio) * WEIGHT_SCALE).cast("bigint").alias("weight"),
    )
