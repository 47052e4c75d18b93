"""Language detection with character-trigram profiles.

Grams are packed into integers of three code points. Training counts them per task (``operators/profiles.py``).
Scoring adds up integer weights, so sums are exact in any order and any split. As much of a profile as has room in
memory is broadcast, the commonest grams first, and scored on the row: no text is shuffled, rows need no key, and
the same column works in a stream. What has no room is scored by a join of gram counts with the rest of the profile
(:func:`with_language`); as the commonest grams are not among it, few rows move.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.batches import parts
from broadsheet.functions.text import LOWER, PIECE_LENGTH, strip
from broadsheet.schema import UNKNOWN_LANGUAGE
from broadsheet.session import scratch_path

# Executors then need no copy of this package to run the scoring function.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_DETECT_LENGTH = 10
EACH_TRIGRAM = r"(?s)(?=(...))."

# Rows of a profile that are broadcast, some 100 MB for ten languages, and the bytes of their table.
MAX_MODEL_ROWS = 5_000_000
MAX_MODEL_BYTES = 1 << 30

# A gap to rewrite as one blank: any run of non-letters that is not a lone blank already.
NOT_LETTER = rf"[[^{LOWER}]&&[^\p{{L}}\p{{M}}]]"
GAP = rf"{NOT_LETTER}(?:{NOT_LETTER}++|(?<! ))"

CODE_POINT_BITS = 21
HASH_MULTIPLIER = 0x9E3779B97F4A7C15
SLOTS_PER_KEY = 4
CHUNK = 1 << 18  # characters scored at a time, which bounds the memory of a task
SEPARATOR = "\0"  # part of no gram

# Counts per octave by which grams are ranked when some have to stay out of the broadcast.
STEPS = 8


@dataclass(frozen=True)
class Model:
    """A profile: the part that is broadcast, and the rows that are joined, ``(packed, lang, weight)``, if any."""

    head: Broadcast
    tail: DataFrame | None = None


def letters(text: Column) -> Column:
    """Lower-case letter runs, one blank between and around them."""
    runs = F.btrim(F.regexp_replace(F.lower(text), GAP, " "))
    return F.concat(F.lit(" "), runs, F.lit(" "))


def trigrams(piece: Column) -> Column:
    """All overlapping three-character windows of a piece of letters, found in one pass."""
    return F.regexp_extract_all(piece, F.lit(EACH_TRIGRAM), F.lit(1))


def packed(gram: Column) -> Column:
    """Three characters as one integer, the form in which grams are counted and looked up."""
    first, second, third = (F.ascii(F.substring(gram, place, 1)).cast("long") for place in (1, 2, 3))
    return F.shiftleft(first, 2 * CODE_POINT_BITS).bitwiseOR(F.shiftleft(second, CODE_POINT_BITS)).bitwiseOR(third)


def unpacked(number: Column) -> Column:
    """The three characters of a packed gram."""
    mask = F.lit((1 << CODE_POINT_BITS) - 1).cast("long")
    points = (F.shiftright(number, shift * CODE_POINT_BITS).bitwiseAND(mask) for shift in (2, 1, 0))
    return F.decode(F.unhex(F.concat(*[F.lpad(F.hex(point), 8, "0") for point in points])), "UTF-32")


def load_model(profiles: DataFrame, most_rows: int | None = None) -> Model:
    """A profile table ``(lang, gram, gram_count, weight)`` of any size, ready for detection.

    The table is counted first. Where it has more than ``most_rows`` rows (``MAX_MODEL_ROWS``), or its languages by
    grams more than ``MAX_MODEL_BYTES``, grams are ranked by the count of their commonest language, to an eighth
    of an octave, and the commonest that have room are fetched; the others are written for the join.
    """
    most_rows = MAX_MODEL_ROWS if most_rows is None else most_rows
    spark = profiles.sparkSession
    rows = profiles.select("lang", packed(F.col("gram")).alias("packed"), "weight", "gram_count")
    size = rows.agg(F.count("*"), F.count_distinct("packed"), F.count_distinct("lang")).first()
    n_langs = size[2]
    if size[0] <= most_rows and size[1] * n_langs * 4 <= MAX_MODEL_BYTES:
        return Model(spark.sparkContext.broadcast(_fetched(rows)))
    path = scratch_path(spark, "ranked-profile")
    rank = F.floor(F.log2(F.max("gram_count").over(Window.partitionBy("packed"))) * STEPS).cast("int")
    rows.withColumn("rank", rank).write.parquet(path)
    ranked = spark.read.parquet(path)
    sizes = ranked.groupBy("rank").agg(F.count("*").alias("n"), F.count_distinct("packed").alias("grams"))
    floor, n_rows, n_grams = None, 0, 0
    for row in sorted(sizes.collect(), reverse=True):
        n_rows, n_grams = n_rows + row["n"], n_grams + row["grams"]
        if n_rows > most_rows or n_grams * n_langs * 4 > MAX_MODEL_BYTES:
            break
        floor = row["rank"]
    in_head = F.lit(False) if floor is None else F.col("rank") >= floor
    return Model(spark.sparkContext.broadcast(_fetched(ranked.where(in_head))), ranked.where(~in_head).select("packed", "lang", "weight"))


def _detectable(text: Column, stripped: bool) -> Column:
    """The letters of a text long enough to be judged, else null."""
    long_enough = F.length(text if stripped else strip(text)) >= MIN_DETECT_LENGTH
    return F.when(long_enough, letters(text))


def detect_language(text: Column, model: Model, stripped: bool = False) -> Column:
    """Best-scoring language code; ``unknown`` for null, short or featureless text.

    ``stripped`` tells that the text has no outer white space left to be ignored. A model with a part to be joined
    has no such column: :func:`with_language` scores by it.
    """
    if model.tail is not None:
        raise ValueError("this model is larger than what is broadcast; use with_language")
    head = model.head

    @F.arrow_udf("string")
    def best_language(batch: pa.Array) -> pa.Array:
        found = [_best_languages(batch[part].to_pylist(), head.value) for part in parts(batch)]
        return pa.array(chain.from_iterable(found), pa.string())

    return F.coalesce(best_language(_detectable(text, stripped)), F.lit(UNKNOWN_LANGUAGE))


def with_language(df: DataFrame, text: str, model: Model, name: str = "language", stripped: bool = False) -> DataFrame:
    """``df`` with a column of the best-scoring language of each text, by a model of any size.

    A model that is broadcast as a whole adds a column on the row. Otherwise the rows are written with a number and
    what the broadcast part scores, the grams it does not hold are counted per row and joined with the rest of the
    profile, and the sums are joined back. Equal scores go to the smallest code in both forms.
    """
    if model.tail is None:
        return df.withColumn(name, detect_language(F.col(text), model, stripped))
    spark = df.sparkSession
    scored, grams = scratch_path(spark, "scored"), scratch_path(spark, "grams")
    head = model.head

    @F.arrow_udf("array<long>")
    def scores(batch: pa.Array) -> pa.Array:
        found = [_scores(batch[part].to_pylist(), head.value).T for part in parts(batch)]
        return pa.array(chain.from_iterable(found), pa.list_(pa.int64()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _unknown_grams(batch, head.value)

    # The number is written with its row, so that it stays the same however often a task runs.
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    numbered.withColumn("__scores", scores(_detectable(F.col(text), stripped))).write.parquet(scored)
    stored = spark.read.parquet(scored)
    texts = stored.select("__row", _detectable(F.col(text), stripped).alias("letters")).where("letters is not null")
    texts.mapInArrow(counted, "__row long, packed long, n long").write.parquet(grams)
    joined = spark.read.parquet(grams).join(model.tail, "packed")
    rest = joined.groupBy("__row", "lang").agg(F.sum(F.col("n") * F.col("weight")).alias("score"))
    codes = F.array(*[F.lit(code) for code in head.value["langs"]]).cast("array<string>")
    first = stored.select("__row", F.explode(F.arrays_zip(codes.alias("lang"), F.col("__scores").alias("score"))).alias("s"))
    both = rest.union(first.where("s.score > 0").select("__row", "s.lang", "s.score"))
    totals = both.groupBy("__row", "lang").agg(F.sum("score").alias("score")).where("score > 0")
    smallest = F.min_by("lang", F.struct(-F.col("score"), "lang"))
    found = totals.groupBy(F.col("__row").alias("__of")).agg(smallest.alias("__lang"))
    labelled = stored.join(found, F.col("__row") == F.col("__of"), "left")
    return labelled.withColumn(name, F.coalesce("__lang", F.lit(UNKNOWN_LANGUAGE))).drop("__row", "__scores", "__of", "__lang")


def _pack(text: str) -> np.ndarray:
    """One integer per three-character window."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    shift = np.uint64(CODE_POINT_BITS)
    return (((codes[:-2] << shift) | codes[1:-1]) << shift) | codes[2:]


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * np.uint64(HASH_MULTIPLIER)) >> np.uint64(64 - bits)


def _fetched(rows: DataFrame) -> dict:
    """The hash table of profile rows, which reach the driver as arrays of integers."""
    table = rows.select("lang", "packed", "weight").toArrow()
    named = table["lang"].combine_chunks().dictionary_encode()
    packed_grams = table["packed"].to_numpy().astype(np.uint64)
    return _table(named.dictionary.to_pylist(), named.indices.to_numpy(), packed_grams, table["weight"].to_numpy())


def _index(langs: list[str], grams: list[str], weights: list[int]) -> dict:
    """The hash table of listed grams."""
    names = sorted(set(langs))
    packed_grams = np.array([_pack(gram)[0] for gram in grams], dtype=np.uint64)
    return _table(names, np.array([names.index(lang) for lang in langs], dtype=np.int64), packed_grams, np.array(weights))


def _table(names: list[str], of: np.ndarray, packed_grams: np.ndarray, weights: np.ndarray) -> dict:
    """Weights per gram (rows) and language (columns), found through a table of row numbers; ``of`` numbers the
    name of the language of each weight.

    Where grams share a slot one of them holds it; the others are kept in a sorted list. The last row
    is all zero and stands for a gram in no profile.
    """
    codes = sorted(names)
    place = np.array([codes.index(name) for name in names], dtype=np.int64)
    keys, row = np.unique(packed_grams, return_inverse=True)
    by_row = np.zeros((len(keys) + 1, len(codes)), dtype=np.int32)
    if len(keys):
        by_row[row, place[of]] = weights
    bits = max(4, (SLOTS_PER_KEY * len(keys)).bit_length())
    slots = np.full(1 << bits, len(keys), dtype=np.int32)
    slots[_slot(keys, bits)] = np.arange(len(keys))
    crowded_out = np.flatnonzero(slots[_slot(keys, bits)] != np.arange(len(keys)))
    return {
        "langs": codes,
        "keys": np.append(keys, np.uint64(0)),
        "by_lang": np.ascontiguousarray(by_row.T),
        "bits": bits,
        "slots": slots,
        "crowded_out": crowded_out,
    }


def _rows(packed: np.ndarray, model: dict) -> np.ndarray:
    """Row number of each gram."""
    keys, crowded_out = model["keys"], model["crowded_out"]
    missing = len(keys) - 1
    row = model["slots"][_slot(packed, model["bits"])]
    lost = np.flatnonzero(keys[row] != packed)
    row[lost] = missing
    if len(crowded_out) and len(lost):
        place = np.searchsorted(keys[crowded_out], packed[lost])
        found = crowded_out[np.minimum(place, len(crowded_out) - 1)]
        row[lost] = np.where(keys[found] == packed[lost], found, missing)
    return row


def _pieces(texts: list[str | None], length: int) -> Iterator[tuple[int, str]]:
    """Texts cut to a length limit; consecutive pieces overlap so that no window is lost or doubled."""
    for number, text in enumerate(texts):
        for start in range(0, len(text or "") - 2, length):
            yield number, text[start : start + length + 2]


def _groups(pieces: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    group, size = [], 0
    for piece in pieces:
        group.append(piece)
        size += len(piece[1])
        if size >= CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


def windows(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The packed grams of texts, and the number of the text of each; some at a time."""
    for group in _groups(_pieces(texts, PIECE_LENGTH)):
        grams = _pack(SEPARATOR.join(piece for _, piece in group))
        ends = np.cumsum([len(piece) + len(SEPARATOR) for _, piece in group])
        of = np.searchsorted(ends, np.arange(len(grams)), side="right")
        # A window that reaches into a separator or the next piece is none.
        inside = np.arange(len(grams)) < ends[of] - len(SEPARATOR) - 2
        yield grams[inside], np.array([number for number, _ in group])[of[inside]]


def joined_windows(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The packed grams of texts, some at a time, among them windows across two pieces (:func:`in_one_piece`)."""
    for group in _groups(_pieces(texts, PIECE_LENGTH)):
        yield _pack(SEPARATOR.join(piece for _, piece in group))


def in_one_piece(grams: np.ndarray) -> np.ndarray:
    """Which packed grams hold no separator; letters hold none."""
    shift, mask = np.uint64(CODE_POINT_BITS), np.uint64((1 << CODE_POINT_BITS) - 1)
    return (grams >> (shift * np.uint64(2)) != 0) & (grams >> shift & mask != 0) & (grams & mask != 0)


def _scores(texts: list[str | None], model: dict) -> np.ndarray:
    """Sums of weights per language (rows) and text (columns)."""
    scores = np.zeros((len(model["langs"]), len(texts)), dtype=np.int64)
    for group in _groups(_pieces(texts, CHUNK)):
        numbers = [number for number, _ in group]
        rows = _rows(_pack(SEPARATOR.join(piece for _, piece in group)), model)
        starts = np.cumsum([0] + [len(piece) + len(SEPARATOR) for _, piece in group[:-1]])
        for score, weight in zip(scores, model["by_lang"]):
            np.add.at(score, numbers, np.add.reduceat(weight[rows], starts, dtype=np.int64))
    return scores


def _best_languages(texts: list[str | None], model: dict) -> list[str | None]:
    scores = _scores(texts, model)
    if not len(scores):
        return [None] * len(texts)
    best = scores.argmax(axis=0)  # the first, hence alphabetically smallest, of equals
    return [model["langs"][i] if scores[i, n] > 0 else None for n, i in enumerate(best)]


def _unknown_grams(batch: pa.RecordBatch, model: dict) -> Iterator[pa.RecordBatch]:
    """Counts per row of the grams that the broadcast part does not hold."""
    row_ids = batch.column("__row").to_numpy()
    for grams, of in windows(batch.column("letters").to_pylist()):
        unknown = _rows(grams, model) == len(model["keys"]) - 1
        if unknown.any():
            # Grams are numbered, so that a row and a gram are one integer to be sorted.
            kinds, kind = np.unique(grams[unknown], return_inverse=True)
            pairs, n = np.unique(of[unknown] * len(kinds) + kind, return_counts=True)
            row, kind = np.divmod(pairs, len(kinds))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row_ids[row]), pa.array(kinds[kind].astype(np.int64)), pa.array(n)],
                names=["__row", "packed", "n"],
            )
