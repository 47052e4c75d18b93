"""Language identification with interpolated Kneser-Ney character models.

Training counts character windows of a bounded, documented sample of labelled documents in one distributed
aggregation. From the counts each language gets an interpolated Kneser-Ney model up to ``ORDER`` characters.
All languages share sorted hash arrays: a window's hash leads to a row with its log-probability in every
language, a context's hash to its back-off weights. A text goes to the language of the lowest cross-entropy per
character; it is rejected where that cross-entropy is beyond what held-back labelled documents of the language show.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.tables import Workspace
from broadsheet.llm.words import mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 5
BITS = 12  # of a character's number in a packed window
ALPHABET = (1 << BITS) - 3  # characters that have a number of their own, the most frequent of the sample
BLANK, OTHER, FIRST = 1, 2, 3  # numbers of a run of non-letters, of rare letters, and of the first character

# The models are fitted on a sample: an expected number of documents per language for the counts, and as many
# others for the calibration. This bounds the model, whatever the size of the corpus.
FIT_DOCS = 2000
CALIBRATION_DOCS = 500
FIT_SALT = 1
# (window, language) counts of a sample, and cells of a table of different windows by languages. A sample beyond is
# drawn again with fewer documents of every language, one at least.
MAX_WINDOWS = 4_000_000
MAX_CELLS = 1 << 27

# A text is rejected when its cross-entropy exceeds the language's mean by REJECT_SLACK times the largest excess
# that the calibration documents show; excesses are scaled by the square root of the length, up to FULL_LENGTH.
REJECT_SLACK = 1.5
LEAST_EXCESS = 2.0  # nats times root of length; stands in where few documents calibrate a language
FULL_LENGTH = 400

CHUNK = 1 << 17  # characters scored at a time, which bounds the memory of a task
UNDETERMINED = "und"


def character_numbers(alphabet: list[str]) -> np.ndarray:
    """Number of every code point: letters are folded to lower case, all else is a blank."""
    number = {char: i + FIRST for i, char in enumerate(alphabet)}
    table = np.full(sys.maxunicode + 1, BLANK, dtype=np.uint16)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char)[0] == "L":
            table[code] = number.get(char.lower()[0], OTHER)
    return table


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.array([unicodedata.category(chr(code))[0] == "L" for code in range(sys.maxunicode + 1)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def numbers(text: str, table: np.ndarray) -> np.ndarray:
    """A text as character numbers, runs of non-letters as one blank, a blank before and after."""
    coded = np.concatenate([[BLANK], table[code_points(text)], [BLANK]]).astype(np.uint64)
    keep = np.ones(len(coded), dtype=bool)
    keep[1:] = (coded[1:] != BLANK) | (coded[:-1] != BLANK)
    return coded[keep]


def packed(coded: np.ndarray, order: int) -> np.ndarray:
    """The window of ``order`` characters that ends at each character but the first; short ones begin with 0."""
    out = np.zeros(len(coded) - 1, dtype=np.uint64)
    for back in range(min(order, len(coded))):
        part = coded[max(0, 1 - back) : len(coded) - back] << np.uint64(BITS * back)
        out[len(out) - len(part) :] |= part
    return out


def _count_characters(texts: pa.Array) -> pa.Array:
    from collections import Counter

    rows = []
    for text in texts.to_pylist():
        counts = Counter((text or "").lower())
        rows.append([{"char": c, "n": n} for c, n in counts.items() if unicodedata.category(c)[0] == "L"])
    return pa.array(rows, pa.list_(pa.struct([("char", pa.string()), ("n", pa.int64())])))


def _window_counter(shared: Broadcast) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(packed(numbers(text, table), ORDER))
            for lang, parts in by_lang.items():
                windows, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(windows)), pa.array(windows.view(np.int64)), pa.array(counts)],
                    names=["lang", "window", "n"],
                )

    return count


def _draw(salt: int) -> Column:
    """Uniform in [0, 1) by the text."""
    return F.pmod(F.xxhash64(F.lit(salt), "text"), F.lit(1 << 30)) / float(1 << 30)


def labels(labelled: DataFrame, work: Workspace) -> DataFrame:
    """``(lang, n_fit, least, n_held)`` of every language of ``labelled`` ``(lang, text, calibrating)``: documents to
    fit and to calibrate, and the least draw of the former. Where all calibrate, all are there to fit, too."""
    fits = ~F.col("calibrating")
    counted = labelled.withColumn("draw", _draw(FIT_SALT)).groupBy("lang").agg(
        F.count_if(fits).alias("n_fit"),
        F.min(F.when(fits, F.col("draw"))).alias("least"),
        F.min("draw").alias("least_of_all"),
        F.count_if("calibrating").alias("n_held"),
    )
    none = F.col("n_fit") == 0
    return work.small(
        work.keep(
            counted.select(
                "lang",
                F.when(none, F.col("n_held")).otherwise(F.col("n_fit")).alias("n_fit"),
                F.when(none, F.col("least_of_all")).otherwise(F.col("least")).alias("least"),
                "n_held",
                none.alias("all_held"),
            )
        )
    )


def fitting_sample(labelled: DataFrame, known: DataFrame, docs: float) -> DataFrame:
    """About ``docs`` documents of every language, chosen by a hash of the text, the one of least hash always."""
    draw = _draw(FIT_SALT)
    chosen = labelled.join(known, "lang").where(~F.col("calibrating") | F.col("all_held"))
    return chosen.where((draw < docs / F.col("n_fit")) | (draw == F.col("least"))).select("lang", "text")


def _counted_windows(sample: DataFrame, work: Workspace) -> tuple[DataFrame, Broadcast, float]:
    """``(lang, window, n)`` of a sample, written; the numbers of its characters; and how many times too many the
    windows are."""
    sample = work.keep(sample)
    sample_characters = F.arrow_udf("array<struct<char:string,n:long>>")(_count_characters)("text")
    characters = sample.select(F.inline(sample_characters))
    frequent = characters.groupBy("char").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "char").limit(ALPHABET)
    table = work.spark.sparkContext.broadcast(character_numbers([row["char"] for row in frequent.collect()]))
    counted = sample.select("lang", "text").mapInArrow(_window_counter(table), "lang string, window long, n long")
    counted = work.keep(counted.groupBy("lang", "window").agg(F.sum("n").alias("n")))
    n = counted.count()
    excess = n / MAX_WINDOWS
    langs = counted.select("lang").distinct().count()
    if n * langs > MAX_CELLS:  # else no need to tell different windows
        excess = max(excess, counted.select("window").distinct().count() * langs / MAX_CELLS)
    return counted, table, excess


class Model:
    """Log-probabilities and back-off weights by packed window, one column per language."""

    def __init__(self, langs: list[str], lang: np.ndarray, window: np.ndarray, n: np.ndarray):
        self.langs = langs
        counts = {ORDER: _matrix(window, lang, n, len(langs))}
        # The count of a shorter window is the number of different characters seen before it.
        for order in range(ORDER - 1, 0, -1):
            keys, table = counts[order + 1]
            suffix = keys & np.uint64((1 << BITS * order) - 1)
            counts[order] = _summed(suffix, (table > 0).astype(np.int64))
        self.levels: list[tuple] = []
        floor = np.full(len(langs), 1.0 / (1 << BITS))
        for order in range(1, ORDER + 1):
            keys, table = counts[order]
            once, twice = (table == 1).sum(axis=0), (table == 2).sum(axis=0)
            discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5).clip(0.1, 0.9)
            contexts, total = _summed(keys >> np.uint64(BITS), table)
            _, kinds = _summed(keys >> np.uint64(BITS), (table > 0).astype(np.int64))
            safe = np.maximum(total, 1)
            backoff = np.where(total > 0, discount * kinds / safe, 1.0)
            row = np.searchsorted(contexts, keys >> np.uint64(BITS))
            lower = floor if order == 1 else np.exp(self._look_up(keys & np.uint64((1 << BITS * (order - 1)) - 1)))
            probability = np.maximum(table - discount, 0) / safe[row] + backoff[row] * lower
            self.levels.append((*_hashed(keys, np.log(probability)), *_hashed(contexts, np.log(backoff))))
            self.floor = np.log(floor)

    def tables(self) -> dict:
        return {"langs": self.langs, "levels": self.levels, "floor": self.floor}

    def _look_up(self, windows: np.ndarray) -> np.ndarray:
        return log_probabilities(windows, self.levels, self.floor, len(self.levels))


def _matrix(window: np.ndarray, lang: np.ndarray, n: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray]:
    keys, row = np.unique(window, return_inverse=True)
    table = np.zeros((len(keys), langs), dtype=np.int64)
    table[row, lang] = n
    return keys, table


def _summed(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of equal keys."""
    order = np.argsort(keys, kind="stable")
    unique, first = np.unique(keys[order], return_index=True)
    return unique, np.add.reduceat(table[order], first, axis=0) if len(unique) else table


def _hashed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their keys' hashes."""
    hashes = mix(keys)
    order = np.argsort(hashes)
    return hashes[order], np.ascontiguousarray(rows[order], dtype=np.float32)


def _find(sorted_hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = mix(keys)
    row = np.searchsorted(sorted_hashes, hashes)
    row[row == len(sorted_hashes)] = 0
    return row, sorted_hashes[row] == hashes


def log_probabilities(windows: np.ndarray, levels: list, floor: np.ndarray, order: int) -> np.ndarray:
    """Log-probability of each window's last character after the others, per language."""
    out = np.zeros((len(windows), len(floor)), dtype=np.float64)
    open_rows = np.arange(len(windows))
    while order and len(open_rows):
        hashes, rows, contexts, weights = levels[order - 1]
        here = windows[open_rows] & np.uint64((1 << BITS * order) - 1)
        row, found = _find(hashes, here)
        out[open_rows[found]] += rows[row[found]]
        open_rows, here = open_rows[~found], here[~found]
        row, found = _find(contexts, here >> np.uint64(BITS))
        out[open_rows[found]] += weights[row[found]]
        order -= 1
    out[open_rows] += floor
    return out


def entropies(texts: list[str | None], table: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character of each text in each language, and the number of characters."""
    sums = np.zeros((len(texts), len(model["langs"])))
    sizes = np.zeros(len(texts), dtype=np.int64)
    for row, text in enumerate(texts):
        if not text:
            continue
        coded = numbers(text, table)
        sizes[row] = len(coded) - 1
        for low in range(0, len(coded) - 1, CHUNK):
            # The characters before a chunk are the contexts of its first ones.
            begin = max(0, low - ORDER + 1)
            windows = packed(coded[begin : low + CHUNK + 1], ORDER)[low - begin :]
            sums[row] -= log_probabilities(windows, model["levels"], model["floor"], ORDER).sum(axis=0)
    return sums / np.maximum(sizes, 1)[:, None], sizes


def fit(labelled: DataFrame) -> Broadcast | None:
    """A model from ``(text, lang)``; null languages and texts teach nothing. None if nothing is left.

    Fitted on about ``FIT_DOCS`` documents per language, fewer where their windows are too many, and calibrated on
    about ``CALIBRATION_DOCS`` others. Every language is learnt.
    """
    spark = labelled.sparkSession
    labelled = labelled.where("text is not null and lang is not null").select("text", "lang")
    calibrating = F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(5)) == 0
    labelled = labelled.withColumn("calibrating", calibrating)
    work = Workspace(spark, "language")
    known = labels(labelled, work)
    docs = float(FIT_DOCS)
    while True:
        counted, table, excess = _counted_windows(fitting_sample(labelled, known, docs), work)
        if excess <= 1 or docs <= 1:
            break
        docs = max(1.0, docs / excess * 0.9)
    arrow = counted.toArrow()
    if not arrow.num_rows:
        return None
    names = arrow["lang"].to_pylist()
    langs = sorted(set(names))
    column = {lang: i for i, lang in enumerate(langs)}
    windows = arrow["window"].to_numpy().view(np.uint64)
    model = Model(langs, np.array([column[x] for x in names]), windows, arrow["n"].to_numpy()).tables()
    model["table"], model["letters"] = table.value, letter_table()
    raw = spark.sparkContext.broadcast(model)
    # Calibration: mean cross-entropy per language, and the largest excess over it by length.
    held = labelled.where("calibrating").join(known, "lang")
    # Both are written: a condition on the prediction would else be moved before the draw, and score all documents.
    held = work.keep(held.where(_draw(2) < CALIBRATION_DOCS / F.col("n_held")).select("lang", "text"))
    scored = work.keep(held.select("lang", _scorer(raw)("text").alias("s")).select("lang", "s.*"))
    scored = scored.where("lang = lang_pred and n_letters > 0")
    scale = F.sqrt(F.least("n_symbols", F.lit(FULL_LENGTH)).cast("double"))
    mean = scored.groupBy("lang").agg((F.sum(F.col("entropy") * scale) / F.sum(scale)).alias("mean"))
    excess = (F.col("entropy") - F.col("mean")) * scale
    limits = scored.join(F.broadcast(mean), "lang").groupBy("lang").agg(
        F.first("mean").alias("mean"), F.max(excess).alias("excess")
    )
    limit = {row["lang"]: (row["mean"], row["excess"]) for row in limits.collect()}
    model["limits"] = {lang: limit.get(lang) for lang in langs}
    raw.unpersist()
    return spark.sparkContext.broadcast(model)


RESULT = {
    "lang_pred": pa.string(),
    "score": pa.float64(),
    "entropy": pa.float64(),
    "n_symbols": pa.int64(),
    "n_letters": pa.int64(),
    "rejected": pa.bool_(),
}
RESULT_TYPE = "struct<lang_pred:string,score:double,entropy:double,n_symbols:long,n_letters:long,rejected:boolean>"


def _scorer(shared: Broadcast) -> Callable:
    @F.arrow_udf(RESULT_TYPE)
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        limits = model.get("limits", {})
        rows = []
        for text in texts:
            text = text.as_py()
            letters = int(model["letters"][code_points(text)].sum()) if text else 0
            if not letters:
                rows.append((UNDETERMINED, 0.0, None, 0, 0, True))
                continue
            entropy, size = entropies([text], model["table"], model)
            entropy, size = entropy[0], int(size[0])
            best = int(entropy.argmin())  # the first, hence alphabetically smallest, of equals
            lang = model["langs"][best]
            # Share of the best language if each is weighed by its perplexity over a few characters.
            score = 1.0 / float(np.exp(-8.0 * (entropy - entropy[best])).sum())
            limit = limits.get(lang)
            scale = min(size, FULL_LENGTH) ** 0.5
            rejected = limit is not None and (entropy[best] - limit[0]) * scale > REJECT_SLACK * max(limit[1], LEAST_EXCESS)
            rows.append((lang, score, float(entropy[best]), size, letters, rejected))
        columns = list(zip(*rows)) if rows else [()] * len(RESULT)
        return pa.StructArray.from_arrays(
            [pa.array(list(v), kind) for v, kind in zip(columns, RESULT.values())], list(RESULT)
        )

    return score


def identify(text: Column, model: Broadcast | None) -> Column:
    """Struct of the predicted language, a score from 0 to 1, the cross-entropy and whether it is rejected.

    Null texts and texts without a letter are ``und`` and rejected; so is every text where there is no model.
    """
    if model is None:
        return _nothing()
    return _scorer(model)(text.cast("string"))


def _nothing() -> Column:
    empty = {"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0), "rejected": F.lit(True)}
    kinds = dict(part.split(":") for part in RESULT_TYPE[len("struct<") : -1].split(","))
    return F.struct(*[empty.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()])


def fold(doc_id: Column) -> Column:
    """Remainder by 4 of the CRC-32 of the id as text; null for null."""
    return F.crc32(doc_id.cast("string")) % 4


def predict(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` of every document.

    Learns from the documents whose id has another fold than 2 and that have a language and a text. A null
    doc_id is not held out and teaches nothing. Equal texts get equal results.
    """
    doc_id = F.col("doc_id").cast("long")
    model = fit(docs.where(fold(doc_id) != 2).select(F.col("text").cast("string"), F.col("lang").cast("string")))
    found = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(fold(doc_id) == 2, F.lit(False)).alias("held_out"),
        identify(F.col("text"), model).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents, with the columns they have, whose language is recognised."""
    name = "found"
    while name in docs.columns:
        name += "_"
    labelled = docs.where(fold(F.col("doc_id").cast("long")) != 2)
    model = fit(labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")))
    judged = docs.withColumn(name, identify(F.col("text"), model))
    return judged.where(~F.col(f"{name}.rejected")).select(*docs.columns)
