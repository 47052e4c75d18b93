"""Quality rules from the fertility of a public tokenizer.

Text that a vocabulary knows is encoded in few long tokens; noise, broken encodings and unnatural strings need
many short ones and single bytes, and repetition uses few different ones. Three measures of every whole text,
characters per token, share of byte-fallback tokens and token entropy, are held against bands of its language,
or of its main script where it has no language, and of its length, as short texts vary more and their tokens
repeat less. A band reaches beyond the quartiles of all documents of that kind by a multiple of their distance.
"""

from __future__ import annotations

import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import words
from broadsheet.llm.bpe import Known
from broadsheet.llm.tables import Workspace
from broadsheet.llm.tokenizers import FOLDER, PIECE_BPE, pieces

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
SYMBOLS = "#*$%&|<>"
REPEAT = 3  # words

# The bands: so many quartile distances beyond the quartiles. A quartile distance counts as so much at least, plus
# so much of the upper quartile.
REACH = 5.0
LEAST_WIDTH = {"chars_per_token": (0.0, 0.03), "byte_share": (0.02, 0.0), "entropy": (0.03, 0.0)}
MEASURES = tuple(LEAST_WIDTH)
# Classes of length per octave of tokens.
CLASSES = 2
ACCURACY = 10_000  # of the quartiles, relative to the number of documents

WHITE = "\t\n\x0b\x0c\r"
BLANKS = {ord(c): " " for c in WHITE}
CACHED_WORDS = 300_000  # different words whose tokens a task remembers

SYMBOL_BYTE = np.zeros(256, dtype=bool)
SYMBOL_BYTE[[ord(c) for c in SYMBOLS]] = True
CONTINUATION = (np.arange(256) & 0xC0) == 0x80

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURED = "n_tokens long, chars_per_token double, byte_share double, entropy double, script string"


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside a three-word window that the text holds at least twice, every word counted once."""
    seen = words.windows(hashes, REPEAT)
    if not len(seen):
        return 0
    _, row, counts = np.unique(seen, return_inverse=True, return_counts=True)
    often = counts[row] > 1
    hit = np.zeros(len(hashes), dtype=bool)
    for place in range(REPEAT):
        hit[place : place + len(often)] |= often
    return int(hit.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            if line in seen:
                repeats += 1
            seen.add(line)
    return repeats


def main_script(text: str) -> str:
    """The script that most letters of a text belong to, by the first word of their names."""
    codes, counts = np.unique(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"), return_counts=True)
    totals: dict[str, int] = {}
    for code, count in zip(codes.tolist(), counts.tolist()):
        char = chr(code)
        if unicodedata.category(char)[0] == "L":
            script = unicodedata.name(char, "OTHER").split(" ")[0]
            totals[script] = totals.get(script, 0) + count
    return min(totals, key=lambda script: (-totals[script], script)) if totals else "NONE"


def _parts(text: str) -> Iterator[str]:
    """What stands between blanks, of which other white space is one."""
    for char in WHITE:
        text = text.replace(char, " ")
    return filter(None, text.split(" "))


class _Encoder:
    """Token numbers of texts, white space taken as single blanks.

    The vocabulary holds no piece with a blank after another character, so that the words between blanks are
    encoded independently of each other; the tokens of words met before are remembered.
    """

    def __init__(self, folder: str, name: str):
        self.model = pieces(folder, name)
        self.fallback = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known = Known({}, self.encode)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words, one after another, and how many each has."""
        ids = self.model.encode(parts, num_threads=1)
        return np.array([number for one in ids for number in one], dtype=np.int64), np.array(list(map(len, ids)))

    def tokens(self, text: str) -> np.ndarray:
        return self.tokens_of([text])[0]

    def tokens_of(self, texts: list[str]) -> list[np.ndarray]:
        """The tokens of each of some texts."""
        if self.known.size > CACHED_WORDS:
            self.known = Known({}, self.encode)
        numbers, stops = array("q"), [0]
        for text in texts:
            numbers.extend(map(self.known.__getitem__, _parts(text)))
            stops.append(len(numbers))
        ids, totals = self.known.gather(numbers)
        return np.split(ids, totals[stops[1:-1]])


def token_measures(tokens: np.ndarray, fallback: np.ndarray, n_chars: int) -> tuple:
    """Number of tokens, characters per token, share of fallback bytes, and entropy from 0 to 1."""
    n = len(tokens)
    if not n:
        return 0, None, None, None
    counts = np.unique(tokens, return_counts=True)[1] / n
    entropy = float(-(counts * np.log(counts)).sum())
    return n, n_chars / n, float(fallback[tokens].mean()), entropy / np.log(n) if n > 1 else 0.0


def _measurer(folder: str, name: str) -> Callable:
    loaded: dict = {}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "encoder" not in loaded:
            loaded["encoder"] = _Encoder(folder, name)
        encoder = loaded["encoder"]
        for batch in batches:
            rows, row = [], 0
            for _, part in words.slices(batch.column("text")):
                data, offsets = words.text_bytes(part)
                starts, stops, first = words.word_spans(data, offsets, words.NOT_WHITE)
                hashes = words.word_hashes(data, starts, stops, words.BYTE_VALUES)
                word_chars = np.concatenate([[0], np.cumsum(words.NOT_WHITE[data] & ~CONTINUATION[data])])
                symbols = np.concatenate([[0], np.cumsum(SYMBOL_BYTE[data])])
                texts = [text or "" for text in part.to_pylist()]
                # The script is asked for only where there is no language.
                spoken = batch.column("lang").slice(row, len(part)).is_valid().to_pylist()
                row += len(part)
                for i, (text, tokens) in enumerate(zip(texts, encoder.tokens_of(texts))):
                    a, b = offsets[i], offsets[i + 1]
                    rows.append(
                        (
                            int(first[i + 1] - first[i]),
                            int(word_chars[b] - word_chars[a]),
                            int(symbols[b] - symbols[a]),
                            duplicate_lines(text),
                            repeated_words(hashes[first[i] : first[i + 1]]),
                            *token_measures(tokens, encoder.fallback, len(text)),
                            None if spoken[i] else main_script(text),
                        )
                    )
            columns = list(zip(*rows)) if rows else [()] * 10
            kinds = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string()]
            arrays = [pa.array(list(v), kind) for v, kind in zip(columns, kinds)]
            names = [part.split(" ")[0] for part in f"{BASE}, {MEASURED}".split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), *arrays], names=["doc_id", "lang", *names]
            )

    return measure


def measures(docs: DataFrame, folder: str = FOLDER, name: str = PIECE_BPE) -> DataFrame:
    """Counts of the base rules and the three measures of every whole text, in one pass."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), lang.alias("lang"), F.col("text").cast("string"))
    return rows.mapInArrow(_measurer(folder, name), f"doc_id long, lang string, {BASE}, {MEASURED}")


def _group() -> Column:
    return F.coalesce(F.col("lang"), F.concat(F.lit("script "), F.col("script")))


def _class() -> Column:
    """The class of length, null without tokens."""
    return F.floor(F.log2(F.nullif(F.col("n_tokens"), F.lit(0))) * CLASSES).cast("int")


def bands(measured: DataFrame) -> DataFrame:
    """``(group, class, n_docs, <measure>_low, <measure>_high)``: what the given documents of a group and of about a
    length allow, from their quartiles. The few documents of a thin class allow themselves."""
    quartiles = [F.percentile_approx(m, [0.25, 0.75], ACCURACY).alias(m) for m in MEASURES]
    kinds = measured.groupBy(_group().alias("group"), _class().alias("class"))
    grouped = kinds.agg(F.count("*").alias("n_docs"), *quartiles)
    columns = []
    for m in MEASURES:
        low, high = F.col(m)[0], F.col(m)[1]
        least, share = LEAST_WIDTH[m]
        reach = F.greatest(high - low, F.lit(least) + high * F.lit(share)) * REACH
        columns += [(low - reach).alias(f"{m}_low"), (high + reach).alias(f"{m}_high")]
    return grouped.select("group", "class", "n_docs", *columns)


def judge(docs: DataFrame, folder: str = FOLDER, name: str = PIECE_BPE, label: str = "fertility") -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ...)`` of
    every document, with its measures.

    Null, empty and blank texts have no words and fail the base rules. Documents without a language are judged
    by their main script. Repeated rows are judged alike; a null doc_id is a value like others; other columns
    are ignored.
    """
    work = Workspace(docs.sparkSession, label)
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    measured = measures(docs, folder, name)
    measured = work.keep(measured.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeats))
    # A row per language or script and class of length.
    allowed = work.small(work.keep(bands(measured.where("not base_failed")).drop("n_docs")))
    judged = measured.withColumns({"group": _group(), "class": _class()}).join(allowed, ["group", "class"], "left")
    inside = ~F.col("base_failed")
    for m in MEASURES:
        within = F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high"))
        inside = inside & F.coalesce(within, F.lit(False))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        inside.alias("kept"),
        "n_tokens",
        *MEASURES,
        F.col("group").alias("band"),
    )
