"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target in words. It first gives as many complete epochs as the target holds; the rest of the
target is filled with a weighted sample of its documents without replacement: each document draws an exponential
key with its quality weight as rate, and documents are taken in the order of their keys until the budget is
used up. The document at the edge is taken in part, as many words as the budget still holds.

The draw is a hash of the document, so reruns agree, whatever the partitions.

No source is sorted in one task: its documents are cut into ranges of the logarithm of their keys, sqrt(n) an octave
for n documents, whose totals are summed first; a running sum then needs the documents of one range only. A weight
shifts that logarithm, so whatever the weights a range is expected to hold a quarter of sqrt(n) documents at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.tables import Workspace

# A word of the size rule, the weights in order of sources, and the most epochs of a source.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3

SEED = 17
LEAST_QUALITY = 0.05


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Weight of a document in the draw: the share of letters among its characters, at least 0.05."""
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    return F.greatest(F.coalesce(letters / F.nullif(F.length(text), F.lit(0)), F.lit(0.0)), F.lit(LEAST_QUALITY))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``: the place of a row in the order of ``source``, null last, from 0.

    Sorted in ranges; only the row counts of the ranges meet in one task.
    """
    spread = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last()
    )
    placed = spread.withColumn("place", F.monotonically_increasing_id())
    placed = placed.withColumn("part", F.shiftright("place", 33)).withColumn(
        "place", F.col("place").bitwiseAND((1 << 33) - 1)
    )
    return placed


def targets(sources: DataFrame, work: Workspace, weights: tuple = WEIGHTS, epochs: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size, ...)``.

    Sources share the sum of all sizes by weight. One whose share exceeds ``epochs`` times its size is held
    there, and the excess is shared by the others, again by weight, until none is above.
    """
    placed = work.keep(numbered(sources))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = placed.join(offsets, "part").withColumn("rank", F.col("offset") + F.col("place"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    state = ranked.withColumn("weight", F.get(listed, (F.col("rank") % len(weights)).cast("int")))
    state = work.keep(state.withColumn("most", F.col("source_size") * epochs).withColumn("held", F.lit(False)))
    while True:
        total = state.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(F.col("held"), F.col("most"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~F.col("held"), F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        rate = ((total["all"] or 0) - total["held"]) / total["weight"] if total["weight"] else 0.0
        share = F.col("weight") * F.lit(rate)
        above = state.where(~F.col("held") & (share > F.col("most")))
        if above.isEmpty():
            break
        state = work.keep(state.withColumn("held", F.col("held") | (share > F.col("most"))))
    target = F.when(F.col("held"), F.col("most").cast("double")).otherwise(share)
    return state.withColumn("target", target).drop("place", "part", "offset", "rank", "weight", "most", "held")


def mix(
    docs: DataFrame,
    weight: Column | None = None,
    weights: tuple = WEIGHTS,
    epochs: int = MOST_EPOCHS,
    seed: int = SEED,
    label: str = "mixing",
) -> DataFrame:
    """``(doc_id, source, text_id, size, source_size, target, taken)`` for every row of ``docs``.

    ``weight`` rates a document (a positive column of ``docs``; by default :func:`quality` of its text).
    A document of size 0 (null, empty or blank text) takes nothing. Rows that are equal draw equal keys; at
    the edge of the budget they are taken one after another. A null source is a source, the last one; a null
    doc_id is a value like others. A source without words has the target 0. Other columns are ignored.
    """
    work = Workspace(docs.sparkSession, label)
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("long")
    key_hash = F.xxhash64(F.lit(seed), doc_id, F.xxhash64(text))
    # Uniform in (0, 1): the upper 52 bits of the hash, and half a step.
    uniform = (F.shiftrightunsigned(key_hash, 12).cast("double") + 0.5) / float(1 << 52)
    sized = docs.select(
        doc_id.alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("text_id"),
        n_words(text).alias("size"),
        (-F.log(uniform) / (quality(text) if weight is None else weight)).alias("key"),
    )
    sized = work.keep(sized)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    shares = targets(sources, work, weights, epochs)
    whole = F.least(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(epochs))
    shares = shares.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long"))
    budget = F.floor(F.col("target")).cast("long") - F.col("whole") * F.col("source_size")
    shares = shares.withColumn("budget", F.greatest(budget, F.lit(0)))
    shares = work.keep(shares.withColumn("ranges", F.ceil(F.sqrt("n")).cast("long")))
    same = sized["source"].eqNullSafe(shares["source"])
    drawn = sized.join(shares, same).drop(shares["source"])
    drawn = work.keep(drawn.withColumn("range", F.floor(F.log2("key") * F.col("ranges")).cast("long")))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = drawn.groupBy("source", "range").agg(F.sum("size").alias("total"))
    totals = totals.withColumn("earlier", F.coalesce(F.sum("total").over(before), F.lit(0)))
    totals = totals.select(F.col("source").alias("__source"), F.col("range").alias("__range"), "earlier")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "text_id")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    summed = drawn.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at = F.col("source").eqNullSafe(F.col("__source")) & (F.col("range") == F.col("__range"))
    summed = summed.join(totals, at)
    left = F.col("budget") - F.col("earlier") - F.col("within")
    part = F.greatest(F.least(F.col("size"), left), F.lit(0))
    taken = (F.col("whole") * F.col("size") + part).cast("long")
    return summed.select("doc_id", "source", "text_id", "size", "source_size", "target", taken.alias("taken"))


def beginning(text: Column, n: Column) -> Column:
    """``text`` up to the end of its word number ``n``."""
    parts = F.regexp_extract_all(text, F.lit(rf"{BLANKS}*+{WORD}+"), F.lit(0))
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")


def sample(docs: DataFrame, label: str = "mixing", **options) -> DataFrame:
    """The documents the mix takes, with the columns they have, the text repeated as often as it is taken.

    ``epochs_taken`` and ``words_taken`` tell how much of a document the mix takes: complete passes first,
    the remainder is the beginning of the text, cut after a word. The text holds them all, a line feed between,
    and ``n_chars``, if there is such a column, is its length. Documents it takes nothing of go. Equal rows
    are taken together: they share the epochs, and each takes the mean of their words. The two counters take a
    ``_`` more where their names are in use.
    """
    taken = _taken(docs, label, **options)
    text = F.col("text").cast("string")
    epochs, rest = _passes()
    last = F.when(rest > 0, F.array(beginning(text, rest))).otherwise(F.array().cast("array<string>"))
    passes = F.array_join(F.concat(F.array_repeat(text, epochs.cast("int")), last), "\n")
    changed = F.col("__taken") != F.col("__size")
    taken = taken.withColumn("__mixed", F.when(changed, passes).otherwise(text))
    names = _free_names(docs, "epochs_taken", "words_taken")
    return taken.select(*_with_text(docs, changed), epochs.alias(names[0]), F.col("__taken").alias(names[1]))


def epochs(docs: DataFrame, label: str = "mixing", **options) -> DataFrame:
    """A row for each pass of the mix over a document, with the columns it has, and ``epoch``, from 1.

    Complete passes come first and hold the text as it is; the last holds its beginning, cut after a word, if the mix
    takes only so much. ``n_chars``, if there is such a column, is then the length of what is left. Documents it takes
    nothing of go. Equal rows are taken together, as :func:`sample` says. ``epoch`` takes a ``_`` more where its
    name is in use.
    """
    whole, rest = _passes()
    passes = F.sequence(F.lit(1), (whole + (rest > 0).cast("long")).cast("int"))
    taken = _taken(docs, label, **options).withColumns({"__whole": whole, "__rest": rest, "__passes": passes})
    taken = taken.withColumn("__epoch", F.explode("__passes"))
    cut = F.col("__epoch") > F.col("__whole")
    text = F.col("text").cast("string")
    taken = taken.withColumn("__mixed", F.when(cut, beginning(text, F.col("__rest"))).otherwise(text))
    (name,) = _free_names(docs, "epoch")
    return taken.select(*_with_text(docs, cut), F.col("__epoch").alias(name))


def _free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, with a ``_`` more as long as any of them is in use; case does not tell names apart."""
    used = {name.lower() for name in docs.columns}
    found = list(names)
    while used & set(found):
        found = [f"{name}_" for name in found]
    return found


def _passes() -> tuple[Column, Column]:
    """How often a document is taken whole, and how many words of it then."""
    whole = F.floor(F.col("__taken") / F.col("__size"))
    return whole, F.col("__taken") - whole * F.col("__size")


def _with_text(docs: DataFrame, changed: Column) -> list[Column]:
    """The columns of ``docs`` with the text ``__mixed``, and its length where it is ``changed``."""
    shown = {"text": F.col("__mixed")}
    if "n_chars" in docs.columns:
        length = F.length("__mixed").cast(docs.schema["n_chars"].dataType)
        shown["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    return [shown.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]


def _taken(docs: DataFrame, label: str, **options) -> DataFrame:
    """The documents the mix takes words of, with their size and these words as ``__size`` and ``__taken``."""
    plan = mix(docs, label=label, **options)
    plan = plan.groupBy("doc_id", "source", "text_id", "size").agg(F.floor(F.avg("taken")).alias("taken"))
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    text = F.col("text").cast("string")
    same = (
        docs["doc_id"].cast("long").eqNullSafe(F.col("__doc_id"))
        & docs["source"].cast("string").eqNullSafe(F.col("__source"))
        & (F.xxhash64(text) == F.col("__text_id"))
    )
    return docs.join(plan.where("__taken > 0"), same)
