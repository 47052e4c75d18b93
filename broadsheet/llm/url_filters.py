"""URL filters by a path-template tree.

Every URL becomes a host and path segments. Segments that carry a number, a hash or a date are masked by their
form. Per host, the masked paths make a tree, built level by level: where a node has too many different children
for the number of its URLs, they become one wildcard; children whose labelled shares differ no more than chance
allows are merged. What is left are the host's templates. A template's share of bad labels is smoothed
with the share of its host, and that with the share of all; templates above a limit are rejected.

Rules of host and path override the templates. Everything is a DataFrame expression: URLs are aggregated to
masked paths first, and only these are joined with the tree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.tables import Workspace

# A node with more different children than this share of its URLs, and with more than the least number, is a
# wildcard.
WILD_SHARE, WILD_LEAST = 0.3, 8
# Children merge when their bad share is within this many standard errors of the node's.
MERGE_ERRORS = 2.0
# Smoothing: labels that the host's share counts for in a template, and the total share in a host.
TEMPLATE_PRIOR, HOST_PRIOR = 20.0, 50.0
REJECT_ABOVE = 0.5

WILD, MERGED = "*", "+"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path`` (which begins with a slash)."""

    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to a question mark, hash or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Index of the longest rule that fits, the first of equals; null if none does."""
    found = F.lit(None).cast("int")
    ordered = sorted(range(len(rules)), key=lambda i: (len(rules[i].name), -i))
    for i in ordered:  # the longest last, hence outermost
        rule = rules[i]
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(i)).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """The masked segments of a path: numbers, hashes and dates by form, extensions kept."""
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")

    def masked(segment: Column) -> Column:
        stem = F.regexp_replace(segment, r"(\.[A-Za-z]{1,5})$", "")
        extension = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
        form = (
            F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "{date}")
            .when(stem.rlike(r"^[0-9]+$"), "{number}")
            .when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "{hash}")
            .when(stem.rlike(r"[0-9]{3,}"), F.regexp_replace(stem, r"[0-9]{3,}", "{number}"))
            .otherwise(stem)
        )
        return F.concat(form, extension)

    return F.transform(parts, masked)


def _node(level: int) -> Column:
    """The template of a path above a level, as text."""
    return F.array_join(F.slice("template", 1, level), "/")


def templates(paths: DataFrame, work: Workspace) -> DataFrame:
    """``(host, segments, template, n, n_labelled, n_bad)`` from masked paths with their counts.

    Goes down the tree one level at a time, until no path has a further segment; each level is two aggregations
    and one join of masked paths. Paths that end, or that are alone below their node, are left as they are.
    """
    tree = paths.withColumn("template", F.col("segments")).withColumn("__alone", F.lit(False))
    settled, level = [], 0
    while True:
        inside = (F.size("template") > level) & ~F.col("__alone")
        settled.append(tree.where(~inside).drop("__alone"))
        tree = tree.where(inside).drop("__alone")
        if tree.isEmpty():
            return reduce(DataFrame.union, settled)
        here = F.get("template", F.lit(level))
        child = tree.groupBy("host", _node(level).alias("node"), here.alias("segment")).agg(
            F.sum("n").alias("n"),
            F.sum("n_labelled").alias("n_labelled"),
            F.sum("n_bad").alias("n_bad"),
            F.count("*").alias("paths"),
        )
        node = child.groupBy("host", "node").agg(
            F.count("*").alias("children"),
            F.sum("n").alias("all_n"),
            F.sum("paths").alias("all_paths"),
            F.sum("n_labelled").alias("all_labelled"),
            F.sum("n_bad").alias("all_bad"),
        )
        wild = (F.col("children") > WILD_LEAST) & (F.col("children") > F.col("all_n") * WILD_SHARE)
        share = F.col("all_bad") / F.nullif(F.col("all_labelled"), F.lit(0))
        error = F.sqrt(share * (1 - share) / F.nullif(F.col("n_labelled"), F.lit(0)))
        # Few labels, or a share like the node's: the branch is told apart by nothing.
        alike = F.abs(F.col("n_bad") / F.nullif(F.col("n_labelled"), F.lit(0)) - share) <= error * MERGE_ERRORS
        alike = (F.col("children") > 1) & F.coalesce(alike, F.lit(True))
        step = F.when(wild, WILD).when(alike, MERGED).otherwise(F.col("segment"))
        steps = child.join(node, ["host", "node"]).select(
            F.col("host").alias("__host"),
            F.col("node").alias("__node"),
            F.col("segment").alias("__segment"),
            step.alias("__step"),
            (F.col("all_paths") == 1).alias("__alone"),
        )
        at = (F.col("host") == F.col("__host")) & (_node(level) == F.col("__node")) & (here == F.col("__segment"))
        tree = tree.join(steps, at)
        changed = F.concat(
            F.slice("template", 1, level),
            F.array("__step"),
            F.slice("template", F.lit(level + 2), F.size("template")),
        )
        tree = work.keep(tree.withColumn("template", changed).drop("__host", "__node", "__segment", "__step"))
        level += 1


def purity(tree: DataFrame) -> DataFrame:
    """``(host, template, bad_share)``: smoothed share of bad labels of each template."""
    counts = [F.sum("n_labelled").alias("labelled"), F.sum("n_bad").alias("bad")]
    own = tree.groupBy("host", "template").agg(*counts)
    hosts = tree.groupBy("host").agg(F.sum("n_labelled").alias("host_labelled"), F.sum("n_bad").alias("host_bad"))
    total = tree.agg(F.sum("n_labelled").alias("labelled"), F.sum("n_bad").alias("bad")).first()
    overall = F.lit(total["bad"] / total["labelled"] if total["labelled"] else 0.0)
    of_host = (F.col("host_bad") + overall * HOST_PRIOR) / (F.col("host_labelled") + HOST_PRIOR)
    hosts = hosts.select("host", of_host.alias("host_share"))
    smoothed = (F.col("bad") + F.col("host_share") * TEMPLATE_PRIOR) / (F.col("labelled") + TEMPLATE_PRIOR)
    return own.join(hosts, "host").select("host", "template", smoothed.alias("bad_share"))


def judge(urls: DataFrame, rules: Sequence[Rule], label: str = "url-filters") -> DataFrame:
    """All columns of ``urls`` ``(url, bad, ...)`` with ``host, path, rule, template, bad_share, verdict``.

    ``bad`` labels an URL 1 or 0; null is no label. A null URL and one without ``://`` have an empty host and
    path, and are judged as the templates of the empty host. Repeated rows count as often as they occur. Other
    columns pass through; added ones take a ``_`` more where their names are in use.
    """
    work = Workspace(urls.sparkSession, label)
    url = F.col("url").cast("string")
    names = {n: n for n in ("host", "path", "rule", "template", "bad_share", "verdict")}
    for name in names:
        while names[name] in urls.columns:
            names[name] += "_"
    given = urls.columns
    parsed = urls.select(
        F.struct(*given).alias("given"), host(url).alias("host"), path(url).alias("path"), F.col("bad").alias("bad")
    ).withColumn("segments", segments(F.col("path")))
    paths = parsed.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count("bad").alias("n_labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad")
    )
    tree = templates(work.keep(paths), work)
    judged = tree.join(purity(tree), ["host", "template"]).select("host", "segments", "template", "bad_share")
    rows = parsed.join(work.keep(judged), ["host", "segments"])
    index = matching_rule(F.col("host"), F.col("path"), rules)
    by_rule = F.get(F.array(*[F.lit("block" if r.block else "allow") for r in rules]), index) if rules else None
    by_tree = F.when(F.col("bad_share") > REJECT_ABOVE, "block").otherwise("allow")
    rule = F.get(F.array(*[F.lit(r.name) for r in rules]), index) if rules else F.lit(None).cast("string")
    return rows.select(
        *[F.col(f"given.`{c}`").alias(c) for c in given],
        F.col("host").alias(names["host"]),
        F.col("path").alias(names["path"]),
        rule.alias(names["rule"]),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias(names["template"]),
        F.col("bad_share").alias(names["bad_share"]),
        (F.coalesce(by_rule, by_tree) if rules else by_tree).alias(names["verdict"]),
    )
