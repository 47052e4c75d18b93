"""Pages to items to bronze articles, driven by one rule per site."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.html import AROUND, INSIDE, INSIDE_ELSE_AROUND, page_items
from broadsheet.schema import ARTICLE_FIELDS

# How a link target becomes an article URL.
RELATIVE_ONLY = "relative_only"  # base + target for a site-relative target, else empty
RESOLVE = "resolve"  # base + target for a site-relative target, else the target
AS_IS = "as_is"


@dataclass(frozen=True)
class SiteRule:
    """Which elements of a site's pages are articles, and the constants its articles carry."""

    source: str
    host: str
    item_tag: str
    item_class: str | None
    title_tag: str | None  # first such element in the item; None: the item itself
    link: str
    cap: int | None  # only this many first items of a page count, titled or not
    url_mode: str
    base_url: str
    author: str
    category: str
    country: str
    content_before: str
    content_after: str


# The sites, their page structure and constants. Whole pages are read; a rule with a ``cap``
# (dataclasses.replace) stops after so many items of a page.
AL_JAZEERA = SiteRule(
    "Al Jazeera", "www.aljazeera.com", "article", None, "h3", INSIDE, None, RELATIVE_ONLY,
    "https://www.aljazeera.com", "Al Jazeera Staff", "News", "International",
    "Article preview: ", "...",
)
BBC_NEWS = SiteRule(
    "BBC News", "www.bbc.com", "h3", None, None, AROUND, None, RESOLVE,
    "https://www.bbc.com", "BBC News Staff", "News", "International",
    "BBC News article: ", "...",
)
HESPRESS = SiteRule(
    "Hespress", "en.hespress.com", "div", "card", "h3", INSIDE, None, AS_IS,
    "", "Hespress Writer", "General", "Maroc",
    "Hespress article: ", "...",
)
HESPRESS_LIVE = SiteRule(
    "Hespress", "en.hespress.com", "div", "card", "h3", INSIDE, None, AS_IS,
    "", "Hespress Writer", "General", "Maroc",
    "Hespress streaming content for: ", "",
)
AKHBARONA = SiteRule(
    "Akhbarona", "www.akhbarona.com", "h2", None, None, INSIDE_ELSE_AROUND, None, AS_IS,
    "", "Akhbarona", "General", "Maroc",
    "Akhbarona article: ", "",
)

BATCH_RULES = (AL_JAZEERA, BBC_NEWS, HESPRESS)
STREAM_RULES = (HESPRESS_LIVE, AKHBARONA)

_RULE = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name == "cap" else T.StringType())
        for name in SiteRule.__dataclass_fields__
    ]
)
_READER_FIELDS = ("item_tag", "item_class", "title_tag", "link", "cap")


def page_host() -> Column:
    """The host of a page's url in lower case; null if it has none."""
    return F.lower(F.try_parse_url("url", F.lit("HOST")))


def matched_pages(pages: DataFrame, rules: Sequence[SiteRule]) -> DataFrame:
    """``(host, pages, matched)``: pages per host, a null host included, and whether a rule reads them."""
    table = pages.sparkSession.createDataFrame([(rule.host, True) for rule in rules], "host string, rule boolean")
    counts = pages.select(page_host().alias("host")).groupBy("host").agg(F.count("*").alias("pages"))
    hosts = counts.join(F.broadcast(table.distinct()), "host", "left")
    return hosts.select("host", "pages", F.col("rule").isNotNull().alias("matched"))


def with_rule(pages: DataFrame, rules: SiteRule | Sequence[SiteRule]) -> DataFrame:
    """Add a ``rule`` struct: one rule for all pages, or the rule of the page's host, null if it has none.

    The rule table is a literal list in this program.
    """
    if isinstance(rules, SiteRule):
        return pages.withColumn("rule", _literal_rule(rules))
    table = pages.sparkSession.createDataFrame([asdict(rule) for rule in rules], _RULE)
    table = table.select("host", F.struct(*table.columns).alias("rule"))
    hosted = pages.withColumn("host", page_host())
    return hosted.join(F.broadcast(table), "host", "left").drop("host")


def _literal_rule(rule: SiteRule) -> Column:
    return F.struct(
        *[F.lit(value).cast(_RULE[name].dataType).alias(name) for name, value in asdict(rule).items()]
    )


def read_items(pages: DataFrame, rules: SiteRule | Sequence[SiteRule], unread: bool = False) -> DataFrame:
    """One row per item, and one with a null ``pos`` per page that could not be read.

    Keeps the page's columns but ``html`` and adds ``rule, pos, title, href, error``. With ``unread``, pages of hosts
    without a rule have a row as well, with a null ``rule``, and ``html`` stays of pages that could not be read.
    """
    ruled = with_rule(pages, rules)
    if not unread:
        ruled = ruled.where(F.col("rule").isNotNull())
    reader_rule = F.struct(*[F.col(f"rule.{name}").alias(name) for name in _READER_FIELDS])
    read = ruled.withColumn("page", page_items(F.when(F.col("rule").isNotNull(), F.col("html")), reader_rule))
    kept = [name for name in ruled.columns if name != "html"]
    failed = [F.when(F.col("page.error").isNotNull(), F.col("html")).alias("html")] if unread else []
    items = read.select(*kept, *failed, "page.error", F.explode_outer("page.items").alias("item"))
    reported = F.col("error").isNotNull() | (F.col("rule").isNull() if unread else F.lit(False))
    return items.where(F.col("item").isNotNull() | reported).select(
        *kept, "item.pos", "item.title", "item.href", "error", *(["html"] if unread else [])
    )


def is_unmatched() -> Column:
    """For rows of :func:`read_items` with ``unread``: a page whose host has no rule."""
    return F.col("rule").isNull()


def failed_pages(items: DataFrame) -> DataFrame:
    """``(page_id, url, html, error)`` of the pages that could not be read, from items with ``unread``."""
    return items.where(F.col("error").isNotNull()).select("page_id", "url", "html", "error")


def unmatched_hosts(items: DataFrame) -> DataFrame:
    """``(host, pages)`` of the pages without a rule, from items with ``unread``; the host may be null."""
    return items.where(is_unmatched()).groupBy(page_host().alias("host")).agg(F.count("*").alias("pages"))


def has_title() -> Column:
    """An item is dropped without its title element; an item that is its own title, when empty."""
    own_title = F.col("rule.title_tag").isNull()
    return F.col("title").isNotNull() & (~own_title | (F.col("title") != ""))


def article_url() -> Column:
    href, base, mode = F.col("href"), F.col("rule.base_url"), F.col("rule.url_mode")
    on_site = href.startswith("/")
    return F.coalesce(
        F.when((mode != AS_IS) & on_site, F.concat(base, href)).when(mode != RELATIVE_ONLY, href),
        F.lit(""),
    )


def utc_iso(moment: Column) -> Column:
    """UTC wall time without zone; the fraction is left out when it is zero."""
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.regexp_replace(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.0{6}$", "")


def to_articles(
    items: DataFrame, article_id: Column | None = None, fetched_at: Column | None = None
) -> DataFrame:
    """Items to bronze articles; by default with a random id and the current time."""
    return items.where(has_title()).select(
        (F.uuid() if article_id is None else article_id).alias("id"),
        "title",
        F.col("rule.author").alias("author"),
        utc_iso(F.current_timestamp() if fetched_at is None else fetched_at).alias("published_date"),
        F.col("rule.category").alias("category"),
        F.concat("rule.content_before", "title", "rule.content_after").alias("content"),
        F.col("rule.source").alias("source"),
        F.col("rule.country").alias("country"),
        article_url().alias("url"),
    ).select(*ARTICLE_FIELDS)


def gathered(items: DataFrame, rules: Sequence[SiteRule]) -> tuple[DataFrame, Observation]:
    """Items brought into few, evenly filled partitions, with counts per source and of bad pages.

    Items are far smaller than their pages, so moving them costs little and avoids one small file
    per page split. Counting after the move keeps the counts exact when a lost executor makes page
    tasks run again.
    """
    observation = Observation("extract")
    titled = has_title()
    counts = [F.count_if(F.col("error").isNotNull()).alias("failed_pages"), F.count_if(titled).alias("total")]
    counts += [
        F.count_if(titled & (F.col("rule.source") == source)).alias(source)
        for source in dict.fromkeys(rule.source for rule in rules)
    ]
    return items.hint("rebalance").observe(observation, *counts), observation
