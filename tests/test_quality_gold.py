import datetime

from pyspark.sql import functions as F

from broadsheet.operators import gold
from broadsheet.operators.quality import accepted, accepted_and_observed, quality_report
from broadsheet.operators.silver import to_silver
from broadsheet.functions.language import load_model
from broadsheet.operators.profiles import train_profiles
from broadsheet.schema import ARTICLE, SILVER, STOPWORDS

LONG = "x" * 30


def article(n, **changes):
    base = dict(
        id=str(n), title="t", author="a", published_date="2024-01-01T00:00:00", category="News",
        content=LONG, source="s", country="Maroc", url="",
    )
    return tuple({**base, **changes}[field.name] for field in ARTICLE)


def test_quality_rules_and_report(spark):
    rows = [
        article(1),
        article(2, title=None),
        article(3, title=""),
        article(4, published_date=None),
        article(5, content=None),
        article(6, content="x" * 29),
        article(7, content="\U0001f600" * 30),
        article(8, content="<b>" + "x" * 27),
        article(9, title=" "),
        article(10, category=None, source=None, country=None),
        article(11, published_date=""),
    ]
    df = spark.createDataFrame(rows, ARTICLE)
    assert {row.id for row in accepted(df).collect()} == {"1", "7", "8", "9", "10", "11"}
    assert quality_report(df).first().asDict() == {"loaded": 11, "accepted": 6, "rejected": 5}
    good, report = accepted_and_observed(df)
    assert good.count() == 6 and report.get == {"loaded": 11, "accepted": 6, "rejected": 5}


def test_silver_shape_and_values(spark):
    labelled = spark.createDataFrame([("en", "the town and the river"), ("fr", "la ville et la rivière")], "lang string, text string")
    model = load_model(train_profiles(labelled))
    rows = [article(1, title="<b>The  Été</b>", content="<p>The town &amp; the RIVER is near</p>", country="ma")]
    silver = to_silver(spark.createDataFrame(rows, ARTICLE), model)
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    row = silver.first()
    assert row.content_clean == "The town &amp; the RIVER is near"
    assert row.title_clean == "The  Été" and row.title_normalized == "the été"
    assert row.content_normalized == "the town amp the river is near"
    assert row.language == "en" and row.country == "Maroc" and row.processed_at is not None


def counted(df):
    return sorted([tuple(row) for row in df.collect()], key=str)


def test_counts_with_null_keys_agree_with_single_counts(spark):
    rows = [
        ("2024-01-01T01:00:00", "a", None, "Maroc", "en"),
        ("2024-01-01T23:00:00", "a", "News", "Maroc", "fr"),
        ("bad", None, "News", "", "en"),
        (None, "b", None, "Unknown", "unknown"),
    ]
    silver = spark.createDataFrame(rows, "published_date string, source string, category string, country string, language string")
    together = gold.dimension_counts(silver)
    for name in gold.DIMENSIONS:
        assert counted(gold.one_dimension(together, name)) == counted(gold.articles_per(silver, name))
    days = {row.publish_day: row.article_count for row in gold.articles_per(silver, "publish_day").collect()}
    assert days == {datetime.date(2024, 1, 1): 2, None: 2}
    sums = together.groupBy("dimension").agg(F.sum("article_count").alias("n")).collect()
    assert {row.dimension: row.n for row in sums} == {name: 4 for name in gold.DIMENSIONS}


def test_orders(spark):
    counts = spark.createDataFrame([("b", 1), ("a", 1), (None, 1), ("c", 5)], "source string, article_count long")
    assert [row.source for row in gold.largest_first(counts).collect()] == ["c", None, "a", "b"]
    days = spark.createDataFrame([("2024-01-02", 1), (None, 1), ("2024-01-03", 1)], "publish_day string, article_count long")
    assert [row.publish_day for row in gold.newest_first(days).collect()] == ["2024-01-03", "2024-01-02", None]
    assert [row.publish_day for row in gold.oldest_first(days).collect()] == [None, "2024-01-02", "2024-01-03"]


def test_top_keywords_ties_at_the_cut(spark):
    words = ["zebra", "apple", "mango", "mango", "berry"]
    texts = spark.createDataFrame([(word,) for word in words], "title_clean string")
    top = gold.top_keywords(texts, limit=3).collect()
    assert [tuple(row) for row in top] == [("mango", 2), ("apple", 1), ("berry", 1)]


def test_stopwords_never_count(spark):
    texts = spark.createDataFrame([(" ".join(STOPWORDS) + " Maroc",)], "title_clean string")
    assert [tuple(row) for row in gold.top_keywords(texts).collect()] == [("maroc", 1)]
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 68


def test_share_and_totals(spark):
    counts = spark.createDataFrame([("a", 1), (None, 2), ("c", 5)], "country string, article_count long")
    shares = {row.country: row.share for row in gold.share_of_total(counts).collect()}
    assert shares == {"a": 0.125, None: 0.25, "c": 0.625}
    articles = spark.createDataFrame([("a",), ("a",), (None,)], "source string")
    assert counted(gold.source_totals(articles)) == counted(
        spark.createDataFrame([("a", 0, 2), (None, 0, 1), (None, 1, 3)], "s string, t int, n long")
    )
