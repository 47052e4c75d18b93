"""Record shapes and fixed word lists shared by every stage."""

from pyspark.sql import types as T

ARTICLE_FIELDS = [
    "id",
    "title",
    "author",
    "published_date",
    "category",
    "content",
    "source",
    "country",
    "url",
]

ARTICLE = T.StructType([T.StructField(name, T.StringType()) for name in ARTICLE_FIELDS])

# A line of bronze: an article, or the text of a line that is none.
BROKEN = T.StructType([*ARTICLE.fields, T.StructField("broken_line", T.StringType())])

SILVER = T.StructType(
    ARTICLE.fields
    + [
        T.StructField("content_clean", T.StringType()),
        T.StructField("title_clean", T.StringType()),
        T.StructField("content_normalized", T.StringType()),
        T.StructField("title_normalized", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

UNKNOWN_LANGUAGE = "unknown"

# Words never counted as keywords.
STOPWORDS = tuple(
    """
    the a an and or in on at to for of is was are be been with that this it by from as has have
    had but not its their
    le la les de du des un une et en au aux que qui sur par dans est ont son sa se si plus il elle
    nous vous ils elles
    article apercu preview content news hespress bbc
    """.split()
) + ("",)

# Spellings of one country (compared in lower case) and the names written instead.
HOME_COUNTRY_SPELLINGS = ("maroc", "morocco", "ma")
HOME_COUNTRY = "Maroc"
UNKNOWN_COUNTRY = "Unknown"

MIN_CONTENT_LENGTH = 30
MIN_KEYWORD_LENGTH = 4
TOP_KEYWORDS = 200
