"""Text functions against stated edge rows and against short Python models of the same rules."""

import random
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions import text as text_functions
from broadsheet.operators import gold
from broadsheet.schema import STOPWORDS
from broadsheet.functions.text import (
    GAP,
    SPACE,
    WHITESPACE,
    canonical_country,
    is_stopword,
    keywords,
    normalize,
    publish_day,
    strip,
    strip_html,
    word_pieces,
)

ONE_TEXT = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("x", T.StringType())])


def apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), ONE_TEXT)
    return [row.y for row in df.select("n", function(F.col("x")).alias("y")).orderBy("n").collect()]


def model_strip_html(text):
    kept, rest = "", text or ""
    while True:
        at = rest.find("<")
        if at < 0:
            return (kept + rest).strip()
        end, newline = rest.find(">", at), rest.find("\n", at)
        if end < 0 or 0 <= newline < end:
            kept, rest = kept + rest[: at + 1], rest[at + 1 :]
        else:
            kept, rest = kept + rest[:at], rest[end + 1 :]


def model_normalize(text):
    one_spaced = " ".join((text or "").lower().split())
    return "".join(c for c in one_spaced if c in " .,!?-" or re.match(r"\w", c))


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, ""),
        ("", ""),
        ("<b>hi</b> x", "hi x"),
        ("<a\nhref=x>m</a>", "<a\nhref=x>m"),
        ("a < b and c > d", "a  d"),
        ("&amp;", "&amp;"),
        ("<>x", "x"),
        ("<b\rc>x", "x"),
        ("<b c>x", "x"),
        ("<script>var t='</p>';</script>", "var t='';"),
        (" \x1f <i> a </i>　\n", "a"),
        ("a<b<c>d", "ad"),
        ("unclosed < tag", "unclosed < tag"),
    ],
)
def test_strip_html_edges(spark, text, expected):
    assert apply(spark, strip_html, [text]) == [expected]
    assert model_strip_html(text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, ""),
        ("Été à Paris, l'élève!", "été à paris, lélève!"),
        ("a & b", "a  b"),
        ("x &", "x "),
        ("a  b", "a b"),
        ("é", "e"),
        ("²½ _ ٣", "²½ _ ٣"),
        ("İ", "i"),
        ("مرحبا بالعالم", "مرحبا بالعالم"),
        ("  A\t\n B  ", "a b"),
        ("a ​ b", "a  b"),
    ],
)
def test_normalize_edges(spark, text, expected):
    assert apply(spark, normalize, [text]) == [expected]


def test_strip_knows_every_white_space(spark):
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert apply(spark, strip, [c + "x" + c for c in WHITESPACE]) == ["x"] * len(WHITESPACE)


def test_space_class_equals_the_list(spark):
    characters = [chr(i) for i in range(0x3100)]
    matched = apply(spark, lambda x: x.rlike(rf"^{SPACE}\z"), characters)
    assert [c for c, hit in zip(characters, matched) if hit] == sorted(WHITESPACE)


def test_gap_leaves_lone_blanks_alone(spark):
    texts = ["a b", "a  b", "a\nb", "a \n b", "\n", " ", "a\t"]
    assert apply(spark, lambda x: F.regexp_replace(x, GAP, "_"), texts) == ["a b", "a_b", "a_b", "a_b", "_", " ", "a_"]


TEXTS = st.lists(
    st.text(
        alphabet=st.one_of(
            st.sampled_from("<> \n\r\t ab_É&;.,!?-'"),
            st.characters(max_codepoint=0x86F, exclude_categories=["Cs", "Cn"]),
        ),
        max_size=40,
    ),
    min_size=100,
    max_size=300,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_strip_html_equals_model(spark, texts):
    assert apply(spark, strip_html, texts) == [model_strip_html(text) for text in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_normalize_equals_model(spark, texts):
    assert apply(spark, normalize, texts) == [model_normalize(text) for text in texts]


def test_country(spark):
    given_names = [None, "MA", "Morocco", "maroc", " maroc ", "", "France"]
    expected = ["Unknown", "Maroc", "Maroc", "Maroc", " maroc ", "", "France"]
    assert apply(spark, canonical_country, given_names) == expected


def test_publish_day(spark):
    stamps = ["2026-05-01T10:11:12.123456", "2026-05-01T23:30:00.1+00:00", "garbage", "01/05/2026", None]
    days = apply(spark, lambda x: publish_day(x).cast("string"), stamps)
    assert days == ["2026-05-01", "2026-05-01", None, None, None]


def test_ascii_keywords(spark):
    texts = ["café the Maroc café", "مرحبا بالعالم", "  lead", "don't x glued", None, "with THAT that"]
    assert apply(spark, keywords, texts) == [["maroc"], [], ["lead"], ["dont", "xglued"], None, ["with", "that", "that"]]


def test_unicode_keywords(spark):
    texts = ["café the Maroc", "مرحبا بالعالم", "l'élève"]
    expected = [["café", "maroc"], ["مرحبا", "بالعالم"], ["lélève"]]
    assert apply(spark, lambda x: keywords(x, "unicode"), texts) == expected


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_keywords_equal_split_and_filter(spark, texts):
    """The one-pass search finds what deleting, splitting at gaps and measuring finds."""

    def split_and_measure(text):
        plain = F.lower(F.regexp_replace(text, r"[^\w\s]", ""))
        return F.filter(F.split(plain, r"\s+"), lambda word: F.length(F.trim(word)) > 3)

    assert apply(spark, keywords, texts) == apply(spark, split_and_measure, texts)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_pieces_hold_the_text_and_its_words(spark, texts):
    before = text_functions.PIECE_LENGTH
    text_functions.PIECE_LENGTH = 5
    try:
        texts = texts + ["one two three", "unbroken_text", "\n\n\n\n\n\n\n"]
        pieces = apply(spark, word_pieces, texts)
        words = apply(spark, lambda x: F.flatten(F.transform(word_pieces(x), lambda piece: keywords(piece))), texts)
    finally:
        text_functions.PIECE_LENGTH = before
    assert ["".join(parts) for parts in pieces] == texts
    assert pieces[-3:] == [["one two", " three"], ["unbroken_text"], ["\n" * 5, "\n" * 2]]
    assert words == apply(spark, keywords, texts)


def test_stopwords(spark):
    words = ["with", "hespress", "maroc", ""]
    assert apply(spark, is_stopword, words) == [True, True, False, True]


def plain_frequency(texts, mode):
    """Every word of the uncut texts, in plain Python."""
    odd = r"[^A-Za-z0-9_ \t\n\x0b\f\r]" if mode == "ascii" else r"[^\w \t\n\x0b\f\r]"
    counts = Counter()
    for text in texts:
        words = re.split(r"[ \t\n\x0b\f\r]+", re.sub(odd, "", text or "").lower())
        counts.update(word for word in words if len(word) >= 4 and word not in STOPWORDS)
    return counts


@pytest.mark.parametrize("mode", ["ascii", "unicode"])
@pytest.mark.parametrize("length", [1, 3, 8, 50])
def test_cut_words_are_put_together(spark, monkeypatch, mode, length):
    """Texts of long and short runs, with copies, at pieces far shorter than the runs."""
    rng = random.Random(length)
    runs = lambda: "".join(rng.choices("abcdé日.-", k=rng.choice([1, 2, 5, 9, 40])))
    texts = ["".join(runs() + rng.choice([" ", "\n", "  ", ""]) for _ in range(rng.randrange(12))) for _ in range(60)]
    texts += texts[:20] + ["", None, " ", "abcd" * 30, "that " * 5, "x" * 7 + " that"]
    monkeypatch.setattr(text_functions, "PIECE_LENGTH", length)
    df = spark.createDataFrame([(text,) for text in texts], "t string").repartition(3)
    got = gold.word_frequency(df, "t", mode).collect()
    assert {row.word: row.frequency for row in got} == plain_frequency(texts, mode)


def test_ten_megabytes_without_a_blank(spark):
    rng = random.Random(2)
    run = "".join(rng.choices("abcdefghij.,;", k=10_000_000))
    texts = [run, f"tiny word {run[:400_000]} tail", run, "日本語" * 200_000, "word"]
    df = spark.createDataFrame([(text,) for text in texts], "t string").repartition(3)
    got = gold.word_frequency(df, "t").collect()
    assert {row.word: row.frequency for row in got} == plain_frequency(texts, "ascii")
    sizes = df.select(F.explode(text_functions.bounded_pieces(F.col("t"))).alias("p")).select(F.max(F.length("p"))).first()[0]
    assert sizes <= 2 * text_functions.PIECE_LENGTH
