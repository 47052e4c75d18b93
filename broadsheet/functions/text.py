"""Text functions, all ``Column -> Column`` and all inside the JVM.

The silver rules follow Unicode (letters of every script survive); keyword rules are ASCII unless the
``unicode`` mode is asked for.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.schema import (
    HOME_COUNTRY,
    HOME_COUNTRY_SPELLINGS,
    MIN_KEYWORD_LENGTH,
    STOPWORDS,
    UNKNOWN_COUNTRY,
)

# The Unicode white-space characters.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A tag ends at the first '>' and never spans a line feed. The possessive quantifier keeps a stray
# '<' from being scanned twice.
TAG = r"<[^>\n]*+>"

# The regular-expression engine decides a class of listed ASCII characters by one table look-up, and a
# Unicode property by several calls. The classes below therefore ask the frequent characters first.
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD_CHARACTERS = LOWER + LOWER.upper() + "0123456789_"
ASCII_SPACE = r" \t\n\x0b\f\r"

# White space to rewrite as one blank: any run that is not a lone blank already.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
GAP = rf"[[^{LOWER}]&&{SPACE}](?:{SPACE}++|(?<! ))"

# What normalisation deletes: all but letters, digits, underscore, blank and . , ! ? -
NOT_PLAIN = rf"[[^{LOWER}0123456789_ .,!?\-]&&[^\p{{L}}\p{{N}}]]+"

PIECE_LENGTH = 1 << 16

# Per mode: the characters deleted before a text is cut into words, and a character of a word then.
WORD_RULES = {
    "ascii": (rf"[^{WORD_CHARACTERS}{ASCII_SPACE}]+", r"\w"),
    "unicode": (rf"[[^{WORD_CHARACTERS}{ASCII_SPACE}]&&[^\p{{L}}\p{{N}}]]+", r"\S"),
}


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends; text without any there is passed on as it is."""
    at_start = F.ascii(text).isin(*map(ord, WHITESPACE))
    at_end = reduce(or_, map(text.endswith, WHITESPACE))
    return F.when(at_start | at_end, F.btrim(text, F.lit(WHITESPACE))).otherwise(text)


def strip_html(text: Column) -> Column:
    """Remove tags, then outer white space; null gives the empty string. Entities stay encoded."""
    # Cutting at tags and joining is cheaper than replacing each; most texts hold no tag at all.
    between_tags = F.array_join(F.split(text, TAG), "")
    return strip(F.coalesce(F.when(text.contains("<"), between_tags).otherwise(text), F.lit("")))


def normalize(text: Column) -> Column:
    """Lower case, single blanks, then only letters, digits and basic punctuation.

    Deletion comes last, so a deleted character between blanks leaves two of them.
    """
    blanks = F.btrim(F.regexp_replace(F.lower(text), GAP, " "))
    return F.coalesce(F.regexp_replace(blanks, NOT_PLAIN, ""), F.lit(""))


def canonical_country(country: Column) -> Column:
    return (
        F.when(country.isNull(), UNKNOWN_COUNTRY)
        .when(F.lower(country).isin(*HOME_COUNTRY_SPELLINGS), HOME_COUNTRY)
        .otherwise(country)
    )


def publish_day(published: Column) -> Column:
    """The date at the head of an ISO timestamp; text that is no date gives null."""
    return F.try_to_date(published)


def word_pieces(text: Column) -> Column:
    """A long text as an array of pieces that end where a word ends; a short one as its only piece.

    Each piece can be searched for words by itself. A text without white space stays one piece, see
    :func:`bounded_pieces`.
    """
    return _cut(text, r"\S*+")


def bounded_pieces(text: Column) -> Column:
    """Like :func:`word_pieces`, with pieces of at most twice ``PIECE_LENGTH``: longer words are cut.

    Where a word is cut, the next piece goes on with it.
    """
    return _cut(text, rf"\S{{0,{PIECE_LENGTH}}}+")


def _cut(text: Column, rest_of_word: str) -> Column:
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE_LENGTH}}}+{rest_of_word}"), F.lit(0))
    return F.when(F.octet_length(text) > PIECE_LENGTH, cut).otherwise(F.array(text))


def plain_words(text: Column, mode: str = "ascii") -> Column:
    """Lower-case words of a mode's alphabet with white space between; other characters are deleted.

    Deletion glues what stands around, and what a letter becomes may depend on the letters beside it: both are
    done before a text is cut into pieces.
    """
    return F.lower(F.regexp_replace(text, WORD_RULES[mode][0], ""))


def keywords(text: Column, mode: str = "ascii") -> Column:
    """The lower-case words of keyword length, as an array, stop words included.

    Characters outside the mode's alphabet are deleted first, which glues the parts around them.
    Words are found by one pass over the rest instead of being split, measured and filtered.
    """
    return listed_keywords(plain_words(text, mode), mode)


def listed_keywords(plain: Column, mode: str = "ascii") -> Column:
    """The words of keyword length in text of :func:`plain_words`."""
    return F.regexp_extract_all(plain, F.lit(f"{WORD_RULES[mode][1]}{{{MIN_KEYWORD_LENGTH},}}+"), F.lit(0))


def is_stopword(word: Column) -> Column:
    return word.isin(*STOPWORDS)
