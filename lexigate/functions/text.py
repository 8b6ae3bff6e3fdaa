"""Text expressions: cleaning, lengths, tokens, n-grams.

All but ``strip_accents`` are built-in expressions, so cleaning and tokenising stay in the
JVM. Java's ``\\s`` is ASCII only and its ``.`` also stops at ``\\r``; whitespace is therefore
spelled out as a character class and ``.`` is never used.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: every code point that counts as whitespace for a Python str
WHITESPACE = (
    "\\t-\\r\\x1c-\\x20\\x85\\xa0"
    "\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
)
WHITESPACE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# text standing in for a null cell once the cell is stringified
NULL_TOKEN = "nan"


def raw_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(NULL_TOKEN))


def clean_text(text: Column) -> Column:
    """Lowercase, drop URLs, then drop markup, then keep a-z and 0-9 split by one space.

    URLs go first, so one inside an attribute swallows the text up to the next whitespace and
    can leave its opening ``<a href=`` behind.
    """
    lowered = F.lower(raw_text(text))
    no_urls = F.regexp_replace(lowered, f"http[^{WHITESPACE}]+", "")
    no_markup = F.regexp_replace(no_urls, r"<[^>\n]*>", "")
    return F.trim(F.regexp_replace(no_markup, "[^a-z0-9]+", " "))


def text_length(text: Column) -> Column:
    """Code points of the raw text."""
    return F.length(raw_text(text))


def word_count(text: Column) -> Column:
    """Whitespace-separated words of the raw text."""
    # cut at single characters: a pattern of all whitespace beside those of clean_text takes three times as long
    spaced = F.translate(raw_text(text), WHITESPACE_CHARACTERS, " " * len(WHITESPACE_CHARACTERS))
    return F.size(F.array_remove(F.split(spaced, " "), ""))


def strip_whitespace(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def tokens(clean: Column) -> Column:
    """Words of two characters or more of a cleaned text."""
    return F.filter(F.split(clean, " "), lambda word: F.length(word) >= 2)


def raw_tokens(text: Column) -> Column:
    """Tokens of a text that was not cleaned: lowercase, accents off, runs of word characters."""
    plain = strip_accents(F.lower(raw_text(text)))
    return F.regexp_extract_all(plain, F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def with_bigrams(words: Column) -> Column:
    """The words, followed by each pair of neighbours joined by a space.

    Pairs are formed from the words left after one-character words were dropped.
    """
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(
        words,
        F.zip_with(
            F.slice(words, F.lit(1), pairs),
            F.slice(words, F.lit(2), pairs),
            lambda left, right: F.concat_ws(" ", left, right),
        ),
    )


def strip_accents(text: Column) -> Column:
    """Compatibility-decompose and drop combining marks.

    Spark has no normalisation function, hence the Arrow UDF. Cleaned text is ASCII and never
    needs it.
    """
    return _strip_accents_udf()(text)


def _strip_accents_udf():
    # defined inside a function so that it ships by value and executors need no package
    def strip(batch: pd.Series) -> pd.Series:
        import unicodedata

        def one(value):
            if value is None or value.isascii():
                return value
            decomposed = unicodedata.normalize("NFKD", value)
            return "".join(c for c in decomposed if not unicodedata.combining(c))

        return batch.map(one, na_action="ignore")

    return F.pandas_udf(strip, "string")
