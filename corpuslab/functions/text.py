"""Column expressions for text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .stopwords import STOP_WORDS

# Markup, words, and the lengths that count.
MARKUP = r"<[^>]+>"
WORD = r"[a-z0-9\-]+"
MIN_CHARS = 10
MIN_WORDS, MAX_WORDS = 5, 2000


def has_text(text: Column) -> Column:
    return text.isNotNull() & (F.length(text) > MIN_CHARS)


def strip_markup(text: Column, filler: str = " ") -> Column:
    return F.regexp_replace(text, MARKUP, filler)


def keep_allowed(text: Column) -> Column:
    """Every character but a-z, 0-9, white space and hyphen becomes a space.

    The class is spelled as ranges: the negated form makes threads of one JVM
    wait for each other and takes about twice as long.
    """
    return F.regexp_replace(text, r"[\x00-\x08\x0e-\x1f!-,./:-`{-\x{10ffff}]", " ")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clean_words(text: Column) -> Column:
    """The words of the cleaned text.

    Lower-casing, stripping markup, blanking other characters and collapsing
    spaces leaves the runs of allowed characters, so they are matched directly.
    """
    return F.regexp_extract_all(strip_markup(F.lower(text)), F.lit(WORD), F.lit(0))


def word_count(clean: Column) -> Column:
    return F.size(F.split(clean, " "))


def words_in_range(count: Column) -> Column:
    return count.between(MIN_WORDS, MAX_WORDS)


def tokenize(text: Column) -> Column:
    """Split on every single white-space character; trailing empty tokens go, inner ones stay."""
    body = F.regexp_replace(F.lower(text), r"\s+$", "")
    only_space = (F.length(body) == 0) & (F.length(text) > 0)
    return F.when(only_space, F.array().cast("array<string>")).otherwise(F.split(body, r"\s"))


def drop_stop_words(words: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    return F.filter(words, lambda w: ~F.lower(w).isin(stop_words))


def bigrams(words: Column) -> Column:
    return F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.size(words)),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def trim_all(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def literal_pattern(text: str) -> str:
    return "\\Q" + text + "\\E"


def escape_html(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def escape_pattern(text: Column) -> Column:
    return F.regexp_replace(text, r"([.*+?^${}()|\[\]\\])", r"\\$1")
