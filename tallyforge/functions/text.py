"""Text expressions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\x0b"


def clean_text(text: Column | str) -> Column:
    """Lower-case, keep only a-z, single spaces between words, no outer spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z]+", " "))


def strip_tags(text: Column | str) -> Column:
    """Replace every ``<...>`` by a space."""
    return F.regexp_replace(text, "<[^>]*>", " ")


def unescape_newline(text: Column | str) -> Column:
    """Turn the two characters backslash-n into a newline."""
    return F.replace(text, F.lit("\\n"), F.lit("\n"))


def split_words(text: Column | str) -> Column:
    """Whitespace-separated tokens, case and punctuation kept.

    May hold an empty first or last entry; drop those after exploding, which is cheaper than
    filtering the array.
    """
    return F.split(text, r"\s+")


def _windows_of(tokens: Column, width: int) -> Column:
    """For each token, it and the up to ``width`` - 1 tokens after it, joined by spaces."""

    def build(bound: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(bound))
        return F.transform(starts, lambda i: F.array_join(F.slice(bound, i, width), " "))

    # The outer one-element transform binds the tokens; used directly inside the inner lambda
    # they would be computed again for every position.
    return F.flatten(F.transform(F.array(tokens), build))


def word_windows(cleaned: Column | str, width: int) -> Column:
    """For each word of non-empty single-spaced text, the up to ``width`` words that start there."""
    return _windows_of(F.split(cleaned, " "), width)


def leading_phrases(window: Column | str, max_n: int) -> Column:
    """The first 1, 2, ... ``max_n`` words of a window; short windows give fewer phrases."""
    heads = [F.substring_index(window, " ", k) for k in range(1, max_n + 1)]
    return F.array_distinct(F.array(*heads))


def ngrams(tokens: Column | str, max_n: int = 5) -> Column:
    """All runs of 1 to ``max_n`` consecutive tokens, joined by spaces.

    Tokens are words: not empty and without spaces.
    """
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    runs = F.flatten(F.transform(_windows_of(tokens, max_n), lambda w: leading_phrases(w, max_n)))
    return F.when(F.size(tokens) > 0, runs).otherwise(F.array().cast("array<string>"))


def friends_array(joined: Column | str) -> Column:
    """``a:b:c`` to an array of ``{userid}`` structs."""
    return F.transform(F.split(joined, ":"), lambda x: F.struct(x.alias("userid")))
