"""Text rules as native Spark column expressions.

Every function here maps ``Column -> Column`` and stays inside the JVM: no
Python UDF, so the rules run in whole-stage code generation next to the scan.
The rules reproduce Python string semantics (``str.split()``,
``str.isalpha()``, ``str.strip()``) with Java regular expressions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.stopwords import ENGLISH_STOP_WORDS

# Regular expressions (Java syntax) for Python's whitespace and letter classes.
# Python's str.isspace() is Unicode White_Space plus the separators U+001C..U+001F; (?U) makes
# \s the Unicode White_Space class. One character class is faster than an alternation.
UNICODE = "(?U)"
WHITESPACE = r"[\s\x1c-\x1f]"
STRIP = UNICODE + "^" + WHITESPACE + "+|" + WHITESPACE + "+$"
NOT_WHITESPACE = r"[^\s\x1c-\x1f]"
# Characters removed from titles before the title vocabulary is counted (ASCII letters and
# Java's ASCII \s survive).
TITLE_NON_LETTERS = r"[^a-zA-Z\s]"
# Minimum length (exclusive) of a significant description word.
MIN_WORD_LENGTH = 2


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _stops(stop_words: Iterable[str] | None) -> list[str]:
    return list(ENGLISH_STOP_WORDS if stop_words is None else stop_words)


def _not_stop(word: Column, stops: list[str]) -> Column:
    # Catalyst turns a long literal IN list into a hash-set lookup (InSet).
    return ~word.isin(stops) if stops else F.lit(True)


def letter_words(text: Column, min_length: int = 1) -> Column:
    """The whitespace-separated words of ``text`` that are letters only and at least
    ``min_length`` long, in order: ``[w for w in text.split() if w.isalpha() and len(w) >= n]``.

    One regular-expression scan finds them (a run of letters with whitespace or an end on
    both sides), instead of splitting and testing every word with a second expression.
    """
    pattern = (UNICODE + "(?<!" + NOT_WHITESPACE + ")\\p{L}{" + str(min_length) + ",}(?!"
               + NOT_WHITESPACE + ")")
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def description_tokens(text: Column | str, stop_words: Iterable[str] | None = None) -> Column:
    """Significant words of a description, as an array (empty for null).

    Lower-case, split on any whitespace, keep words longer than two characters
    that are letters only and not stop words. Words with attached punctuation
    are dropped, not stripped.
    """
    stops = _stops(stop_words)
    words = letter_words(F.lower(_column(text)), MIN_WORD_LENGTH + 1)
    kept = F.filter(words, lambda w: _not_stop(w, stops))
    return F.coalesce(kept, F.array().cast("array<string>"))


def clean_description(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """The cleaned description as text: significant words joined by one space, '' for null."""
    return F.array_join(description_tokens(text, stop_words), " ")


def title_vocabulary_tokens(title: Column | str, stop_words: Iterable[str] | None = None) -> Column:
    """Title words as counted for the title vocabulary.

    Remove everything but ASCII letters and ASCII whitespace, lower-case, split
    on single spaces, drop empty strings and stop words ("Spider-Man" gives
    ``spiderman``, "Café" gives ``caf``).
    """
    stops = _stops(stop_words)
    words = F.split(F.lower(F.regexp_replace(_column(title), TITLE_NON_LETTERS, "")), " ")
    kept = F.filter(words, lambda w: (w != "") & _not_stop(w, stops))
    return F.coalesce(kept, F.array().cast("array<string>"))


def title_score_tokens(title: Column | str, stop_words: Iterable[str] | None = None) -> Column:
    """Title words as scored: lower-case, whitespace split, letters only, not stop words.

    Unlike the vocabulary, nothing is stripped: "spider-man" is dropped and
    "café" is kept.
    """
    stops = _stops(stop_words)
    kept = F.filter(letter_words(F.lower(_column(title))), lambda w: _not_stop(w, stops))
    return F.coalesce(kept, F.array().cast("array<string>"))


def genre_terms(listed_in: Column) -> Column:
    """Genres as counted: split on ',', trim spaces, drop empty strings (null gives an empty array)."""
    parts = F.transform(F.split(listed_in, ","), lambda g: F.trim(g))
    return F.coalesce(F.filter(parts, lambda g: g != ""), F.array().cast("array<string>"))


def genre_score_terms(listed_in: Column) -> Column:
    """Genres as scored: split on ',' and strip all whitespace (``str.strip()``); empties stay."""
    parts = F.transform(F.split(listed_in, ","), lambda g: F.regexp_replace(g, STRIP, ""))
    return F.coalesce(parts, F.array().cast("array<string>"))
