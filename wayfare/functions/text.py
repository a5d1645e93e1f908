"""Text cleaning and tokens, all as JVM column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.functions.fixed import STOP_WORDS


def clean_text(text: Column) -> Column:
    """Lower-case and remove (not replace) everything but letters and spaces."""
    # no capitals are left to spare, and the shorter class matches twice as fast
    return F.regexp_replace(F.lower(text), "[^a-z ]++", "")


def tokens(cleaned: Column) -> Column:
    """The non-empty words of a cleaned text."""
    return F.filter(F.split(cleaned, " "), lambda word: word != "")


def stop_words(clean: bool = False) -> list[str]:
    """The English stop words.

    Reviews lose their apostrophes before stop words are looked up, so the
    entries that contain one never match. ``clean=True`` cleans the list too.
    """
    if not clean:
        return list(STOP_WORDS)
    return list(dict.fromkeys(word.replace("'", "") for word in STOP_WORDS))


def content_tokens(cleaned: Column, words: Iterable[str] = STOP_WORDS) -> Column:
    """Non-empty words that are not stop words, in order, repeats kept."""
    # a long literal list is looked up in a hash set, so each word costs O(1)
    stops = list(words)
    return F.filter(F.split(cleaned, " "), lambda word: (word != "") & ~word.isin(stops))


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def term_counts(words: Column) -> Column:
    """``array<struct<term, tf>>`` of one text: run lengths of its sorted words.

    A review is one row, so its term counts need no shuffle at all; grouping
    exploded words by (review, term) would move every distinct pair instead.
    """

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return _bind(
            starts,
            lambda begin: F.transform(
                begin,
                lambda i, k: F.struct(
                    F.get(ordered, i).alias("term"),
                    (F.coalesce(F.get(begin, k + 1), size) - i).alias("tf"),
                ),
            ),
        )

    return _bind(F.sort_array(words), lambda w: F.when(F.size(w) > 0, runs(w)))
