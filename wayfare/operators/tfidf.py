"""Exact term weights: the collision-free form of hashed TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.functions.fixed import MIN_DOC_FREQ, STOP_WORDS
from wayfare.functions.text import clean_text, content_tokens, term_counts
from wayfare.operators.joins import lookup_join


def _words(words: Sequence[str]) -> Column:
    return content_tokens(clean_text(F.col("review")), words)


def review_terms(
    reviews: DataFrame, keep: Sequence[str] = ("review_id",), words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """``(keep..., term, tf)``: the terms of each review. No shuffle."""
    # the outer form spares the size check that would tokenise each text twice
    return _pairs(reviews.select(*keep, F.inline_outer(term_counts(_words(words)))))


def _pairs(inlined: DataFrame) -> DataFrame:
    return inlined.filter(F.col("term").isNotNull()).withColumn("tf", F.col("tf").cast("bigint"))


def _weighed(
    pairs: DataFrame, reviews: DataFrame, group: Sequence[str], min_doc_freq: int
) -> DataFrame:
    """``(group..., term, df, idf)`` of pairs, one row per review and term.

    Document frequencies are summed before the shuffle, so a term that occurs
    in every review costs one row per task.
    """
    freqs = pairs.groupBy(*group, "term").agg(F.count("*").alias("df"))
    if group:
        sizes = reviews.groupBy(*group).agg(F.count("*").alias("m"))
        freqs = lookup_join(freqs, sizes, group, "inner")
        m = F.col("m")
    else:
        m = reviews.agg(F.count("*").alias("m")).scalar()
    idf = F.when(F.col("df") >= min_doc_freq, F.log((m + 1) / (F.col("df") + 1))).otherwise(0.0)
    return freqs.withColumn("idf", idf).select(*group, "term", "df", "idf")


def term_idf(
    reviews: DataFrame,
    group: Sequence[str] = (),
    min_doc_freq: int = MIN_DOC_FREQ,
    words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """``(group..., term, df, idf)``; rare terms weigh 0, a null group is a group."""
    terms = reviews.select(*group, F.explode_outer(F.array_distinct(_words(words))).alias("term"))
    return _weighed(terms.filter(F.col("term").isNotNull()), reviews, group, min_doc_freq)


def tfidf(
    reviews: DataFrame,
    group: Sequence[str] = (),
    min_doc_freq: int = MIN_DOC_FREQ,
    words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """``(group..., review_id, term, tf, df, idf, tfidf)``.

    With ``group`` the inverse document frequencies are refitted inside each
    group, the null group included. Texts are tokenised once, into a written table of
    a row a review with its terms in an array, which is smaller than the texts; pairs
    exist only while they are counted and while they are weighed. Frequent words make
    the join skewed by nature; see ``lookup_join``.
    """
    keep = list(dict.fromkeys([*group, "review_id"]))
    counted = written(reviews.select(*keep, term_counts(_words(words)).alias("terms")), "review-terms")
    single = counted.select(*group, F.explode("terms.term").alias("term"))
    weights = _weighed(single, reviews, group, min_doc_freq)
    pairs = _pairs(counted.select(*keep, F.inline("terms")))
    joined = lookup_join(pairs, weights, [*group, "term"], "inner", weight="df", deal=["review_id"])
    return joined.withColumn("tfidf", F.col("tf") * F.col("idf"))
