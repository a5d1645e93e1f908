"""Sentiment scores of attractions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.fixed import RATING_CODES
from wayfare.operators.labels import ATTRACTION


def star_points(rating: Column) -> Column:
    """1 to 5 for a valid rating code, 0 for anything else."""
    code = rating.try_cast("int")
    stars = (code / 10).cast("int")
    return F.when(code.isin([int(c) for c in RATING_CODES]), stars).otherwise(0)


def observed_scores(reviews: DataFrame, group: Sequence[str] = ATTRACTION) -> DataFrame:
    """Weighted average of the stars given; one row per attraction.

    Every row counts below the line, only valid ratings above it. One scan,
    partial sums before the shuffle, whatever the number of attractions.
    """
    return reviews.groupBy(*group).agg(
        F.count("*").alias("n"),
        (F.sum(star_points(F.col("rating"))) / F.count("*")).alias("score"),
    )


def rating_counts(reviews: DataFrame, group: Sequence[str] = ATTRACTION) -> DataFrame:
    """Reviews per star class inside each group: columns ``n1`` to ``n5``."""
    code = F.col("rating").try_cast("int")
    return reviews.groupBy(*group).agg(
        *[F.count_if(code == int(c)).alias(f"n{int(c) // 10}") for c in RATING_CODES],
        F.count("*").alias("n"),
    )
