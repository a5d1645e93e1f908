"""Rating labels: the index a rating gets by how often it occurs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.fixed import MISSING_LABEL, RATING_CODES
from wayfare.operators.ranking import row_number_within

ATTRACTION = ("city", "attraction")


def label_index(reviews: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Label per rating: 0 for the most frequent; equal counts go by rating.

    With ``group`` every group gets labels of its own.
    """
    counts = reviews.groupBy(*group, "rating").agg(F.count("*").alias("n"))
    numbered = row_number_within(counts, group, [F.desc("n"), F.asc("rating")], "place")
    return numbered.select(*group, "rating", "n", (F.col("place") - 1).cast("double").alias("label"))


def label_lookup(labels: DataFrame, group: Sequence[str] = ATTRACTION) -> DataFrame:
    """One row per group and star class: its label, or the default if it has none."""
    code = F.col("rating").try_cast("int")
    picked = labels.groupBy(*group).agg(
        *[
            F.coalesce(F.max(F.when(code == int(c), F.col("label"))), F.lit(MISSING_LABEL)).alias(c)
            for c in RATING_CODES
        ]
    )
    return picked.unpivot(list(group), RATING_CODES, "rating", "label")


def present_ratings(reviews: DataFrame, group: Sequence[str] = ATTRACTION) -> DataFrame:
    """Does any review of the group have the star class?"""
    code = F.col("rating").try_cast("int")
    seen = reviews.groupBy(*group).agg(
        *[F.coalesce(F.bool_or(code == int(c)), F.lit(False)).alias(c) for c in RATING_CODES]
    )
    return seen.unpivot(list(group), RATING_CODES, "rating", "present")
