"""Corpus profile, schema report and audit of malformed lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.fixed import RATING_CODES
from wayfare.operators.balance import balanced


def longest_review(reviews: DataFrame) -> DataFrame:
    """Characters of the longest review, one row."""
    return reviews.agg(F.max(F.length("review")).alias("max_len"))


def corpus_profile(reviews: DataFrame, key: str | None = None) -> DataFrame:
    """``(metric, value)``: rows, longest review, skew and the size of the balanced set.

    With ``key``, a unique long, the balanced set is built (without the empty
    classes) and its rows are counted; otherwise its size follows from the
    smallest class, in the same single pass.
    """
    per_class = [F.count_if(F.col("rating") == code) for code in RATING_CODES]
    smallest = F.least(*per_class)
    measured = reviews.agg(
        F.count("*").alias("total_rows"),
        F.max(F.length("review")).cast("bigint").alias("longest_review"),
        *[n.alias(f"rating_{code}") for code, n in zip(RATING_CODES, per_class)],
        smallest.alias("class_minimum"),
        (smallest * len(RATING_CODES)).alias("balanced_rows"),
    )
    if key is not None:
        try:
            counted = balanced(reviews, key, skip_empty=True).count()
        except ValueError:  # no class has a review
            counted = 0
        measured = measured.withColumn("balanced_rows", F.lit(counted).cast("bigint"))
    return measured.unpivot([], measured.columns, "metric", "value")


def column_samples(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """``(column, type, position, sample)``: the first values of each column, as text."""
    types = dict(df.dtypes)
    first = df.orderBy(*order).limit(n)
    place = F.row_number().over(Window.orderBy(*order)) - 1
    texts = first.select(place.alias("position"), *[F.col(c).cast("string").alias(c) for c in df.columns])
    kind = F.create_map(*[F.lit(part) for pair in types.items() for part in pair])
    return texts.unpivot(["position"], df.columns, "column", "sample").select(
        "column", kind[F.col("column")].alias("type"), "position", "sample"
    )


def schema_report(df: DataFrame, filled: bool = False) -> DataFrame:
    """``(column, type)`` without a job; ``filled`` counts the non-null values of every column."""
    if not filled:
        return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")
    kind = F.create_map(*[F.lit(part) for pair in df.dtypes for part in pair])
    counts = df.agg(*[F.count(name).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column", "filled").select(
        "column", kind[F.col("column")].alias("type"), "filled"
    )


def line_audit(parsed: DataFrame) -> DataFrame:
    """Lines per number of fields; fewer than four fields is malformed."""
    return (
        parsed.groupBy("field_count")
        .agg(F.count("*").alias("n"))
        .withColumn("malformed", F.col("field_count") < 4)
    )
