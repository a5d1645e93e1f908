"""Row numbers inside groups of any size, and the ranks built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.cluster import materialise
from wayfare.operators.joins import lookup_join


def row_number_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    out: str,
    window_rows: int | None = None,
) -> DataFrame:
    """Number the rows of each group from 1; ``order`` must leave no ties.

    A null group is a group like others. By default a window in the plan, for
    which no job runs beforehand: a task sorts each group, on disk if need be.
    ``window_rows`` asks to measure first; if the largest group has more rows than
    that, the sorted range partitions of a group are numbered side by side
    and shifted by what lies before them.
    """
    window = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    if window_rows is None:
        return df.withColumn(out, window)
    held = materialise(df)
    largest = held.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if largest <= window_rows:
        return held.withColumn(out, window)
    return _numbered_by_ranges(held, list(group), list(order), out)


def _numbered_by_ranges(
    df: DataFrame, group: list[str], order: list[Column], out: str
) -> DataFrame:
    keys = [F.col(name) for name in group]
    # computed once: a second evaluation could draw other range bounds
    placed = materialise(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id())
    )
    before = (
        Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = (
        placed.groupBy(*group, "_part")
        .agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    return (
        lookup_join(placed, runs, [*group, "_part"], "inner")
        .withColumn(out, F.col("_place") - F.col("_first") + F.col("_before") + 1)
        .select(*df.columns, out)
    )


def rank_scores(scores: DataFrame, group: Sequence[str] = ("city",), score: str = "score") -> DataFrame:
    """Rank attractions by descending score; equal scores go by name."""
    order = [F.desc(score), F.asc("attraction")]
    ranked = row_number_within(scores, group, order, "rank")
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def display_result(rank: Column) -> Column:
    """The value shown next to a rank: 100, 95, 90 and so on."""
    return F.lit(100) - 5 * (rank - 1)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in an explicit order."""
    return df.orderBy(*order).limit(n)
