"""Star-class counts and the balanced training set."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.fixed import RATING_CODES

#: bits of the key settled by one counting pass
PASS_BITS = 12


def class_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per star class; a class nobody chose is reported with 0."""
    counts = reviews.agg(
        *[F.count_if(F.col("rating") == code).alias(code) for code in RATING_CODES]
    )
    return counts.unpivot([], RATING_CODES, "rating", "n")


def class_minimum(reviews: DataFrame) -> DataFrame:
    """Size of the smallest star class, one row."""
    return class_counts(reviews).agg(F.min("n").alias("min_n"))


def balanced(
    reviews: DataFrame, key: str = "review_id", skip_empty: bool = False
) -> DataFrame:
    """The first reviews of every star class by ``key``, equally many of each.

    ``key`` is a unique long. The last key of each class is found by counting
    (see ``class_cutoffs``), which turns the sample into a plain filter that
    reaches the scan: no class is sorted, shuffled or gathered in one task.
    """
    cutoffs = class_cutoffs(reviews, key, skip_empty)
    return reviews.filter(reduce(or_, [up_to(code, key, last) for code, last in sorted(cutoffs.items())]))


def class_samples(
    reviews: DataFrame, key: str = "review_id", skip_empty: bool = False
) -> dict[str, DataFrame]:
    """The balanced sample of each star class by itself."""
    cutoffs = class_cutoffs(reviews, key, skip_empty)
    return {code: reviews.filter(up_to(code, key, last)) for code, last in sorted(cutoffs.items())}


def up_to(code: str, key: str, last: int) -> Column:
    """Rows of a class up to a key."""
    return (F.col("rating") == code) & (F.col(key) <= F.lit(last))


def class_cutoffs(
    reviews: DataFrame, key: str = "review_id", skip_empty: bool = False
) -> dict[str, int]:
    """The key of the n-th review of each class, n being the smallest class.

    Reviews without a key belong to no sample and count for no class.

    Every pass counts the keys of the remaining range of each class in at most
    2**PASS_BITS steps and keeps the step that holds the n-th key, so a 64-bit
    key is settled in at most six passes over two columns, and the driver sees
    only those counts.
    """
    rows = (
        reviews.filter(F.col("rating").isin(RATING_CODES))
        .groupBy("rating")
        .agg(F.count(key).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        .collect()
    )
    rows = [row for row in rows if row["n"]]
    found = {row["rating"]: row for row in rows}
    empty = [code for code in RATING_CODES if code not in found]
    if empty and not (skip_empty and found):
        raise ValueError(f"no reviews with rating {', '.join(empty)}: nothing to balance")
    need = min(row["n"] for row in rows)
    cutoffs: dict[str, int] = {}
    open_ranges: dict[str, tuple[int, int, int]] = {}
    for code, row in found.items():
        if row["n"] == need:
            cutoffs[code] = row["high"]
        else:
            open_ranges[code] = (row["low"], row["high"], need)
    while open_ranges:
        shifts = {code: _shift(low, high) for code, (low, high, _) in open_ranges.items()}
        steps = _step_counts(reviews, key, open_ranges, shifts)
        for code, (low, high, left) in list(open_ranges.items()):
            shift = shifts[code]
            for step, n in sorted(steps[code]):
                if n >= left:
                    break
                left -= n
            low, high = max(low, step << shift), min(high, ((step + 1) << shift) - 1)
            if n == left:
                cutoffs[code] = high
                del open_ranges[code]
            elif low == high:
                raise ValueError(f"{key} is not unique: {n} reviews share {low}")
            else:
                open_ranges[code] = (low, high, left)
    return cutoffs


def _shift(low: int, high: int) -> int:
    bits = 64 if low < 0 <= high else (low ^ high).bit_length()
    return max(0, bits - PASS_BITS)


def _step_counts(
    reviews: DataFrame,
    key: str,
    ranges: dict[str, tuple[int, int, int]],
    shifts: dict[str, int],
) -> dict[str, list[tuple[int, int]]]:
    step: Column | None = None
    for code, shift in shifts.items():
        here = F.shiftright(F.col(key), shift)
        matches = F.col("rating") == code
        step = F.when(matches, here) if step is None else step.when(matches, here)
    inside = [
        (F.col("rating") == code) & F.col(key).between(low, high)
        for code, (low, high, _) in ranges.items()
    ]
    rows = (
        reviews.filter(reduce(or_, inside))
        .groupBy("rating", step.alias("step"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    steps: dict[str, list[tuple[int, int]]] = {code: [] for code in ranges}
    for row in rows:
        steps[row["rating"]].append((row["step"], row["n"]))
    return steps


def union_of(samples: dict[str, DataFrame]) -> DataFrame:
    """Bag union of one branch per star class."""
    return reduce(DataFrame.unionByName, samples.values())
