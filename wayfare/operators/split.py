"""Training and test parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.fixed import SPLIT_SEED, SPLIT_WEIGHTS


def split_number(key: Column, seed: int = SPLIT_SEED) -> Column:
    """A number below 2**32 that depends on the key and the seed alone."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def with_split(
    df: DataFrame,
    key: str = "review_id",
    train_share: float = SPLIT_WEIGHTS[0],
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Mark each row ``train`` or ``test``, the same on any partitioning."""
    is_train = split_number(F.col(key), seed) < int(train_share * 2**32)
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def random_parts(
    df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = SPLIT_SEED
) -> list[DataFrame]:
    """Spark's own seeded split; which rows go where depends on partitioning."""
    return df.randomSplit(list(weights), seed=seed)
