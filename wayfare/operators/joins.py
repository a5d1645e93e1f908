"""Joining a large side to a lookup without assuming the lookup is small."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import materialise

#: a measured lookup is broadcast when its size is within both bounds
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: a key with more rows than this is split over tasks
SALT_ROWS = 1_000_000
#: the list of split keys holds the most frequent ones, 16 bytes each. A key beyond
#: it has fewer rows than any on it, so less than one part in HOT_KEYS of all rows
HOT_KEYS = 100_000


def measured(table: DataFrame) -> tuple[int, int]:
    """Rows of a computed table, and the bytes of their text form."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
    n, total = table.agg(F.count("*"), F.sum(sum(widths, F.lit(0)).cast("bigint"))).first()
    return n, total or 0


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys, where null equals null; the keys come from ``left``."""
    names = {name: f"_of_{name}" for name in on}
    other = right.withColumnsRenamed(names)
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(copy)) for name, copy in names.items()])
    return left.join(other, same, how).drop(*names.values())


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    weight: str | None = None,
    rows: int = BROADCAST_ROWS,
    size: int = BROADCAST_BYTES,
    salt_rows: int = SALT_ROWS,
    deal: Sequence[str] = (),
) -> DataFrame:
    """Join ``left`` to a lookup with one row per key; a null key equals a null key.

    Without ``weight`` this is one declarative join: no job runs while the query
    is built, adaptive execution broadcasts a lookup that its shuffle shows to be
    small and splits the partitions of frequent keys.

    ``weight`` names a lookup column that says about how often a key occurs in
    ``left``. The lookup is then computed once and measured: within the bounds
    it is broadcast, beyond them the rows of each frequent key of ``left`` are
    dealt over as many tasks as they need, by the columns ``deal`` (best unique; all
    columns if none are named), and the lookup's row for it is copied to those.
    """
    on = list(on)
    if weight is None:
        return _join(left, lookup, on, how)
    lookup = materialise(lookup)
    n, total = measured(lookup)
    if n <= rows and total <= size:
        return _join(left, F.broadcast(lookup), on, how)
    # keys are listed by hash, so that wide keys cost no more; if another key
    # shares the hash, it is split as well
    code = F.xxhash64(*on)
    heavy = (
        lookup.filter(F.col(weight) > salt_rows).orderBy(F.desc(weight), *on).limit(HOT_KEYS)
        .groupBy(code.alias("_code")).agg(F.ceil(F.sum(weight) / salt_rows).alias("_salts"))
    )
    hot = F.broadcast(materialise(heavy))
    # unique keys hash evenly: where a task's share is small, look it up in
    # memory instead of sorting the large side
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hint = "shuffle_hash" if total / tasks <= size else "merge"
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    salt = F.pmod(F.xxhash64(*(deal or left.columns)), salts)
    dealt = left.withColumn("_code", code).join(hot, "_code", "left").withColumn("_salt", salt)
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    copied = lookup.withColumn("_code", code).join(hot, "_code", "left").withColumn("_salt", copies)
    return _join(
        dealt.drop("_salts", "_code"), copied.drop("_salts", "_code").hint(hint), [*on, "_salt"], how
    ).drop("_salt")

