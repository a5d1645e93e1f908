"""Sharding by a hierarchical weighted hash tree, in DataFrame functions alone.

A key descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` from a hash of the key and the child's name, and the least
draw wins: a child is chosen in proportion to its weight, and its draw
changes only when its own weight does. So when weights change, keys move only
into children that grew or out of children that shrank, and inside an
unchanged subtree nothing moves.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 7
#: blocks that a shard's rows are numbered in; the offsets table has at most this many rows a shard
BLOCKS = 1024


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, base: int = 8, racks: int = 2, per_rack: int = 2) -> list[Shard]:
    """The tree of ``shards`` shards.

    The first ``base`` fill regions of ``racks`` racks of ``per_rack`` shards;
    each later one opens a region of its own, so that adding it changes no
    other subtree and it takes keys only into itself.
    """
    full = racks * per_rack
    first_own = -(-base // full)
    return [
        Shard(s // full, s % full // per_rack, s) if s < base else Shard(first_own + s - base, 0, s)
        for s in range(shards)
    ]


def _draw(key: Column, level: str, name: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{SEED}/{level}/{name}")), 11)
    uniform = (bits.cast("double") + 0.5) / float(2**53)
    return -F.log(uniform) / F.lit(float(weight))


def _least(key: Column, level: str, weights: dict[int, float]) -> Column:
    """The child with the least draw; one child needs none."""
    names = [n for n, w in sorted(weights.items()) if w > 0]
    if len(names) == 1:
        return F.lit(names[0])
    draws = [F.struct(_draw(key, level, n, weights[n]).alias("d"), F.lit(n).alias("n")) for n in names]
    return F.least(*draws)["n"]


def place(key: Column, shards: list[Shard]) -> Column:
    """The shard of ``key``; shards of weight 0 get nothing, a null key is a key like others."""

    def descend(rows: list[Shard], depth: int, path: str) -> Column:
        if depth == 3:
            return F.lit(rows[0].shard)
        kids: dict[int, list[Shard]] = {}
        for row in rows:
            kids.setdefault(row[depth], []).append(row)
        weights = {name: sum(r.weight for r in own) for name, own in kids.items()}
        kids = {name: own for name, own in kids.items() if weights[name] > 0}
        chosen = _least(key, path, {n: weights[n] for n in kids})
        below = {n: descend(own, depth + 1, f"{path}/{n}") for n, own in kids.items()}
        if len(below) == 1:
            return next(iter(below.values()))
        if depth == 2:
            return chosen
        out = None
        for name, expression in sorted(below.items()):
            out = F.when(chosen == name, expression) if out is None else out.when(chosen == name, expression)
        return out

    if not any(s.weight > 0 for s in shards):
        raise ValueError("no shard has a weight")
    return descend(list(shards), 0, "root").cast("int")


def numbered(df: DataFrame, group: str, key: str, order: list[str], blocks: int = BLOCKS) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within ``group``.

    Rows are numbered inside hash blocks of the key and shifted by the counts
    of the earlier blocks, so that a group of any size is spread over
    tasks. The counts are one row a group and block, so their size is
    bounded by the groups, not by the rows.
    """
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(blocks)))
    counts = dealt.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col(group).alias("_group"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
    )
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside))
    return (
        ranked.join(F.broadcast(shifts), (F.col(group) == F.col("_group")) & (F.col("_block") == F.col("_b")))
        .withColumn("slot", (F.col("_rank") - 1 + F.col("_shift")).cast("long"))
        .drop("_block", "_b", "_group", "_rank", "_shift")
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Place documents by id into ``shards`` shards of equal weight.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. Only
    the id and the number of shards decide. A null text has size 1 and the
    checksum of the empty text; a null id is placed like any value; repeated
    rows share a shard and get a slot each; an empty table gives no rows; other
    columns are not read. The text is reduced to its checksum in the scan.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(F.col("doc_id"), layout(shards)).alias("shard"),
        place(F.col("doc_id"), layout(shards + 1)).alias("grown_shard"),
    )
    out = numbered(rows, "shard", "doc_id", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
