"""Near duplicates by SimHash fingerprints, linked with vantage-point trees.

Two fingerprints that differ in at most ``bits`` bits differ in at most ``bits
// BANDS`` bits of one of ``BANDS`` bands. The Hamming distance on a band is a
metric, so each band has a vantage-point tree: a node holds a vantage point and
a radius, fingerprints nearer than the radius go left, the others right, and by
the triangle inequality a query at distance d of the vantage point has
to look left only if d - r < radius and right only if d + r >= radius. On a
band r is 1 where it is 4 on whole fingerprints, whose distances crowd around
32 so closely that both branches would nearly always remain.

The upper levels of the trees are grown on a bounded sample and deal the
fingerprints out to shards: home shard by distance, and copies of the query to
every shard whose ball it may reach. A shard continues the same recursion
in memory down to small leaves, which are compared exactly. A node whose
points have one distance on the band goes on with whole fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import CARRIED, WORD_BYTES, carry, components, sliced, tasks, unpacked

SHINGLE, BITS, SEED = 4, 4, 42
#: the bands of a fingerprint: 21, 21 and 22 bits
BANDS = [(1 << 21) - 1, ((1 << 21) - 1) << 21, ((1 << 22) - 1) << 42]
WHOLE = (1 << 64) - 1
#: fingerprints a shard holds on average, sample that the upper trees are grown on, points of a leaf
SHARD_SIZE, SAMPLE, LEAF = 8192, 8192, 96


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of the lower-cased (A-Z) words' shingles; 0 without words."""
    words = WORD_BYTES.findall((text or "").encode().lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    total, ones = n, np.zeros(64, np.int64)
    spans = zip(starts[:n].tolist(), last.tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    for at in range(0, n, 4096):  # bounds the table of bits of very long texts
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [fingerprint(t, size) for t in batch.column("text").to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), fps], ["doc_id", "key", "fp"])

    return run


class Node(NamedTuple):
    """An inner node of a tree: a leaf is a shard number instead."""

    mask: int
    reach: int
    vantage: int
    radius: int
    left: Node | int
    right: Node | int


def _distance(points: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((points ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int64)


def _split(points: np.ndarray, mask: int, reach: int, bits: int):
    """Vantage point, radius, mask and reach that divide ``points``, or None.

    The vantage point is one that spreads the distances; the radius is their median.
    """
    for own, r in ((mask, reach), (WHOLE, bits)):
        best = None
        for vantage in points[:: max(1, len(points) // 5)][:5]:
            d = _distance(points, int(vantage), own)
            radius = int(np.median(d))
            radius += not (d < radius).any()
            inside = int((d < radius).sum())
            if 0 < inside < len(d):
                # both sides are searched by the queries within reach of the border
                border = int(((d - r < radius) & (d + r >= radius)).sum())
                cost = border + max(inside, len(d) - inside)
                if best is None or cost < best[0]:
                    best = (cost, int(vantage), radius)
        if best and best[0] < 1.9 * len(points):
            return own, r, best[1], best[2]
    return None


def grow(sample: np.ndarray, mask: int, reach: int, bits: int, shards: int) -> tuple[Node | int, int]:
    """A tree of about ``shards`` leaves over the sample, and the number of its leaves."""
    least, count = max(2, len(sample) // max(1, shards)), 0

    def build(points: np.ndarray) -> Node | int:
        nonlocal count
        cut = _split(points, mask, reach, bits) if len(points) > least else None
        if cut is None:
            count += 1
            return count - 1
        own, r, vantage, radius = cut
        near = _distance(points, vantage, own) < radius
        return Node(own, r, vantage, radius, build(points[near]), build(points[~near]))

    return build(sample), count


def descend(node: Node | int, points: np.ndarray, rows: np.ndarray, query: bool, out: list) -> None:
    """Append (shard, rows) for the home shards of ``points`` or, as queries, for all they may reach."""
    if not len(points):
        return
    if not isinstance(node, Node):
        out.append((node, rows))
        return
    d, reach = _distance(points, node.vantage, node.mask), node.reach if query else 0
    left = d - reach < node.radius
    right = d + reach >= node.radius
    descend(node.left, points[left], rows[left], query, out)
    descend(node.right, points[right], rows[right], query, out)


def _dealt(trees: list, bits: int):
    """fp -> rows (tree, shard, fp, home), the home row and the copies of the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("fp").to_numpy().view(np.uint64)
            rows = np.arange(len(points))
            for t, tree in enumerate(trees):
                home = np.zeros(len(points), np.int64)
                found: list = []
                descend(tree, points, rows, False, found)
                for shard, own in found:
                    home[own] = shard
                found = []
                descend(tree, points, rows, True, found)
                for shard, own in found:
                    n = len(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, t, np.int32)), pa.array(np.full(n, shard, np.int32)),
                         pa.array(points[own].view(np.int64)), pa.array(home[own] == shard)],
                        ["tree", "shard", "fp", "home"],
                    )

    return run


class _Forest:
    """Union-find over the places of an array."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def search(points: np.ndarray, home: np.ndarray, mask: int, bits: int) -> _Forest:
    """Link all pairs of a home point and any point that differ in at most ``bits`` bits."""
    forest = _Forest(len(points))
    values = points

    def visit(own: np.ndarray, asked: np.ndarray) -> None:
        """``own``: places of home points here; ``asked``: places of the queries that reach them."""
        while len(own) and len(asked):
            cut = _split(values[own], mask, bits // len(BANDS), bits) if len(own) > LEAF else None
            if cut is None:
                break
            m, r, vantage, radius = cut
            d, q = _distance(values[own], vantage, m), _distance(values[asked], vantage, m)
            near = d < radius
            visit(own[near], asked[q - r < radius])
            own, asked = own[~near], asked[q + r >= radius]
        if len(own) and len(asked):
            step = max(1, 4_000_000 // len(own))
            for at in range(0, len(asked), step):
                some = asked[at : at + step]
                close = np.bitwise_count(values[some][:, None] ^ values[own][None, :]) <= bits
                close &= some[:, None] != own[None, :]
                i, j = np.nonzero(close)
                forest.link(some[i], own[j])

    visit(np.flatnonzero(home), np.arange(len(points)))
    return forest


def _links(bits: int):
    """One shard of one tree: its links as a spanning forest (a, b)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("fp", "ascending")])
        points = table["fp"].to_numpy().view(np.uint64)
        tree = table["tree"][0].as_py() if len(points) else 0
        forest = search(points, table["home"].to_numpy(zero_copy_only=False), BANDS[tree], bits)
        roots = np.array([forest.find(i) for i in range(len(points))], np.int64)
        linked = np.flatnonzero(roots != np.arange(len(points)))
        fps = points.view(np.int64)
        return pa.table({"a": fps[linked], "b": fps[roots[linked]]})

    return run


def _grouped(docs: DataFrame, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, key, fp`` of every document, and ``fp, least, root`` of every fingerprint."""
    if not 0 <= bits // len(BANDS) <= 1:
        raise ValueError("the bands are made for fewer than six bits")
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = docs.select("doc_id", "text").withColumn("key", F.xxhash64("text"))
    prints = written(plain.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, key long, fp long"), "fingerprints")
    points = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    total = points.count()
    shards = max(1, total // SHARD_SIZE)
    # the smallest hashes are a fair sample of bounded size, whatever the number of points
    sample = points.select("fp", F.xxhash64("fp").alias("h")).orderBy("h").limit(min(SAMPLE, total))
    sample = np.array([r["fp"] for r in sample.collect()], np.int64).view(np.uint64)
    trees = [grow(sample, mask, bits // len(BANDS), bits, shards)[0] for mask in BANDS]
    dealt = points.select("fp").mapInArrow(_dealt(trees, bits), "tree int, shard int, fp long, home boolean")
    edges = (
        dealt.repartition(max(tasks(spark), 1), "tree", "shard")
        .groupBy("tree", "shard").applyInArrow(_links(bits), "a long, b long")
    )
    groups = components(edges)
    rooted = points.join(groups, points["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    return prints, rooted


def near_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row per document with its fingerprint and its group.

    Returns ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the
    smallest ``doc_id`` reachable over fingerprints that differ in at most
    ``bits`` bits. Null, empty and blank texts have fingerprint zero, linked like any
    other; a null id has a fingerprint and takes part, but names no group
    unless all its group's ids are null; repeated rows are rows; an empty table
    gives no rows; other columns are not read.

    Equal fingerprints are one point, so copies cost nothing; a shard
    returns a spanning forest, so a dense group costs one link a point.
    """
    prints, rooted = _grouped(docs, shingle, bits)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_point = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(of_point, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each group: the one with the least id (null last), of several texts of that id the one with the least hash.

    All columns stay; of rows that repeat the id and the text one stays.
    """
    prints, rooted = _grouped(docs, shingle, bits)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    least = prints.groupBy("fp").agg(F.min(place).alias("first"))
    chosen = (
        least.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    order = Window.partitionBy("_id", "_key").orderBy("_key")
    rows = carry(docs, "doc_id", "text").join(chosen, same).withColumn("_row", F.row_number().over(order))
    return unpacked(rows.where("_row = 1").select("doc_id", "text", f"`{CARRIED}`"), docs)
