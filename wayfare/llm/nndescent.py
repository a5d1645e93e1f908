"""Near-duplicate embeddings by NN-descent, with exact handling of dense groups.

The neighbour graph starts from the leaves of a few random projection trees and
is refined by neighbours-of-neighbours joins: at each point, the vectors of
its neighbours and of those that have it as a neighbour meet, and pairs that are new
to each other are offered to both. A point whose list is full of
neighbours above the threshold gets a longer list. Rounds end when no link is
added and an audit, a bounded set of query points compared with all
points, finds the recall reached; else further trees are added. Where links are so
rare that the queries meet few, the audit is by recapture: the share of the links
found by new trees alone that the graph holds already. A graph that stays below the
target is returned with a warning.

Groups so dense that they show in a bounded sample need no lists: all vectors
within half the linking angle of a leader are linked with each other, so such a
ball is counted, not enumerated. Vectors near a ball are compared with its
members block by block. Equal vectors are one point with a weight.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import components

COSINE = 0.9
#: neighbours of a list at first, trees at first, points of a leaf
NEIGHBOURS, TREES, LEAF = 8, 4, 128
#: bounded samples: for the trees and the leaders, and queries of an audit
SAMPLE, AUDITED = 4096, 256
#: an audit that met fewer links than this proves nothing: new trees recapture links instead
SEEN = 100
#: sample points that make a ball; balls at most (both bound what is broadcast)
DENSE, BALLS = 8, 256
RECALL, ROUNDS = 0.98, 12
#: members that meet at one centre; more are dealt over several groups
MEETING = 256
BLOCK = 2048


def _units(cosine_width: int):
    """vec_id, embedding -> vec_id, unit (float64 bytes, null if it links with nothing), dim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = [], []
            for v in batch.column("embedding").to_pylist():
                unit = None
                if v is not None and None not in v and len(v):
                    x = np.asarray(v, np.float64)
                    top = np.abs(x).max()
                    if np.isfinite(x).all() and top > 0:
                        x = x / top  # so that the squares neither overflow nor vanish
                        x = x / np.sqrt((x * x).sum())
                        unit = np.pad(x, (0, cosine_width - len(x))).tobytes()
                units.append(unit)
                dims.append(len(v) if v is not None else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(units, pa.binary()), pa.array(dims, pa.int32())], ["vec_id", "unit", "dim"]
            )

    return run


def _stacked(column: pa.Array, kind: str = "<f8") -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1) if rows else np.zeros((0, 1))


def leaders_of(sample: np.ndarray, dims: np.ndarray, cosine: float) -> list[int]:
    """Places of sample vectors that lead dense balls, the densest first."""
    near = (sample @ sample.T >= _half(cosine)) & (dims[:, None] == dims[None, :])
    found: list[int] = []
    while len(found) < BALLS:
        counts = near.sum(axis=1)
        best = int(counts.argmax())
        if counts[best] < DENSE:
            break
        found.append(best)
        gone = near[best].copy()
        near[gone] = False
        near[:, gone] = False
    return found


def _half(cosine: float) -> float:
    """Cosine of half the linking angle; vectors that near to a leader link with each other."""
    return math.sqrt((1 + cosine) / 2) + 1e-9


def _reach(cosine: float) -> float:
    """Cosine of one and a half linking angles: members of a ball link with nothing beyond."""
    return math.cos(1.5 * math.acos(cosine)) - 1e-9


def _balls(leaders: np.ndarray, dims: np.ndarray, cosine: float):
    """Points -> ball (number or -1) and the other balls whose members they may link with."""
    half, reach = _half(cosine), _reach(cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball, near = np.full(batch.num_rows, -1, np.int32), [[] for _ in range(batch.num_rows)]
            if len(leaders) and batch.num_rows:
                cos = _stacked(batch.column("unit")) @ leaders.T
                cos[batch.column("dim").to_numpy()[:, None] != dims[None, :]] = -1
                best = cos.argmax(axis=1)
                inside = cos[np.arange(len(cos)), best] >= half
                ball[inside] = best[inside]
                for i in np.flatnonzero((cos >= reach).any(axis=1)):
                    near[i] = [int(b) for b in np.flatnonzero(cos[i] >= reach) if b != ball[i]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ball), pa.array(near, pa.list_(pa.int32()))], [*batch.schema.names, "ball", "near"]
            )

    return run


def _block_counts(cosine: float):
    """One block of a ball's members next to all points near that ball: counts of links."""

    def run(members: pa.Table, near: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"pid": [], "links": [], "touches": []}
        if members.num_rows and near.num_rows:
            m, n = _stacked(members["unit"].combine_chunks()), _stacked(near["other_unit"].combine_chunks())
            mw, nw = members["weight"].to_numpy(), near["other_weight"].to_numpy()
            same, other = members["dim"][0].as_py() == near["other_dim"].to_numpy(), near["other"].to_numpy()
            of_member = np.zeros(len(m), np.int64)
            # a point in a ball of its own counts here only for itself: that ball asks back
            alone = near["alone"].to_numpy(zero_copy_only=False)
            for at in range(0, len(n), BLOCK):
                span = slice(at, at + BLOCK)
                linked = (n[span] @ m.T >= cosine) & same[span, None]
                links = linked @ mw
                hit = np.flatnonzero(links)
                out["pid"].append(other[span][hit])
                out["links"].append(links[hit])
                out["touches"].append(np.full(len(hit), members["ball"][0].as_py()))
                of_member += (linked & alone[span, None]).T @ nw[span]
            hit = np.flatnonzero(of_member)
            out["pid"].append(members["pid"].to_numpy()[hit])
            out["links"].append(of_member[hit])
            out["touches"].append(np.full(len(hit), -1))
        join = lambda n: np.concatenate(out[n]).astype(np.int64) if out[n] else np.zeros(0, np.int64)
        return pa.table({"pid": join("pid"), "links": join("links"), "ball": pa.array(join("touches").astype(np.int32))})

    return run


def grow(sample: np.ndarray, leaf: int, seed: int) -> list:
    """A random projection tree as nested (normal, offset, left, right); a leaf is its number."""
    rng, count = np.random.default_rng(seed), 0

    def build(x: np.ndarray):
        nonlocal count
        if len(x) > leaf:
            normal = rng.standard_normal(x.shape[1])
            place = x @ normal
            offset = float(np.median(place))
            left = place < offset
            if 0 < left.sum() < len(x):
                return normal, offset, build(x[left]), build(x[~left])
        count += 1
        return count - 1

    return build(sample)


def _leaves(trees: list):
    """Points -> (tree, leaf, pid, v) for every tree."""

    def place(node, x: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
        if not isinstance(node, tuple):
            out[rows] = node
            return
        left = x[rows] @ node[0] < node[1]
        place(node[2], x, rows[left], out)
        place(node[3], x, rows[~left], out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _stacked(batch.column("v"), "<f4").astype(np.float64)
            for t, tree in trees:
                leaf = np.zeros(len(x), np.int32)
                place(tree, x, np.arange(len(x)), leaf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(leaf), batch.column("pid"), batch.column("v")],
                    ["tree", "leaf", "pid", "v"],
                )

    return run


def _offers(rows: np.ndarray, columns: np.ndarray, sims: np.ndarray, floor: np.ndarray, cosine: float) -> tuple:
    """For every row of ``sims`` the best partners above its floor: all that link and the best few."""
    sims = np.where(sims > floor[:, None], sims, -2)
    keep = sims >= cosine - 1e-5
    if sims.shape[1] > NEIGHBOURS:
        best = np.argpartition(-sims, NEIGHBOURS, axis=1)[:, :NEIGHBOURS]
        np.put_along_axis(keep, best, True, axis=1)
    else:
        keep[:] = True
    i, j = np.nonzero(keep & (sims > -2))
    return rows[i], columns[j], sims[i, j]


def _offer_table(parts: list[tuple]) -> pa.Table:
    a, b, s = (np.concatenate(x) if parts else np.zeros(0) for x in (zip(*parts, strict=True) if parts else ([], [], [])))
    return pa.table({"pid": a.astype(np.int64), "nbr": b.astype(np.int64), "sim": s.astype(np.float32)})


def _leaf_pairs(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        x, pid = _stacked(table["v"].combine_chunks(), "<f4"), table["pid"].to_numpy()
        parts = []
        for at in range(0, len(x), 512):  # a leaf is compared in blocks, so that memory stays small
            sims = x[at : at + 512] @ x.T
            sims[pid[at : at + 512, None] == pid[None, :]] = -2
            parts.append(_offers(pid[at : at + 512], pid, sims, np.full(len(sims), -2.0), cosine))
        return _offer_table(parts)

    return run


def _meeting(cosine: float):
    """The neighbours of one centre: pairs of which one is new to the centre, offered to both."""

    def run(table: pa.Table) -> pa.Table:
        x, pid = _stacked(table["v"].combine_chunks(), "<f4"), table["pid"].to_numpy()
        fresh, floor = table["fresh"].to_numpy(zero_copy_only=False), table["floor"].to_numpy()
        sims = x @ x.T
        sims[pid[:, None] == pid[None, :]] = -2
        sims[~(fresh[:, None] | fresh[None, :])] = -2
        return _offer_table([_offers(pid, pid, sims, floor, cosine)])

    return run


def _merged(rows: DataFrame, cosine: float) -> DataFrame:
    """``pid, nbr, sim, fresh`` -> a list per point: the best few, or twice its links if they fill it."""
    pairs = rows.groupBy("pid", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    lists = pairs.groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("sim", "nbr", "fresh")), asc=False).alias("all"))
    links = F.size(F.filter("all", lambda n: n["sim"] >= cosine - 1e-5))
    room = F.when(links >= NEIGHBOURS, 2 * links).otherwise(NEIGHBOURS)
    return lists.select(
        "pid", F.slice("all", F.lit(1), room).alias("list"), links.alias("links"),
        F.when(F.size("all") >= room, F.element_at("all", room)["sim"]).otherwise(-1.0).cast("float").alias("floor"),
    )


def _flat(graph: DataFrame) -> DataFrame:
    return graph.select("pid", F.explode("list").alias("n")).select("pid", "n.nbr", "n.sim", "n.fresh")


def _refined(graph: DataFrame, points: DataFrame, cosine: float, turn: int = 0) -> DataFrame:
    """One neighbours-of-neighbours join: the offers it makes. Large meetings are seated anew each turn."""
    edges = _flat(graph).select(F.col("pid").alias("centre"), F.col("nbr").alias("pid"), "fresh")
    both = edges.unionByName(edges.select(F.col("pid").alias("centre"), F.col("centre").alias("pid"), "fresh"))
    met = both.groupBy("centre", "pid").agg(F.max("fresh").alias("fresh"))
    stirred = met.groupBy("centre").agg(F.max("fresh").alias("any"), F.count("*").alias("n")).where("any")
    known = points.select("pid", "v").join(graph.select("pid", "floor"), "pid", "left")
    seated = (
        met.join(stirred.select("centre", "n"), "centre").join(known, "pid")
        .withColumn("seat", F.pmod(F.xxhash64("pid", F.lit(turn)), F.ceil(F.col("n") / MEETING)))
        .select("centre", "seat", "pid", "fresh", F.coalesce("floor", F.lit(-1.0).cast("float")).alias("floor"), "v")
    )
    return seated.groupBy("centre", "seat").applyInArrow(_meeting(cosine), "pid long, nbr long, sim float")


def _recall(graph: DataFrame, points: DataFrame, cosine: float, seed: int) -> tuple[float, int]:
    """Share of the true links of a bounded set of query points that the graph holds, and their number."""
    asked = points.orderBy(F.xxhash64("pid", F.lit(seed))).limit(AUDITED).select("pid", "v").collect()
    if not asked:
        return 1.0, 0
    ids = np.array([r["pid"] for r in asked])
    vectors = np.stack([np.frombuffer(r["v"], "<f4") for r in asked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = _stacked(batch.column("v"), "<f4") @ vectors.T if batch.num_rows else np.zeros((0, len(ids)))
            i, j = np.nonzero(sims >= cosine)
            other = batch.column("pid").to_numpy()[i]
            counts = np.bincount(j[other != ids[j]], minlength=len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)], ["pid", "n"])

    true = points.select("pid", "v").mapInArrow(run, "pid long, n long").agg(F.sum("n")).first()[0] or 0
    queries = points.sparkSession.createDataFrame([(int(i),) for i in ids], "pid long")
    found = (
        _flat(graph.join(F.broadcast(queries), "pid", "left_semi")).where(F.col("sim") >= cosine).count()
    )
    return (found / true if true else 1.0), true


def _recaptured(offers: DataFrame, graph: DataFrame, cosine: float) -> float:
    """Share of the links that new trees find by themselves which the graph holds already.

    Where links are too rare for queries to meet them, this tells how many are missing: trees
    drawn afresh find known and unknown links alike.
    """
    pair = [F.least("pid", "nbr").alias("a"), F.greatest("pid", "nbr").alias("b")]
    caught = offers.where(F.col("sim") >= cosine).select(*pair).distinct()
    held = _flat(graph).where(F.col("sim") >= cosine).select(*pair).distinct().withColumn("held", F.lit(True))
    n, known = caught.join(held, ["a", "b"], "left").agg(F.count("*"), F.count("held")).first()
    return known / n if n else 1.0


def _graph(points: DataFrame, cosine: float, recall: float) -> DataFrame:
    """Links (a, b) of single points found by NN-descent, as candidates in single precision."""
    points = written(points, "singles")
    total = points.count()
    sample = points.orderBy(F.xxhash64("pid", F.lit(3))).limit(SAMPLE).select("v").collect()
    empty = points.sparkSession.createDataFrame([], "pid long, nbr long, sim float, fresh boolean")
    if total < 2:
        return _merged(empty, cosine)
    vectors = np.stack([np.frombuffer(r["v"], "<f4") for r in sample]).astype(np.float64)
    leaf = max(2, LEAF * len(vectors) // total)

    def planted(first: int, count: int) -> DataFrame:
        trees = [(t, grow(vectors, leaf, t)) for t in range(first, first + count)]
        rows = points.select("pid", "v").mapInArrow(_leaves(trees), "tree int, leaf int, pid long, v binary")
        # a sample too small for the depth wanted leaves large leaves: those are dealt over groups
        seats = max(1, math.ceil(total * leaf / len(vectors) / (4 * LEAF)))
        rows = rows.withColumn("seat", F.pmod(F.xxhash64("pid", "tree"), F.lit(seats)))
        offers = rows.groupBy("tree", "leaf", "seat").applyInArrow(_leaf_pairs(cosine), "pid long, nbr long, sim float")
        return offers.withColumn("fresh", F.lit(True))

    graph = written(_merged(planted(0, TREES), cosine), "graph")
    links, trees, share = graph.agg(F.sum("links")).first()[0], TREES, 0.0
    for turn in range(ROUNDS):
        offers = _refined(graph, points, cosine, turn).withColumn("fresh", F.lit(True))
        old = _flat(graph).withColumn("fresh", F.lit(False))
        graph = written(_merged(old.unionByName(offers), cosine), "graph")
        now = graph.agg(F.sum("links")).first()[0]
        if now - links <= 0.001 * now:
            share, seen = _recall(graph, points, cosine, turn)
            if seen >= SEEN and share >= recall:
                return graph
            offers = written(planted(trees, TREES), "offers")
            trees += TREES
            if seen < SEEN:
                share = _recaptured(offers, graph, cosine)
            old = _flat(graph).withColumn("fresh", F.lit(False))
            graph = written(_merged(old.unionByName(offers), cosine), "graph")
            if seen < SEEN and share >= recall:
                return graph
            now = graph.agg(F.sum("links")).first()[0]
        links = now
    warnings.warn(f"the neighbour graph holds about {share:.3f} of the links, below {recall}; raise ROUNDS", stacklevel=2)
    return graph


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in single precision, which is what the search compares."""
    for batch in batches:
        small = [np.frombuffer(u, "<f8").astype("<f4").tobytes() for u in batch.column("unit").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("pid"), pa.array(small, pa.binary())], ["pid", "v"])


def _exact(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = (_stacked(batch.column("ua")) * _stacked(batch.column("ub"))).sum(axis=1)
            yield batch.select(["a", "b", "wa", "wb"]).filter(pa.array(cos >= cosine))

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Null, zero and empty vectors and those with null or non-finite components
    link with nothing: 0 links, a component of their own. Vectors of different
    lengths never link. Equal vectors, repeated rows included, link with each other as other
    rows; a null id takes part but names no component unless all are null. An empty table gives
    no rows; other columns are not read. Links are found by an approximate
    search whose audited recall is at least ``recall`` (a warning says so if ``ROUNDS`` are used
    up first) and verified in double precision; links within dense balls are exact.
    """
    plain = vectors.select("vec_id", "embedding")
    kind = plain.schema["vec_id"].dataType.simpleString()
    width = plain.agg(F.max(F.size("embedding"))).first()[0] or 1
    units = written(plain.mapInArrow(_units(max(width, 1)), f"vec_id {kind}, unit binary, dim int"), "units")
    classes = units.where("unit is not null").groupBy("unit", "dim").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("weight")
    )
    points = written(classes.withColumn("pid", F.monotonically_increasing_id()), "points")
    sample = points.orderBy(F.xxhash64("pid", F.lit(1))).limit(SAMPLE).select("unit", "dim").collect()
    known, dims = np.zeros((0, max(width, 1))), np.zeros(0, np.int32)
    if sample:
        known = np.stack([np.frombuffer(r["unit"], "<f8") for r in sample])
        dims = np.array([r["dim"] for r in sample], np.int32)
        chosen = leaders_of(known, dims, cosine)
        known, dims = known[chosen], dims[chosen]
    columns = f"unit binary, dim int, least {kind}, weight long, pid long, ball int, near array<int>"
    points = written(
        points.select("unit", "dim", "least", "weight", "pid").mapInArrow(_balls(known, dims, cosine), columns), "points"
    )

    # balls: their sizes, and the points near them block by block
    members = points.where("ball >= 0")
    balls = members.groupBy("ball").agg(
        F.sum("weight").alias("total"), F.count("*").alias("n"), F.min("pid").alias("head")
    )
    balls = written(balls, "balls")  # at most BALLS rows
    blocks = F.ceil(F.col("n") / BLOCK)
    of_ball = F.broadcast(balls.select("ball", blocks.alias("blocks")))
    dealt = members.join(of_ball, "ball").withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")))
    nearby = (
        points.where(F.size("near") > 0)
        .select(
            F.col("unit").alias("other_unit"), F.col("dim").alias("other_dim"), F.col("weight").alias("other_weight"),
            F.col("pid").alias("other"), (F.col("ball") < 0).alias("alone"), F.explode("near").alias("near_ball"),
        )
        .join(of_ball.select(F.col("ball").alias("near_ball"), "blocks"), "near_ball")
        .withColumn("near_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    )
    crossing = written(
        dealt.select("ball", "block", "unit", "dim", "weight", "pid").groupBy("ball", "block")
        .cogroup(nearby.groupBy("near_ball", "near_block"))
        .applyInArrow(_block_counts(cosine), "pid long, links long, ball int"),
        "crossing",
    )

    # single points: the graph's links, verified
    singles = points.where("ball < 0").select("pid", "unit").mapInArrow(_single, "pid long, v binary")
    graph = _graph(singles, cosine, recall)
    found = _flat(graph).where(F.col("sim") >= cosine - 1e-5)
    pairs = found.select(F.least("pid", "nbr").alias("a"), F.greatest("pid", "nbr").alias("b")).distinct()
    side = points.select("pid", "unit", "weight", "dim")
    left = side.select(F.col("pid").alias("a"), F.col("unit").alias("ua"), F.col("weight").alias("wa"), F.col("dim").alias("da"))
    right = side.select(F.col("pid").alias("b"), F.col("unit").alias("ub"), F.col("weight").alias("wb"), F.col("dim").alias("db"))
    links = written(
        pairs.join(left, "a").join(right, "b").where("da = db").select("a", "b", "wa", "wb", "ua", "ub")
        .mapInArrow(_exact(cosine), "a long, b long, wa long, wb long"),
        "links",
    )

    heads = F.broadcast(balls.select("ball", "head"))
    edges = (
        links.select("a", "b")
        .unionByName(members.join(heads, "ball").select(F.col("pid").alias("a"), F.col("head").alias("b")))
        .unionByName(crossing.join(heads, "ball").select(F.col("pid").alias("a"), F.col("head").alias("b")))
    )
    roots = components(edges)
    counts = (
        links.select(F.col("a").alias("pid"), F.col("wb").alias("links"))
        .unionByName(links.select(F.col("b").alias("pid"), F.col("wa").alias("links")))
        .unionByName(crossing.select("pid", "links"))
        .groupBy("pid").agg(F.sum("links").alias("links"))
    )
    told = (
        points.select("unit", "dim", "least", "weight", "pid", "ball")
        .join(F.broadcast(balls.select("ball", "total")), "ball", "left")
        .join(counts, "pid", "left")
        .join(roots.withColumnRenamed("node", "pid"), "pid", "left")
        .withColumn("root", F.coalesce("root", "pid"))
        .withColumn("n_links", F.coalesce("total", "weight") - 1 + F.coalesce("links", F.lit(0)))
    )
    told = written(told.select("unit", "dim", "least", "root", "n_links"), "told")
    named = told.groupBy("root").agg(F.min("least").alias("component_id"))
    by_unit = told.join(named, "root").select("unit", "dim", "n_links", "component_id")
    linked = units.where("unit is not null").join(by_unit, ["unit", "dim"]).select("vec_id", "n_links", "component_id")
    alone = units.where("unit is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
