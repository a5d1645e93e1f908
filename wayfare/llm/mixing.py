"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks.

Target sizes fill up sources in proportion to their weights and stop at a
multiple of what a source has. The mix is a number of equal blocks of words; the
blocks go to the sources by highest quotients ``target / (2 s + 1)``, and a
source's blocks to its shards in the same way. A shard's documents stand in
seeded hash order as one stream of blocks, of which a seeded run of the quota's
length is taken, as often round as needed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import CARRIED, WORD_BYTES, carry, join_small, sliced, unpacked, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
TIMES = 2
BLOCK = 32
SEED = 11
#: words and rows of a shard, the unit that one task sorts
SHARD_WORDS, SHARD_ROWS = 1 << 20, 1 << 16


def sainte_lague(weights: np.ndarray, seats: int) -> np.ndarray:
    """Integer seats by highest quotients ``w / (2 s + 1)``; ties go to the earlier party.

    Seats whose quotient lies above a bisected divisor are counted at once, the
    few others awarded singly, so any number of seats takes the same time.
    """
    weights = np.asarray(weights, float)
    out = np.zeros(len(weights), np.int64)
    if seats <= 0 or not (weights > 0).any():
        return out
    count = lambda d: np.floor(weights / d + 0.5).astype(np.int64)
    low, high = weights.max() / (seats + 1.0) / 4, weights.sum() * 2.0 + 1
    for _ in range(200):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        low, high = (low, middle) if count(middle).sum() <= seats else (middle, high)
    out = count(high)
    queue = [(-w / (2 * s + 1), i) for i, (w, s) in enumerate(zip(weights, out, strict=True)) if w > 0]
    heapq.heapify(queue)
    for _ in range(seats - int(out.sum())):
        _, i = queue[0]
        out[i] += 1
        heapq.heapreplace(queue, (-weights[i] / (2 * out[i] + 1), i))
    return out


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, rows`` -> the same with ``target``.

    Sources in code point order, null last, weigh 3, 1, 2 and so on. The level
    at which sources fill up is a running sum over the sources, sorted by the
    level at which each is full: the limit of resharing the excess by weight.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size") * TIMES
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    spent = F.coalesce(F.sum("_cap").over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) * SHARE - spent) / F.sum("_weight").over(onward)
    fits = F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.struct("_place", "_level"))
    return (
        sizes.withColumn("_weight", weight).withColumn("_cap", cap)
        .withColumn("_level", level).withColumn("_place", F.row_number().over(order))
        .withColumn("_at", F.min(fits).over(everything)["_level"])
        .withColumn("target", F.coalesce(F.least(F.col("_cap").cast("double"), F.col("_at") * F.col("_weight")), F.col("_cap").cast("double")))
        .drop("_weight", "_cap", "_level", "_place", "_at")
    )


def _award(size: str, order: str):
    """A group's ``seats`` (one value) in proportion to ``size``, as column ``quota``."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable")
        return frame.assign(quota=sainte_lague(frame[size].to_numpy(float), int(frame["seats"].iloc[0])))

    return run


def _overlap(first, last):
    """Words that a document shares with the words ``first`` to ``last`` of its stream."""
    return F.greatest(F.lit(0), F.least(F.col("_at") + F.col("_size"), last) - F.greatest(F.col("_at"), first))


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with what the mix takes of each row.

    Adds ``_size``, ``_source_size``, ``_target``, ``_times`` (how often the
    whole row is taken) and the words taken once more: ``_head`` words in the
    run of blocks that begins at the seeded block, starting ``_head_at`` words
    into the row, and ``_tail`` words from the row's first on, where that
    run has gone round.
    """
    sized = docs.withColumn("_size", word_count(F.col("text")))
    sources = targets(
        sized.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("rows"))
    )
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    seats = F.round(F.sum("target").over(everything) / BLOCK).cast("long")
    shards = F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.ceil(F.col("rows") / SHARD_ROWS), F.lit(1))
    kind = docs.schema["source"].dataType.simpleString()
    awarded = (
        sources.withColumn("place", place).withColumn("seats", seats)
        .select("source", "source_size", "target", "place", "seats", shards.cast("long").alias("shards"))
        .groupBy(F.lit("all")).applyInPandas(
            _award("target", "place"),
            f"source {kind}, source_size long, target double, place int, seats long, shards long, quota long",
        )
        .select(
            F.col("source").alias("_source"), F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"), F.col("place").alias("_place"),
            F.col("shards").alias("_shards"), F.col("quota").alias("_quota"),
        )
    )
    known = join_small(sized.withColumn("_source", F.col("source")), awarded, "_source")
    known = known.withColumn("_hash", F.xxhash64("doc_id", F.lit(SEED))).withColumn(
        "_shard", F.pmod(F.col("_hash"), F.col("_shards"))
    )
    ring = F.ceil(F.col("words") / BLOCK).cast("long")
    quota = F.least(F.col("quota"), ring * TIMES)
    some = lambda column: F.when(ring > 0, column).otherwise(0).cast("long")
    inside = (
        known.groupBy("_place", "_shard")
        .agg(F.sum("_size").alias("words"), F.first("_quota").alias("seats"))
        .groupBy("_place").applyInPandas(
            _award("words", "_shard"), "_place int, _shard long, words long, seats long, quota long"
        )
        .select(
            "_place", "_shard", (ring * BLOCK).alias("_ring"),
            some(F.floor(quota / ring)).alias("_times"), some(quota % ring * BLOCK).alias("_run"),
            some(F.pmod(F.xxhash64("_place", "_shard", F.lit(SEED)), ring) * BLOCK).alias("_from"),
        )
    )
    stream = Window.partitionBy("_place", "_shard").orderBy("_hash", "doc_id", "_size")
    at = F.sum("_size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    end = F.col("_from") + F.col("_run")
    return (
        known.withColumn("_at", at).join(inside, ["_place", "_shard"])
        .withColumn("_head", _overlap(F.col("_from"), F.least(end, F.col("_ring"))))
        .withColumn("_head_at", F.greatest(F.lit(0), F.col("_from") - F.col("_at")))
        .withColumn("_tail", _overlap(F.lit(0), end - F.col("_ring")))
        .drop("_place", "_shard", "_shards", "_quota", "_hash", "_at", "_ring", "_run", "_from", "_source")
    )


def mix(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document.

    Returns ``doc_id, size, source_size, target, taken``. Null texts have no
    words and nothing is taken of them; a null source is a source, the last; a
    source without words has target 0; null ids and repeated rows are rows like
    others; an empty table gives no rows; other columns are not read. A source's
    taken words differ from its target by a block for the source and for
    each of its shards at most.
    """
    rows = _placed(docs.select("doc_id", "text", "source"))
    taken = F.col("_times") * F.col("_size") + F.col("_head") + F.col("_tail")
    return rows.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), taken.cast("long").alias("taken"),
    )


def slice_words(text: str, first: int, count: int) -> str:
    """``count`` words of ``text`` from word ``first`` on, with the white space between them."""
    data = text.encode()
    spans = [m.span() for m in WORD_BYTES.finditer(data)][first : first + count]
    return data[spans[0][0] : spans[-1][1]].decode() if spans else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        work = {n: batch.column(n).to_pylist() for n in ("text", "_size", "_times", "_head", "_head_at", "_tail")}
        texts = []
        for text, size, times, head, head_at, tail in zip(*work.values(), strict=True):
            parts = [text] * times
            if head == size:
                parts.append(text)
            else:
                parts += [slice_words(text, a, n) for a, n in ((0, tail), (head_at, head)) if n]
            texts.append("\n".join(parts))
        columns = {n: batch.column(n) for n in batch.schema.names if n not in work}
        columns |= {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
        yield pa.RecordBatch.from_pydict(columns)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: ``docs`` with each text as often, and as far, as it is taken.

    A row stays one row: repeats follow each other after a line break, a part
    taken keeps its white space, ``n_chars`` is counted anew. Rows of which
    nothing is taken are left out; rows without words belong to no block and stay as they are.
    """
    narrow = carry(docs, "doc_id", "text", "source", "n_chars")
    rows = _placed(narrow)
    taken = F.col("_times") * F.col("_size") + F.col("_head") + F.col("_tail")
    names = ["doc_id", "source", CARRIED]
    work = rows.where(taken > 0).select(
        *(F.col(f"`{c}`") for c in names), "text", "_size", "_times", "_head", "_head_at", "_tail"
    )
    schema = T.StructType([narrow.schema[c] for c in names]).add("text", T.StringType()).add("n_chars", T.LongType())
    told = unpacked(work.mapInArrow(_texts, schema), docs)
    return told.unionByName(unpacked(rows.where(F.col("_size") == 0), docs))
