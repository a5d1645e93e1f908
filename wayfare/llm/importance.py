"""Importance resampling towards a target corpus.

Documents and target texts are reduced to counts of hashed features (runs of one
and two words). A bucket's gain says how much more frequent it is in the
target, and a document's weight is the mean gain of its features, scored as one
look-up of its bucket numbers in the array of gains. Perturbed by Gumbel noise of
its id, the largest scores are a sample without replacement.

The cutoff among the scores is found by weighted median-of-medians selection:
every partition reports the median of its remaining keys and how many remain,
the median of these medians weighted by those counts is the next pivot, and one
count tells which side of it keeps the cutoff. At least a quarter of the remaining
keys goes in each round, whatever the order and sizes of the partitions. Nothing
is sorted but the winners.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import sliced, tasks

#: number of feature buckets, and the longest run of words that is a feature
BUCKETS, RUN = 10_000, 2
#: documents with fewer words are not drawn; the share of the others that is
LEAST_WORDS, PERCENT = 20, 25
SEED = 7
#: once so few keys remain they are selected in the driver
LAST_KEYS = 4096

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bucket_ids(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every feature: words, then pairs of neighbours."""
    words = [w.encode() for w in _WORD.findall((text or "").encode().lower().decode())]
    crc = zlib.crc32
    single = [crc(w) for w in words]
    double = [crc(w, crc(b" ", before)) for before, w in zip(single, words[1:])]
    return len(words), (np.array(single + double, np.uint32) % BUCKETS).astype(np.uint16)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts -> one row with its count of each bucket."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in sliced(batches):
        for text in batch.column("text").to_pylist():
            total += np.bincount(bucket_ids(text)[1], minlength=BUCKETS)
    if total.any():
        yield pa.RecordBatch.from_pydict({"counts": [total.tobytes()]})


def _encoded() -> Callable:
    """doc_id, text -> the same row as numbers, then the task's bucket counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, row, kind = np.zeros(BUCKETS, np.int64), TaskContext.get().partitionId() << 33, None
        for batch in sliced(batches):
            kind, n = batch.schema.field("doc_id").type, batch.num_rows
            found = [bucket_ids(text) for text in batch.column("text").to_pylist()]
            for _, ids in found:
                total += np.bincount(ids, minlength=BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.arange(row, row + n)),
                    pa.array([words for words, _ in found], pa.int64()),
                    pa.array([ids.tobytes() for _, ids in found], pa.binary()), pa.nulls(n, pa.binary()),
                ],
                ["doc_id", "row", "n_words", "ids", "counts"],
            )
            row += n
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), *(pa.nulls(1, pa.int64()) for _ in range(2)), pa.nulls(1, pa.binary()), pa.array([total.tobytes()])],
                ["doc_id", "row", "n_words", "ids", "counts"],
            )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for counts in batch.column("counts").to_pylist():
            total += np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_pydict({"counts": [total.tobytes()]})


def _total(counts: DataFrame) -> np.ndarray:
    """The sum of the tasks' arrays: in groups of tasks first, so that few rows reach the driver."""
    groups = max(1, math.isqrt(tasks(counts.sparkSession)))
    parts = counts.repartition(groups).mapInArrow(_summed, "counts binary").collect()
    return sum((np.frombuffer(r.counts, np.int64) for r in parts), np.zeros(BUCKETS, np.int64))


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored."""
    s_all, t_all = int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id, seed: int = SEED) -> int:
    """Thousandths of a Gumbel draw from a hash of the id; a null id counts as empty text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    uniform = (int(hashlib.sha256(name.encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
    return math.floor(-1000 * math.log(-math.log(uniform)))


def _scored(gains: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            arrays = [np.frombuffer(x, np.uint16) for x in batch.column("ids").to_pylist()]
            weights = [int(gains[a].sum()) // len(a) if len(a) else 0 for a in arrays]
            scores = [w + noise(d, seed) for w, d in zip(weights, batch.column("doc_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), batch.column("n_words"),
                    pa.array([len(a) for a in arrays], pa.int64()), pa.array(weights, pa.int64()), pa.array(scores, pa.int64()),
                ],
                ["doc_id", "row", "n_words", "n_features", "weight", "score"],
            )

    return run


#: A key: the larger score first, then the smaller id (null last), then the row. Keys ascend, so scores are negated.
_KEY = ("down", "no_id", "id", "row")


def _keys(scored: DataFrame) -> DataFrame:
    return scored.select(
        (-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("long").alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), "row",
    )


def _compare(key: tuple, inclusive: bool) -> Column:
    """Whether a row's key is below ``key``, or equal to it if ``inclusive``."""
    out = F.lit(inclusive)
    for name, value in reversed(list(zip(_KEY, key, strict=True))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's keys -> its lower median and their number."""
    parts = [np.stack([batch.column(c).to_numpy() for c in _KEY]) for batch in batches if batch.num_rows]
    if parts:
        keys = np.concatenate(parts, axis=1)
        middle = keys[:, np.lexsort(keys[::-1])[(keys.shape[1] - 1) // 2]]
        yield pa.RecordBatch.from_pydict(
            {**{c: pa.array([int(v)], pa.int64()) for c, v in zip(_KEY, middle, strict=True)}, "n": pa.array([keys.shape[1]], pa.int64())}
        )


_MEDIANS_SQL = "down long, no_id long, id long, row long, n long"


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The first key at which half of the weight is reached."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff_key(keys: DataFrame, wanted: int, total: int, last: int = LAST_KEYS) -> tuple:
    """The ``wanted``-th smallest of ``total`` distinct keys, by weighted median-of-medians.

    A pivot has at least a quarter of the remaining keys on either side of it
    (it included), so the rounds grow with the logarithm of the keys. The driver sees one key
    and one count a partition; the last ``last`` keys it sorts itself.
    """
    remaining, count, place = keys, total, wanted
    low = high = None
    while count > last:
        medians = [(tuple(r[c] for c in _KEY), r.n) for r in remaining.mapInArrow(_medians, _MEDIANS_SQL).collect()]
        pivot = weighted_median(medians)
        below = remaining.where(_compare(pivot, True)).count()
        if place == below:
            return pivot
        if place < below:
            high, count = pivot, below - 1
        else:
            low, count, place = pivot, count - below, place - below
        remaining = keys
        if low is not None:
            remaining = remaining.where(~_compare(low, True))
        if high is not None:
            remaining = remaining.where(_compare(high, False))
    return sorted(tuple(r[c] for c in _KEY) for r in remaining.collect())[place - 1]


def _ranked(winners: DataFrame) -> DataFrame:
    """Number rows in key order: ranges of keys side by side, each shifted by the counts before it."""
    order = [F.col(c) for c in _KEY]
    dealt = written(winners.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "winners")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    # one row a range: its size is that of the shuffle, not of the data
    shifts = shifts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.join(F.broadcast(shifts), "part").select("row", (place + F.col("shift")).cast("long").alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """Score ``docs(doc_id, text)`` for likeness to ``target(text)`` and draw the best ``percent``.

    Returns ``doc_id, n_features, weight, score, rank`` for every document; ``rank`` is null for
    those not drawn. Drawn are the highest scores among documents of
    ``least_words`` words or more, ties to the smaller id, a null id last; of repeated rows (one id, equal
    scores) the first in file order. A null text is empty: no features, weight 0, never
    drawn unless ``least_words`` is 0. An empty table gives no rows and an empty target is a target
    of no counts. Ids are integers; other columns are not read.

    Texts are read once: their bucket numbers are written, two bytes a
    feature, and the sums of all tasks make the gains.
    """
    plain = docs.select("doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    encoded = written(
        plain.mapInArrow(_encoded(), f"doc_id {kind}, row long, n_words long, ids binary, counts binary"), "features"
    )
    source = _total(encoded.where("counts is not null").select("counts"))
    gains = bucket_gains(source, _total(target.select("text").mapInArrow(_counted, "counts binary")))
    rows = encoded.where("counts is null").select("doc_id", "row", "n_words", "ids")
    scored = written(
        rows.mapInArrow(_scored(gains, seed), f"doc_id {kind}, row long, n_words long, n_features long, weight long, score long"),
        "scores",
    )
    eligible = scored.where(F.col("n_words") >= least_words)
    total = eligible.count()
    wanted = total * percent // 100
    result = scored.select("doc_id", "row", "n_features", "weight", "score")
    if not wanted:
        return result.drop("row").withColumn("rank", F.lit(None).cast("long"))
    keys = _keys(eligible)
    cut = cutoff_key(keys, wanted, total)
    ranks = _ranked(keys.where(_compare(cut, True)))
    return result.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
