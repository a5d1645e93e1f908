"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every task of the scan sends each owner of a hash range its distinct
fingerprints there, sorted and Rice-coded (Golomb codes of a power of two): a
few bytes a document less than the hash itself and one row a task and owner.
The owner answers with one bit a fingerprint: seen by another task too or
not. Only documents whose bit is set, or that repeat within a task, are
suspects; their texts alone are shuffled and compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import lower_ascii, sliced, tasks

def rice_bits(values: np.ndarray) -> int:
    """The remainder bits that suit the mean gap of sorted ``values``."""
    if len(values) == 0:
        return 0
    mean = (int(values[-1]) - int(values[0])) // len(values) + 1
    return min(56, max(0, mean.bit_length() - 1))


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned 64-bit ``values`` as bytes.

    Layout: count and remainder bits, first value, the unary quotients of the
    gaps as one bit string, then the remainders as another.
    """
    values = np.asarray(values, np.uint64)
    n, k = len(values), rice_bits(values)
    head = np.array([n, k, values[0] if n else 0], np.uint64).tobytes()
    if n < 2:
        return head
    gaps = np.diff(values)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    out = [head, np.uint64(len(unary)).tobytes(), np.packbits(unary).tobytes()]
    if k:
        low = (gaps & np.uint64((1 << k) - 1))[:, None] >> np.arange(k, dtype=np.uint64)[None, :]
        out.append(np.packbits((low & np.uint64(1)).astype(np.uint8).ravel()).tobytes())
    return b"".join(out)


def rice_decode(data: bytes) -> np.ndarray:
    """The values that ``rice_encode`` wrote."""
    n, k, first = (int(x) for x in np.frombuffer(data[:24], np.uint64))
    if n < 2:
        return np.full(n, first, np.uint64)
    length = int(np.frombuffer(data[24:32], np.uint64)[0])
    end = 32 + (length + 7) // 8
    unary = np.unpackbits(np.frombuffer(data[32:end], np.uint8), count=length)
    quotients = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(data[end:], np.uint8), count=(n - 1) * k).reshape(n - 1, k)
        gaps |= bits.astype(np.uint64) @ (np.uint64(1) << np.arange(k, dtype=np.uint64))
    return np.uint64(first) + np.concatenate([np.zeros(1, np.uint64), np.cumsum(gaps, dtype=np.uint64)])


#: bits of the bitmap of suspects
BITMAP = 1 << 24

_ROW = pa.schema(
    [("sha", pa.binary()), ("part", pa.int32()), ("row", pa.int64()), ("owner", pa.int32()), ("codes", pa.binary()), ("bits", pa.binary())]
)
_ROW_SQL = "sha binary, part int, row long, owner int, codes binary, bits binary"


def _scan(owners: int):
    """doc_id, text -> a digest row per document, then the task's messages to the owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, seen, kind = TaskContext.get().partitionId(), 0, [], None
        for batch in sliced(batches):
            texts, kind = batch.column("text").to_pylist(), batch.schema.field("doc_id")
            shas = [hashlib.sha256(b"" if t is None else t.encode().lower()).digest() for t in texts]
            n = len(texts)
            own = pa.array(shas, pa.binary())
            seen.append(_hashes(own))
            blank = [pa.nulls(n, f.type) for f in list(_ROW)[3:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), own, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), *blank],
                ["doc_id", *_ROW.names],
            )
            row += n
        if not row:
            return
        values, counts = np.unique(np.concatenate(seen), return_counts=True)
        cuts = np.searchsorted(_owner(values, owners), np.arange(owners + 1, dtype=np.uint64))
        spans = [(int(o), slice(cuts[o], cuts[o + 1])) for o in np.flatnonzero(np.diff(cuts))]
        yield pa.RecordBatch.from_pylist(
            [
                {"doc_id": None, "part": part, "owner": o, "codes": rice_encode(values[at]), "bits": np.packbits(counts[at] > 1).tobytes()}
                for o, at in spans
            ],
            schema=pa.schema([kind, *_ROW]),
        )

    return run


def _hashes(column: pa.Array) -> np.ndarray:
    """The first eight bytes of each digest as an unsigned number."""
    joined = b"".join(x[:8] for x in column.to_pylist())
    return np.frombuffer(joined, ">u8").astype(np.uint64)


def _owner(hashes: np.ndarray, owners: int) -> np.ndarray:
    """Owners hold equal ranges of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


_MESSAGE = pa.schema([("owner", pa.int32()), ("part", pa.int32()), ("codes", pa.binary()), ("bits", pa.binary())])
_MESSAGE_SQL = "owner int, part int, codes binary, bits binary"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner: the same messages, with a bit set for each hash that any two rows share."""
    messages: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            messages.setdefault(row["owner"], []).append(row)
    for rows in messages.values():
        decoded = [rice_decode(r["codes"]) for r in rows]
        values, counts = np.unique(np.concatenate(decoded), return_counts=True)
        shared = values[counts > 1]
        for r, own in zip(rows, decoded, strict=True):
            local = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=len(own)).astype(bool)
            r["bits"] = np.packbits(local | np.isin(own, shared, assume_unique=True)).tobytes()
        yield pa.RecordBatch.from_pylist(rows, schema=_MESSAGE)


def _marked(digests: pa.Table, answers: pa.Table) -> pa.Table:
    """One task's digests next to its answers: the suspects among them."""
    found = [np.zeros(0, np.uint64)]
    for codes, bits in zip(answers["codes"].to_pylist(), answers["bits"].to_pylist(), strict=True):
        values = rice_decode(codes)
        found.append(values[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(values)).astype(bool)])
    hit = np.isin(_hashes(digests["sha"]), np.concatenate(found))
    return digests.filter(pa.array(hit)).select(["doc_id", "sha", "part", "row"])


def _possible(named: DataFrame, suspects: DataFrame) -> DataFrame:
    """The rows of ``named`` whose digest may be a suspect's: others leave before any text is shuffled.

    A bitmap of the suspects' hashes, as a table of words of 64 bits: at most ``BITMAP / 64`` rows
    however many suspects there are, so its broadcast is bounded. What it lets
    through by chance is joined away, so it decides nothing.
    """
    spot = lambda sha: F.pmod(F.xxhash64(sha), F.lit(BITMAP))
    bit = F.expr("shiftleft(1L, cast(_spot % 64 as int))")
    words = suspects.select(spot("_sha").alias("_spot")).select(F.floor(F.col("_spot") / 64).alias("_word"), bit.alias("_bit"))
    words = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    spotted = named.withColumn("_spot", spot("sha")).withColumn("_at", F.floor(F.col("_spot") / 64))
    met = spotted.join(F.broadcast(words), F.col("_at") == F.col("_word"))
    return met.where(F.col("_bits").bitwiseAND(bit) != 0).select(*named.columns)


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document with the class of its text, equal up to the case of A-Z.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. Of equal texts
    the row with the largest ``doc_id`` stays; a null id is the smallest. Null
    texts count as empty, and the empty text is a text like others. Of
    repeated rows (one id, one text) the first in file order stays, so
    ``kept`` marks one row of each group. An empty table gives no rows; other
    columns are not read.

    The digests are written once; later steps read them, not the texts. Each
    step groups by task or by hash range, so a text that fills a third of
    the table is one code in every message and one partial group in every task.
    """
    owners = tasks(docs.sparkSession)
    plain = docs.select("doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    scanned = written(plain.mapInArrow(_scan(owners), f"doc_id {kind}, {_ROW_SQL}"), "digests")
    digests = scanned.where("owner is null").select("doc_id", "sha", "part", "row")
    sent = scanned.where("owner is not null").select("owner", "part", "codes", "bits")
    answers = sent.repartition(owners, "owner").mapInArrow(_answer, _MESSAGE_SQL)
    suspects = written(
        digests.groupBy("part").cogroup(answers.groupBy("part"))
        .applyInArrow(_marked, f"doc_id {kind}, sha binary, part int, row long")
        .groupBy("doc_id", "sha").agg(F.min(F.struct("part", "row")).alias("at"))
        .select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"), "at"),
        "suspects",
    )
    # byte verification: the suspects' texts themselves are the grouping key
    named = plain.select(
        "doc_id", lower_ascii(F.coalesce(F.col("text"), F.lit(""))).alias("text")
    ).withColumn("sha", F.unhex(F.sha2("text", 256)))
    named = _possible(named, suspects)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))
    groups = (
        named.join(suspects, same).groupBy("sha", "text")
        .agg(F.max(F.struct("doc_id", "at")).alias("keep"), F.count("*").alias("n"))
        .groupBy("sha").agg(F.max("keep").alias("keep"), F.max("n").alias("n"), F.count("*").alias("texts"))
    )
    # two texts with one SHA-256 would be two groups here: stop rather than merge them
    clash = F.raise_error(F.lit("different texts share a SHA-256")).cast("bigint")
    groups = groups.select("sha", "keep", F.when(F.col("texts") == 1, F.col("n")).otherwise(clash).alias("n"))
    alone = F.col("keep").isNull()
    return digests.join(groups, "sha", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.struct("part", "row") == F.col("keep.at")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
