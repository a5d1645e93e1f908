"""Near-equal lines across documents by a deletion-neighbourhood join.

A line is its words, A-Z lower-cased. Two lines are within the bound if one
insertion, deletion or substitution of a word turns one into the other. Every
candidate line emits the hash of itself and of each variant with one word left
out: equal variants at equal places are a substitution, a variant equal to a
whole line is an insertion. A line goes if an equal line or, from
``EDITED`` words on, a line within the bound stands earlier in the corpus.

Variants cost as many hashes as a line has words. One edit leaves one half of
a line untouched, so only lines that share a half with another distinct line
emit them: no pair is lost, and ordinary lines cost four keys. The texts of
the candidates are fetched by a second scan that looks each line up in a
bitmap of bounded size; what the bitmap lets through wrongly is joined away.
In the same way the variants' bare hashes are counted before rows are made of
those that occur twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.cluster import written
from wayfare.llm.common import WORD_BYTES, carry, sliced, unpacked

#: lines of fewer words are left alone; lines of fewer than EDITED words go only for equal lines
LEAST, EDITED = 4, 8
#: bits of the candidates' bitmap: 2 MB at most, whatever the number of candidates
BITMAP = 24


def words_in(line: str) -> list[bytes]:
    return WORD_BYTES.findall(line.encode().lower())


def _hash(words: list[bytes], salt: int = 0) -> int:
    value = xxhash.xxh64_intdigest(b" ".join(words), salt)
    return value - (1 << 64) if value >> 63 else value


def halves(words: list[bytes]) -> list[int]:
    """Keys of the halves: lines one edit apart share one of them.

    Lines of equal length compare as ``n``; the longer of two lines that differ in
    length compares as ``n - 1``, so each line has keys for both.
    """
    out = []
    for n in (len(words), len(words) - 1):
        first = n // 2
        out.append(_hash([b"<", str(n).encode(), *words[:first]]))
        out.append(_hash([b">", str(n).encode(), *words[len(words) - (n - first) :]]))
    return out


def one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Does at most one insertion, deletion or substitution of a word turn ``a`` into ``b``?"""
    if abs(len(a) - len(b)) > 1:
        return False
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    if len(a) == len(b):
        return a[same + 1 :] == b[same + 1 :]
    short, long = (a, b) if len(a) < len(b) else (b, a)
    return short[same:] == long[same + 1 :]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, key, text -> a row per line of at least LEAST words."""
    for batch in sliced(batches):
        at, line, n, h, keys = [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            for k, one in enumerate((text or "").split("\n")):
                words = words_in(one)
                if len(words) >= LEAST:
                    at.append(i)
                    line.append(k)
                    n.append(len(words))
                    h.append(_hash(words))
                    keys.append(halves(words) if len(words) >= EDITED else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(at, pa.int64())), batch.column("key").take(pa.array(at, pa.int64())),
             pa.array(line, pa.int32()), pa.array(h, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "key", "line", "h", "halves"],
        )


def _fetch(bitmap, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, seen = bitmap.value, set()
        for batch in sliced(batches):
            found = {}
            for text in batch.column("text").to_pylist():
                for one in (text or "").split("\n"):
                    words = words_in(one)
                    if len(words) < EDITED:
                        continue
                    h = _hash(words)
                    place = h & ((1 << bits) - 1)
                    if flags[place >> 3] >> (place & 7) & 1 and h not in seen:
                        found[h] = b" ".join(words).decode()
            # repeated lines of a task are sent once, as far as the set stays small
            seen = seen | found.keys() if len(seen) < 200_000 else set(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string())], ["h", "words"]
            )

    return run


def _bitmap(hashes: DataFrame, bits: int) -> bytes:
    """A bitmap of ``2 ** bits`` bits with the low bits of each hash set."""
    place = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        hashes.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        .collect()
    )
    # a bucket holds 32768 numbers and begins with number 1 + 32768 (bucket - 1)
    flat = np.zeros((1 << bits) + 2 * 32768, np.uint8)
    for r in rows:
        own = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
        first = 32768 * (r["bucket"] - 1) + 1
        at = np.flatnonzero(own) + first
        flat[at[at >= 0]] = 1
        if (at < 0).any():
            flat[0] = 1
    return np.packbits(flat[: 1 << bits], bitorder="little").tobytes()


def _cuts(words: list[bytes]) -> list[int]:
    """The hash of a line and of each variant with one word left out."""
    return [_hash(words), *(_hash(words[:k] + words[k + 1 :]) for k in range(len(words)))]


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """words -> the hashes of the line and its variants alone, each once a line."""
    for batch in sliced(batches):
        found = [np.unique(_cuts(t.encode().split(b" "))) for t in batch.column("words").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *found]))], ["h"])


def _variants(bitmap, bits: int):
    """h, words -> (v, i) of the variants that two lines may share: the hash without word i; i = -1 is the line itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(bitmap.value, np.uint8)
        for batch in sliced(batches):
            rows, v, i = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for r, text in enumerate(batch.column("words").to_pylist()):
                own = np.array(_cuts(text.encode().split(b" ")))
                place = own & ((1 << bits) - 1)
                kept = np.flatnonzero(flags[place >> 3] >> (place & 7) & 1)
                rows.append(np.full(len(kept), r))
                v.append(own[kept])
                i.append(kept - 1)
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v)), pa.array(np.concatenate(i).astype(np.int32)),
                 batch.column("h").take(at), batch.column("pos").take(at)],
                ["v", "i", "h", "pos"],
            )

    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        a, b = (batch.column(n).to_pylist() for n in ("words", "other"))
        ok = [one_edit(x.encode().split(b" "), y.encode().split(b" ")) for x, y in zip(a, b, strict=True)]
        yield batch.select(["h"]).filter(pa.array(ok, pa.bool_()))


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        texts, lines, gone = [], [], []
        for text, removed in zip(batch.column("_text").to_pylist(), batch.column("_removed").to_pylist(), strict=True):
            parts = text.split("\n") if text is not None else []
            lines.append(len(parts))
            gone.append(len(removed or ()))
            if removed:
                without = set(removed)
                text = "\n".join(t for i, t in enumerate(parts) if i not in without)
            texts.append(text)
        rest = [n for n in batch.schema.names if n not in ("_text", "_removed")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in rest), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())],
            [*rest, "_text", "_lines", "_gone"],
        )


def _near(reps: DataFrame, plain: DataFrame) -> DataFrame:
    """Hashes of the distinct lines that stand behind another line one edit away."""
    spark = plain.sparkSession
    keyed = reps.where(F.size("halves") > 0).select("h", F.explode("halves").alias("half"))
    shared = keyed.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    candidates = written(keyed.join(shared, "half", "left_semi").select("h").distinct(), "candidates")
    bitmap = spark.sparkContext.broadcast(_bitmap(candidates, BITMAP))
    texts = plain.select("text").mapInArrow(_fetch(bitmap, BITMAP), "h long, words string")
    texts = texts.join(candidates, "h", "left_semi").groupBy("h").agg(F.min("words").alias("words"))
    texts = written(texts.join(reps.select("h", "pos"), "h"), "candidate-lines")
    bitmap.destroy()
    kind = reps.schema["pos"].dataType.simpleString()
    # most variants belong to one line only: bare hashes are counted first, and rows that
    # say whose variant it is are made of those that lines share
    names = texts.select("words").mapInArrow(_names, "h long").groupBy("h").agg(F.count("*").alias("n"))
    common = spark.sparkContext.broadcast(_bitmap(written(names.where("n > 1").select("h"), "shared"), BITMAP))
    variants = written(
        texts.mapInArrow(_variants(common, BITMAP), f"v long, i int, h long, pos {kind}"), "variants"
    )
    common.destroy()
    cut, whole = variants.where("i >= 0"), variants.where("i < 0")
    # a substitution: of the lines that agree without their word i, the first is the witness
    first = cut.groupBy("v", "i").agg(F.min(F.struct("pos", "h")).alias("w"), F.count("*").alias("n")).where("n > 1")
    swapped = cut.join(first, ["v", "i"]).where(F.col("w.pos") < F.col("pos")).select("h", F.col("w.h").alias("witness"))
    # an insertion: a whole line equal to another's variant, whichever stands first
    lines = whole.select("v", F.col("pos").alias("whole_pos"), F.col("h").alias("whole_h"))
    longer = cut.join(lines, "v").where(F.col("whole_pos") < F.col("pos")).select("h", F.col("whole_h").alias("witness"))
    earliest = cut.groupBy("v").agg(F.min(F.struct("pos", "h")).alias("w"))
    shorter = lines.join(earliest, "v").where(F.col("w.pos") < F.col("whole_pos"))
    shorter = shorter.select(F.col("whole_h").alias("h"), F.col("w.h").alias("witness"))
    pairs = swapped.unionByName(longer).unionByName(shorter).distinct()
    words = texts.select("h", "words")
    both = pairs.join(words, "h").join(
        words.select(F.col("h").alias("witness"), F.col("words").alias("other")), "witness"
    )
    return both.select("h", "words", "other").mapInArrow(_verified, "h long").distinct()


def _removed(docs: DataFrame) -> DataFrame:
    """``_id, _key, _removed``: the numbers of the lines to remove of each document that has any."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = docs.select("doc_id", "text").withColumn("key", F.xxhash64("text"))
    lines = written(
        plain.mapInArrow(_lines, f"doc_id {kind}, key long, line int, h long, halves array<long>"), "lines"
    )
    reps = written(
        lines.groupBy("h").agg(F.min(F.struct("doc_id", "key", "line")).alias("pos"), F.min("halves").alias("halves")), "distinct-lines"
    )
    near = _near(reps, plain).withColumn("near", F.lit(True))
    verdict = reps.select("h", "pos").join(near, "h", "left")
    here = F.struct("doc_id", "key", "line")
    gone = lines.join(verdict, "h").where(F.col("near") | (F.col("pos") < here))
    return (
        gone.select("doc_id", "key", "line").distinct()
        .groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("line").alias("_removed"))
    )


def _rebuilt(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` in place of ``text``, ``_lines`` and ``_gone``."""
    removed = _removed(docs)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("_text") == F.col("_key"))
    rows = docs.withColumnRenamed("text", "_text").join(removed, same, "left").drop("_id", "_key")
    rest = [f for f in rows.schema if f.name not in ("_text", "_removed")]
    told = T.StructType(rest).add("_text", T.StringType()).add("_lines", T.LongType()).add("_gone", T.LongType())
    return rows.mapInArrow(_rebuild, told)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, text`` without its repeated lines, ``n_lines, n_removed``.

    Lines end at line breaks; "earlier" is by document id (null first), then
    text hash, then line. Blank lines and lines of fewer than ``LEAST`` words
    stay. Null texts stay null; a text may lose all its lines and stays as an
    empty text; rows that repeat an id and a text are treated alike, as one document;
    an empty table gives no rows; other columns are not read. Texts and lines of
    any length are compared whole.
    """
    rows = _rebuilt(docs.select("doc_id", "text"))
    return rows.select("doc_id", F.col("_text").alias("text"), F.col("_lines").alias("n_lines"), F.col("_gone").alias("n_removed"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with their repeated lines removed and ``n_chars`` counted anew; every row and column stays."""
    out = _rebuilt(carry(docs, "doc_id", "text", "n_chars")).withColumnRenamed("_text", "text").drop("_lines", "_gone")
    return unpacked(out.withColumn("n_chars", F.length("text").cast("long")), docs)
