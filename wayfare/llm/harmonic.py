"""Packing documents into token sequences by harmonic classes.

A piece of length l belongs to class ``j = capacity // l``: j such pieces always
fit a sequence, so a class fills its sequences by count alone and every task
fills its own. Documents are cut where that saves padding: whole sequences
first, then, as long as the rest would leave more than ``slack`` of its share
unused, a piece of exactly the next class's share.

What a task has left of a class (fewer than j pieces) is filled up with the
left-overs of other tasks in rounds of ``FAN`` tasks each; the few thousand
pieces of all classes that are left at the end share sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import sliced
from wayfare.llm.tokens import encoder, vocabulary

CAPACITY = 1024
SLACK = 1 / 32
#: the id that ends a document
END = 0
#: tasks whose left-overs meet in one group: at most FAN times the sum of all classes' j - 1 rows
FAN = 16

_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int"


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """The lengths of a document's pieces, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        fits = capacity // rest
        share = capacity // fits
        piece = rest if share - rest <= slack * share else capacity // (fits + 1)
        out.append(piece)
        rest -= piece
    return out


def _sequence(level: int, part: int, number: int) -> int:
    """Ids that no two groups of no two rounds share."""
    return (level << 58) | (part << 34) | number


class _Bins:
    """The open sequence of each class; rows are lists whose last three are sequence, offset, part."""

    def __init__(self, level: int, part: int, capacity: int):
        self.level, self.part, self.capacity = level, part, capacity
        self.open: dict[int, list[list]] = {}
        self.number = 0

    def _close(self, rows: list[list]) -> list[list]:
        sequence, offset = _sequence(self.level, self.part, self.number), 0
        self.number += 1
        for row in rows:
            row[-3], row[-2] = sequence, offset
            offset += row[_LENGTH]
        return rows

    def add(self, row: list) -> list[list]:
        """The rows of the sequence that ``row`` fills, if it does."""
        fits = self.capacity // row[_LENGTH]
        rows = self.open.setdefault(fits, [])
        rows.append(row)
        if len(rows) < fits:
            return []
        self.open[fits] = []
        return self._close(rows)

    def rest(self) -> list[list]:
        return [row for rows in self.open.values() for row in rows]

    def share(self) -> list[list]:
        """All that is left into common sequences, longest first, each where it first fits."""
        bins: list[list] = []
        for row in sorted(self.rest(), key=lambda r: -r[_LENGTH]):
            for one in bins:
                if one[0] >= row[_LENGTH]:
                    break
            else:
                one = [self.capacity, []]
                bins.append(one)
            one[0] -= row[_LENGTH]
            one[1].append(row)
        self.open = {}
        return [row for _, rows in bins for row in self._close(rows)]


_LENGTH = 2


def _pack(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), encoder(path).whole
        bins, schema = _Bins(0, part, capacity), None
        for batch in sliced(batches):
            schema = schema or pa.schema([batch.schema.field("doc_id"), *_ARROW])
            out: list[list] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = encode(text or "").astype("<u4").tobytes() + END.to_bytes(4, "little")
                total, start = len(data) // 4, 0
                for length in cut(total, capacity):
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    out += bins.add([doc, start, length, crc, total, None, None, part])
                    start += length
            yield _batch(out, schema)
        if schema is not None:
            yield _batch(bins.rest(), schema)

    return run


_ARROW = [
    *(pa.field(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
    pa.field("part", pa.int32()),
]


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _refill(level: int, last: bool, capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("part", "ascending")])
        group = table["part"][0].as_py() // FAN if table.num_rows else 0
        bins, out = _Bins(level, group, capacity), []
        for row in zip(*(c.to_pylist() for c in table.columns), strict=True):
            out += bins.add([*row[:-1], group])
        out += bins.share() if last else bins.rest()
        return pa.Table.from_batches([_batch(out, table.schema)])

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece of each document.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``. A document is its ids and then id 0; a null or empty text is the
    end id alone, so every row of ``docs`` has a piece, repeated rows and null
    ids included. Texts of any length are cut, never shortened. An empty table
    gives no rows; other columns are not read.

    Texts are tokenised in the scan and not shuffled; only the description of
    the left-over pieces is.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {_FIELDS}"
    run = _pack(path or vocabulary(), capacity)
    pieces = written(docs.select("doc_id", "text").mapInArrow(run, schema), "pieces")
    tables, left = [pieces], pieces.where("sequence_id is null")
    parts = (pieces.agg(F.max("part")).first()[0] or 0) + 1
    level, last = 0, False
    while not last:
        level, last = level + 1, parts <= FAN
        filled = left.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(_refill(level, last, capacity), schema)
        tables.append(written(filled, "pieces"))
        left = tables[-1].where("sequence_id is null")
        parts = -(-parts // FAN)
    out = None
    for one in tables:
        full = one.where("sequence_id is not null").drop("part")
        out = full if out is None else out.unionByName(full)
    return out
