"""What several operators of this folder share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.cluster import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a word, as Java and as Python (on UTF-8 bytes) read it
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: texts as Python objects take several times their size.

    Workers are reused by later tasks, so what an earlier one left free goes back to the system first.
    """
    pa.default_memory_pool().release_unused()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words: word beginnings are what is left once all else is taken out."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, root)`` per linked node.

    ``root`` is the least node reachable. Alternates large-star and small-star:
    each node's neighbours are linked to the least of them, which keeps
    the components and settles, after logarithmically many rounds, in stars
    around the least nodes. A round is one aggregation with partial minima and
    one join on the node, which adaptive execution splits if a node is hot; its
    result is a written table. Null nodes and loops are ignored.
    """
    now = written(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a"))
        large = written(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(F.col("b") != F.col("m"))
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(least.withColumnRenamed("m", "b").unionByName(moved).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle; raise rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


#: holds the columns an operator does not work on
CARRIED = "carried columns"


def carry(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` as the columns an operator works on and one of all others, whose names cannot clash with its helpers."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*(c for c in needed if c in docs.columns), (F.struct(*rest) if rest else F.lit(None).cast("string")).alias(CARRIED))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    kind = rows.schema[CARRIED].dataType
    held = kind.fieldNames() if isinstance(kind, T.StructType) else []
    return rows.select(*(F.col(f"`{CARRIED}`.`{c}`" if c in held else f"`{c}`") for c in docs.columns))


def join_small(df: DataFrame, small: DataFrame, key: str, bound: int = 10_000) -> DataFrame:
    """Left join on one key, null keys included; ``small`` has a row per key.

    ``small`` is written and counted: up to ``bound`` rows are broadcast, more
    are joined by a shuffle, whose hot keys adaptive execution splits.
    """
    side = written(small, "lookup")
    renamed = side.withColumnRenamed(key, "_key")
    if side.count() <= bound:
        renamed = F.broadcast(renamed)
    return df.join(renamed, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
