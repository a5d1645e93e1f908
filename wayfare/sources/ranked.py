"""Ranked lists: attraction names per city, best first, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.ranking import row_number_within


def write_ranked(ranked: DataFrame, path: str) -> None:
    """Write the names of each city under ``city=...``, in rank order.

    Range partitions keep the order across files: read by file name, the lines
    of a city follow its ranks. The ranked table stays the canonical form.
    """
    (
        ranked.repartitionByRange("city", "rank")
        .sortWithinPartitions("city", "rank")
        .select("attraction", "city")
        .write.partitionBy("city")
        .text(path)
    )


def export_city(ranked: DataFrame, city: str, path: str) -> None:
    """Write one city's names as a single text file in rank order, without a last line break.

    The published form. Rows stream through the driver, a partition at a time.
    """
    spark = ranked.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = ranked.filter(F.col("city") == city).orderBy("rank").select("attraction").toLocalIterator()
    out = files.create(place, True)
    try:
        for i, row in enumerate(names):
            out.write(bytearray((("\n" if i else "") + row["attraction"]).encode()))
    finally:
        out.close()


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """Read the lists back and number the lines: ``(city, attraction, rank)``."""
    lines = spark.read.schema("value string, city string").text(path).select(
        "city",
        F.col("value").alias("attraction"),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    order = [F.asc("_file"), F.asc("_block"), F.asc("_line")]
    numbered = row_number_within(lines, ["city"], order, "rank")
    return numbered.select("city", "attraction", F.col("rank").cast("bigint").alias("rank"))


def read_city_file(spark: SparkSession, path: str, city: str) -> DataFrame:
    """Read one published list, a single text file of names."""
    lines = spark.read.text(path).select(
        F.lit(city).alias("city"),
        F.col("value").alias("attraction"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    numbered = row_number_within(lines, ["city"], [F.asc("_block"), F.asc("_line")], "rank")
    return numbered.select("city", "attraction", F.col("rank").cast("bigint").alias("rank"))
