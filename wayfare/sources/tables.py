"""Landed tables: partitioned reviews and CSV records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.strings import empty_if_missing
from wayfare.sources.lines import REVIEWS, one_line

#: quotes are doubled and blanks kept, as common CSV writers do
_CSV = {
    "quote": '"',
    "escape": '"',
    "header": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def land_reviews(
    reviews: DataFrame, path: str, mode: str = "errorifexists", by_attraction: bool = False
) -> None:
    """Write reviews as Parquet under ``city=...``, in the order of attraction and id.

    A scan for one city reads only its folders; bounds on attraction or id skip
    files and row groups. ``by_attraction`` adds a folder level per
    attraction, for corpora of few attractions: millions of folders would cost more
    than they save. See ``write_lines`` for the way large groups are split.
    """
    columns = [field.name for field in REVIEWS]
    folders = ["city", "attraction"] if by_attraction else ["city"]
    (
        reviews.select(columns)
        .hint("rebalance", "city", "attraction")
        .sortWithinPartitions("city", "attraction", "review_id")
        .write.mode(mode)
        .partitionBy(*folders)
        .parquet(path)
    )


def landed_reviews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEWS).parquet(path)


def land_again(reviews: DataFrame, path: str) -> DataFrame:
    """Land the cities of ``reviews`` in place of what ``path`` has of them; other cities' files stay.

    For a collection that comes city by city: the first call lands, a later one
    replaces the folders of its own cities alone (a city without reviews in it
    keeps what it has). Returns the manifest's new rows; see ``landing_manifest``.
    The rows go out first and the manifest after them, so a job that fails in between is repeated whole.
    """
    spark = reviews.sparkSession
    (
        reviews.select([field.name for field in REVIEWS])
        .hint("rebalance", "city", "attraction")
        .sortWithinPartitions("city", "attraction", "review_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("city")
        .parquet(path)
    )
    before = landing_manifest(spark, path, latest=False)
    known = before.groupBy("city").agg(F.max("landing").alias("landing"), F.max_by("files", "landing").alias("old"))
    # what lies there now; folders whose files are listed already were not written
    held = landed_reviews(spark, path).groupBy("city").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set(F.col("_metadata.file_name"))).alias("files")
    )
    number = F.lit((before.agg(F.max("landing")).first()[0] or 0) + 1)
    fresh = held.join(known, held["city"].eqNullSafe(known["city"]), "left").where("old is null or old <> files")
    fresh = fresh.select(held["city"], number.alias("landing"), "n", "files")
    fresh.coalesce(1).write.mode("append").parquet(f"{path}/{_MANIFEST}")
    return landing_manifest(spark, path, latest=False).where(F.col("landing") == number)


#: beside the folders of the cities; readers of the table pass over names with an underscore
_MANIFEST = "_manifest"


def landing_manifest(spark: SparkSession, path: str, latest: bool = True) -> DataFrame:
    """``(city, landing, n, files)``: what ``land_again`` wrote for each city, and in which call.

    ``latest`` gives the row that holds now, otherwise all. A row a city and landing.
    """
    schema = "city string, landing int, n long, files array<string>"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{_MANIFEST}")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{path}/{_MANIFEST}")
    if not latest:
        return rows
    newest = rows.groupBy("city").agg(F.max_by(F.struct("landing", "n", "files"), "landing").alias("row"))
    return newest.select("city", "row.*")


def write_csv(
    records: DataFrame,
    path: str,
    headers: Sequence[str],
    mode: str = "errorifexists",
    one_per_line: bool = True,
) -> None:
    """Write the chosen columns as CSV without a header row, one record a line.

    Line breaks inside fields become blanks, so that readers can split the
    files; ``one_per_line=False`` keeps them, for ``read_csv(multi_line=True)``.
    """
    text = one_line if one_per_line else empty_if_missing
    filled = [text(F.col(name).cast("string")).alias(name) for name in headers]
    records.select(filled).write.mode(mode).options(**_CSV, emptyValue="").csv(path)


def read_csv(spark: SparkSession, path: str, headers: Sequence[str], multi_line: bool = False) -> DataFrame:
    """Read it back; ``multi_line`` for fields with line breaks, at a task per file."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in headers])
    raw = spark.read.schema(schema).options(**_CSV, multiLine=multi_line).csv(path)
    return raw.na.fill("")


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw pages ``(page_id, url, html)``."""
    return spark.read.schema("page_id bigint, url string, html string").parquet(path)


def of_city(reviews: DataFrame, held_out: str) -> DataFrame:
    """The reviews of the held-out city: what is scored."""
    return reviews.filter(F.col("city") == held_out)


def except_city(reviews: DataFrame, held_out: str) -> DataFrame:
    """The reviews of all other cities: what is learned from."""
    return reviews.filter(F.col("city") != held_out)
