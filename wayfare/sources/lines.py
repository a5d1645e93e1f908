"""Review line files: one review per line, four fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.fixed import DELIMITER, REVIEW_FIELDS
from wayfare.functions.strings import empty_if_missing, path_attraction, path_city
from wayfare.operators.joins import lookup_join
from wayfare.operators.ranking import row_number_within

#: the same delimiter for ``split``, which takes a pattern
_SPLIT_PATTERN = r"\|\|"

REVIEWS = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in REVIEW_FIELDS],
        T.StructField("city", T.StringType()),
        T.StructField("attraction", T.StringType()),
    ]
)


def scan_city_folders(spark: SparkSession, paths: str | Sequence[str], stable: bool = False) -> DataFrame:
    """Lines of ``<city>/<attraction>.txt`` files as one corpus.

    ``line_id`` is unique and grows in the order of each file, but moves with the way files are
    split; it serves as the review id, so keep it by landing the parsed
    reviews in a table. ``stable`` ids (see ``stable_ids``) do not move.
    """
    path = F.col("_metadata.file_path")
    scanned = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("value").alias("line"),
        path_city(path).alias("city"),
        path_attraction(path).alias("attraction"),
        F.monotonically_increasing_id().alias("line_id"),
    )
    return stable_ids(scanned) if stable else scanned


def scan_partitioned(spark: SparkSession, path: str, stable: bool = False) -> DataFrame:
    """Lines of a tree written by ``write_lines``; ids as in ``scan_city_folders``."""
    schema = "value string, city string, attraction string"
    scanned = spark.read.schema(schema).text(path).select(
        F.col("value").alias("line"),
        "city",
        "attraction",
        F.monotonically_increasing_id().alias("line_id"),
    )
    return stable_ids(scanned) if stable else scanned


def stable_ids(lines: DataFrame, window_rows: int = 1_000_000) -> DataFrame:
    """Replace ``line_id`` by one that follows from city, attraction, line and occurrence alone.

    It is the same for any split size, listing order and number of cores, so
    samples and splits by it are too. A line's id is a hash of 63 bits; lines whose hash is taken
    again, as equal lines of a file are, get the hash of it and their place
    among those (equal lines are interchangeable). Hashes are counted first: one
    more scan, whose shuffle holds a number a line. Only lines of
    repeated hashes are shuffled themselves, and a line repeated more than ``window_rows`` times is
    numbered in ranges. Of n lines about n * n / 2**64 pairs share an id by chance.
    """
    order = ["city", "attraction", "line"]
    keyed = lines.drop("line_id").withColumn("_key", F.shiftrightunsigned(F.xxhash64(*order), 1))
    repeated = keyed.groupBy("_key").agg(F.count("*").alias("_times")).where("_times > 1")
    marked = lookup_join(keyed, repeated, ["_key"], weight="_times", deal=order)
    once = marked.where("_times is null").withColumn("line_id", F.col("_key"))
    again = row_number_within(
        marked.where("_times is not null"), ["_key"], [F.col(c) for c in order], "_place", window_rows
    ).withColumn("line_id", F.shiftrightunsigned(F.xxhash64("_key", F.col("_place").cast("bigint")), 1))
    return once.select(*lines.columns).unionByName(again.select(*lines.columns))


def parse_lines(lines: DataFrame, line: str = "line", bars: bool = False) -> DataFrame:
    """Add the four fields by position, and how many fields the line has.

    A fifth field and what follows are ignored; missing fields are null. ``bars``
    gives back the bars that ``review_line`` had to write as references.
    """
    parts = F.split(F.col(line), _SPLIT_PATTERN)
    with_parts = lines.withColumn("_parts", parts)
    read = _with_bars if bars else (lambda field: field)
    fields = {name: read(F.get("_parts", F.lit(i))) for i, name in enumerate(REVIEW_FIELDS)}
    return with_parts.withColumns({**fields, "field_count": F.size("_parts")}).drop("_parts")


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("field_count") >= len(REVIEW_FIELDS))


def quarantined(parsed: DataFrame) -> DataFrame:
    """Lines with too few fields, kept aside rather than failing the job."""
    return parsed.filter(F.col("field_count") < len(REVIEW_FIELDS))


def reviews_of(lines: DataFrame, bars: bool = False) -> DataFrame:
    """Typed reviews from scanned lines; ``bars`` as in ``parse_lines``."""
    parsed = well_formed(parse_lines(lines, bars=bars))
    return parsed.select(F.col("line_id").alias("review_id"), *REVIEW_FIELDS, "city", "attraction")


#: how a bar is written where the delimiter could be mistaken, and how that mark itself is
_BAR, _MARK, _MARKED = "&#124;", "&#", "&#38;#"


def one_line(text: Column) -> Column:
    """A field without line breaks, which would end its record."""
    return F.regexp_replace(empty_if_missing(text), r"[\r\n]+", " ")


def _without_bars(field: Column) -> Column:
    """Bars that touch another bar or an end of the field, written so that no field can end there."""
    marked = F.replace(field, F.lit(_MARK), F.lit(_MARKED))
    written = F.regexp_replace(marked, r"(?<=\|)\||\|(?=\|)|^\||\|$", _BAR)
    return F.when(F.contains(field, F.lit("|")) | F.contains(field, F.lit(_MARK)), written).otherwise(field)


def _with_bars(field: Column) -> Column:
    """The inverse of ``_without_bars``."""
    read = F.replace(F.replace(field, F.lit(_BAR), F.lit("|")), F.lit(_MARKED), F.lit(_MARK))
    return F.when(F.contains(field, F.lit("&#")), read).otherwise(field)


def review_line(fields: Sequence[str] = REVIEW_FIELDS) -> Column:
    """The four fields joined by the delimiter; a missing one stays empty.

    The format has no escape, so bars that could be read as part of a delimiter
    become character references; ``parse_lines(bars=True)`` turns them back.
    """
    return F.concat_ws(DELIMITER, *[_without_bars(one_line(F.col(name))) for name in fields])


def write_lines(reviews: DataFrame, path: str) -> None:
    """Write review lines under ``city=.../attraction=...``.

    Rebalancing gathers each attraction, so that not every task writes a file
    for every attraction, and splits a large one by the sizes measured in the
    shuffle; no sampling pass reads the texts a second time.
    """
    (
        reviews.hint("rebalance", "city", "attraction")
        .sortWithinPartitions("city", "attraction", "review_id")
        .select(review_line().alias("value"), "city", "attraction")
        .write.partitionBy("city", "attraction")
        .text(path)
    )


def write_city_folders(reviews: DataFrame, path: str) -> None:
    """Write review lines by city and attraction, as ``write_city_lines`` does."""
    write_city_lines(
        reviews.select(review_line().alias("line"), "city", "attraction", F.col("review_id").alias("line_id")), path
    )


def write_city_lines(lines: DataFrame, path: str) -> None:
    """Write ``line, city, attraction, line_id`` as ``city=<city>/file=<attraction>.txt``.

    Each ``.txt`` is a folder of part files, so that an attraction of any size
    is written by as many tasks as it needs. The tasks write below the final names and nothing
    is renamed folder by folder; ``scan_city_folders`` reads ``*/*.txt`` of this layout and of
    collected files alike.
    """
    (
        lines.hint("rebalance", "city", "attraction")
        .sortWithinPartitions("city", "attraction", "line_id")
        .select(F.col("line").alias("value"), "city", F.concat("attraction", F.lit(".txt")).alias("file"))
        .write.partitionBy("city", "file")
        .text(path)
    )
