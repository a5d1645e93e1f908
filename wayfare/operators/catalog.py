"""Cities, the attraction catalogue and the tables of the site."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.fixed import CATALOGUE, CITIES
from wayfare.functions.strings import attraction_link, empty_if_missing, home_link, key_attraction, key_serial, slug_title
from wayfare.operators.joins import lookup_join
from wayfare.operators.ranking import display_result

CITY_DIMENSION = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in ["city", "name", "geo_id", "suffix", "about"]]
)

CATALOGUE_KEYS = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in ["city", "tier", "key"]]
)

#: the relational tables of the site
CITY_TABLE = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("about", T.StringType(), False),
        T.StructField("serialNum", T.StringType(), False),
    ]
)
ATTRACTION_TABLE = T.StructType(
    [
        T.StructField("ranking", T.IntegerType(), False),
        T.StructField("city", T.IntegerType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("about", T.StringType(), False),
        T.StructField("serialNum", T.StringType(), False),
        T.StructField("rating", T.DoubleType(), False),
        T.StructField("result", T.DoubleType(), False),
    ]
)


def _literal(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Fixed rows as part of the plan; its size is known without a job."""
    columns = dict(zip(schema.names, zip(*rows)))
    return spark.createDataFrame(pa.table(columns), schema)


def city_dimension(spark: SparkSession) -> DataFrame:
    """The three cities: code, name, geo id, page suffix, blurb."""
    return _literal(spark, CITIES, CITY_DIMENSION)


def city_table(spark: SparkSession) -> DataFrame:
    """The cities as rows of the relational table, numbered from 1."""
    rows = [(i, name, about, geo) for i, (_, name, geo, _, about) in enumerate(CITIES, start=1)]
    return _literal(spark, rows, CITY_TABLE)


def catalogue(spark: SparkSession) -> DataFrame:
    """The known attractions, parsed from their keys; one row per serial."""
    rows = [(city, tier, key) for (city, tier), keys in CATALOGUE.items() for key in keys]
    keys = _literal(spark, rows, CATALOGUE_KEYS)
    parsed = parse_keys(keys).join(
        F.broadcast(city_dimension(spark).select("city", "geo_id")), "city"
    )
    return one_tier(parsed).select("city", "geo_id", "tier", "serial", "attraction")


def parse_keys(keys: DataFrame, key: str = "key") -> DataFrame:
    """Add ``serial`` and ``attraction``; a stray leading underscore is ignored."""
    return keys.withColumn("serial", key_serial(F.col(key))).withColumn(
        "attraction", key_attraction(F.col(key))
    )


def one_tier(parsed: DataFrame) -> DataFrame:
    """An attraction listed in both tiers stays in the lower one, 11-30."""
    others = [c for c in parsed.columns if c not in ("city", "serial", "tier")]
    chosen = parsed.groupBy("city", "serial").agg(
        F.max(F.struct("tier", *others)).alias("_row")
    )
    return chosen.select("city", "serial", "_row.*")


def in_tier(catalog: DataFrame, tier: str = "11-30") -> DataFrame:
    return catalog.filter(F.col("tier") == tier)


def with_city(df: DataFrame, how: str = "left") -> DataFrame:
    """Add name, geo id and blurb of the city; the dimension has three rows."""
    cities = city_dimension(df.sparkSession).select(
        "city", F.col("name").alias("city_name"), "geo_id", F.col("about").alias("city_about")
    )
    return df.join(F.broadcast(cities), "city", how)


def attractions_of_cities(attractions: DataFrame, cities: DataFrame) -> DataFrame:
    """Attractions joined to the city they refer to by id."""
    named = cities.select(F.col("id").alias("city"), F.col("title").alias("city_title"), F.col("serialNum").alias("city_serial"))
    return lookup_join(attractions, named, ["city"], "inner")


def orphans(attractions: DataFrame, cities: DataFrame) -> DataFrame:
    """Attractions whose city id no city has: violations of the foreign key."""
    return lookup_join(attractions, cities.select(F.col("id").alias("city")), ["city"], "left_anti")


def described(ranked: DataFrame, catalog: DataFrame, info: DataFrame) -> DataFrame:
    """Ranked attractions with their own serial, description and rating."""
    serials = catalog.select("city", "attraction", "serial")
    texts = info.select("city", "attraction", "about", "rating")
    return lookup_join(
        lookup_join(ranked, serials, ["city", "attraction"]), texts, ["city", "attraction"]
    )


def attraction_table(described_ranks: DataFrame) -> DataFrame:
    """Described ranks as rows of the relational attraction table.

    ``city`` is the city's number; what the catalogue or the info page does not
    tell is empty, an unknown rating 0: the table has no nulls. Ranks of no known city
    are left out, as no city could be referred to; ``orphans`` finds such rows.
    """
    cities = _literal(
        described_ranks.sparkSession,
        [(i, row[0]) for i, row in enumerate(CITIES, start=1)],
        T.StructType([T.StructField("_id", T.IntegerType()), T.StructField("city", T.StringType())]),
    )
    filled = described_ranks.join(F.broadcast(cities), "city").select(
        F.col("rank").cast("int").alias("ranking"),
        F.col("_id").alias("city"),
        slug_title(F.col("attraction")).alias("title"),
        empty_if_missing(F.col("about")).alias("about"),
        empty_if_missing(F.col("serial")).alias("serialNum"),
        F.coalesce(F.col("rating").cast("double"), F.lit(0.0)).alias("rating"),
        display_result(F.col("rank")).cast("double").alias("result"),
    )
    return filled.select(*ATTRACTION_TABLE.names)


def site_view(described_ranks: DataFrame) -> DataFrame:
    """What the site shows per attraction: titles, links, display value."""
    shown = with_city(described_ranks)
    return shown.select(
        "city",
        "city_name",
        home_link(F.col("geo_id")).alias("home_link"),
        "rank",
        slug_title(F.col("attraction")).alias("title"),
        attraction_link(F.col("geo_id"), F.col("serial")).alias("link"),
        "about",
        "rating",
        display_result(F.col("rank")).alias("result"),
    )
