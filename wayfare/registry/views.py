"""The test tables seen as reviews, lines, pages and catalogue.

The shipped tables hold no reviews, so every view is derived from them by a
rule that Spark and SQL state alike; its size grows with the table behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.fixed import DELIMITER
from wayfare.operators.catalog import catalogue
from wayfare.sources.lines import review_line
from wayfare.sources.tables import scan_pages

#: ids per derived page of reviews, which bounds the rows of a page
PAGE_IDS = 200


#: declared, so that no job has to read them from the files
_DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pages(spark, f"{sf_dir}/pages.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input of few splits; large inputs pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def _number(source: Column) -> Column:
    return F.substring(source, F.lit(4), F.length(source)).cast("int")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews; the rating depends on the id alone."""
    doc, pct = F.col("doc_id"), F.col("doc_id") % 100
    rating = (
        F.when(pct < 5, "10").when(pct < 10, "20").when(pct < 20, "30").when(pct < 50, "40")
    ).otherwise("50")
    third = _number(F.col("source")) % 3
    city = F.when(third == 0, "london").when(third == 1, "paris").otherwise("nyc")
    day = F.date_add(F.lit("2019-01-01").cast("date"), (doc % 365).cast("int"))
    return documents(spark, sf_dir).select(
        doc.alias("review_id"),
        F.concat(F.lit("user"), (doc % 97).cast("string")).alias("username"),
        rating.alias("rating"),
        F.col("text").alias("review"),
        day.cast("string").alias("date"),
        city.alias("city"),
        F.col("source").alias("attraction"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews, spread for work on their texts."""
    return spread(reviews(spark, sf_dir), "review_id")


def dirty_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews with some ratings that are no valid code."""
    rest = F.col("review_id") % 37
    rating = F.when(rest == 5, "n/a").when(rest == 6, "0").otherwise(F.col("rating"))
    return reviews(spark, sf_dir).withColumn("rating", rating)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review lines, some of them broken off and some with a field too many."""
    rest = F.col("review_id") % 50
    whole = review_line()
    line = (
        F.when(rest == 7, F.substring_index(whole, DELIMITER, 2))
        .when(rest == 13, F.concat(whole, F.lit(f"{DELIMITER}tail")))
        .otherwise(whole)
    )
    return reviews(spark, sf_dir).select(
        line.alias("line"), "city", "attraction", F.col("review_id").alias("line_id")
    )


def _escaped(text: Column) -> Column:
    for mark, reference in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]:
        text = F.replace(text, F.lit(mark), F.lit(reference))
    return text


def _block() -> Column:
    """Markup of one review; every eleventh reviewer has no name.

    It is written in turn with quoted and bare attributes, with ``>`` inside
    quotes, and with a commented block that is no review.
    """
    turn = F.col("review_id") % 3
    named = F.concat(
        F.when(turn == 0, "<div class=info_text><div>")
        .when(turn == 1, "<div data-hint='a > b' class='info_text pointer_cursor'><div>")
        .otherwise('<div class="info_text pointer_cursor"><div>'),
        _escaped(F.col("username")),
        F.lit("</div></div>"),
    )
    key = F.col("review_id").cast("string")
    return F.concat(
        F.when(turn == 1, '<!-- <div class="reviewSelector" data-reviewid="none"><p class="partial_entry">no</p></div> -->')
        .otherwise(""),
        F.lit('<div class="reviewSelector" data-reviewid="'),
        key,
        F.when(turn == 2, F.concat(F.lit('"><div title="x > y" data-reviewid='), key, F.lit(' class="prw_rup">')))
        .otherwise(F.concat(F.lit('"><div class="prw_rup" data-reviewid="'), key, F.lit('">'))),
        F.lit('<div class="member_info">'),
        F.when(F.col("review_id") % 11 == 0, "").otherwise(named),
        F.lit('</div><span class="ui_bubble_rating bubble_'),
        F.col("rating"),
        F.lit("\"></span><span title='"),
        F.col("date"),
        F.when(turn == 0, "' class=ratingDate>").otherwise("' data-x=\"1 > 0\" class='ratingDate relativeDate'>"),
        F.lit("a while ago</span>"),
        F.when(turn == 0, "<p class=partial_entry>")
        .when(turn == 1, '<p title="a > b" class="partial_entry">')
        .otherwise('<p class="partial_entry">'),
        _escaped(F.col("review")),
        F.lit("</p></div></div>\n"),
    )


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of reviews in the markup of the site, at most PAGE_IDS reviews each."""
    page = (
        reviews(spark, sf_dir)
        .withColumn("page_no", F.floor(F.col("review_id") / PAGE_IDS))
        .groupBy("city", "attraction", "page_no")
        .agg(
            F.array_sort(F.collect_list(F.struct("review_id", _block().alias("block")))).alias("blocks"),
            F.sum(F.length("review")).alias("chars"),
            F.max("rating").alias("top"),
        )
    )
    html = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>page</title></head><body><h1 id="HEADING" class="heading">'),
        F.col("attraction"),
        F.lit(" &amp; <b>"),
        F.col("city"),
        F.lit('</b></h1><span class="overallRating">'),
        F.col("top") / 10,
        F.lit(' </span><div class="prw_rup prw_filters_detail_language ui_column separated is-3"><div>'
              '<div class="content"><div class="choices is-shown-at-tablet"><div><label>'
              '<span class="count">(7)</span></label></div><div><label>English <span class="count">('),
        F.format_number("chars", 0),
        F.lit(')</span></label></div></div></div></div></div><div id="taplc_location_detail_about_card_0">'
              "<div><div><div>About</div><div><span>The "),
        F.col("attraction"),
        F.lit(" of "),
        F.col("city"),
        F.lit(" &#38; around</span><span>more</span></div></div></div></div>\n"),
        F.array_join(F.transform("blocks", lambda b: b["block"]), ""),
        F.lit("</body></html>"),
    )
    return page.select("city", "attraction", "page_no", html.alias("html"))


def catalogue_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue key per attraction; some carry a stray underscore or two tiers."""
    n = _number(F.col("attraction"))
    key = F.concat(
        F.when(n % 7 == 0, "_").otherwise(""),
        F.lit("d"),
        (n + 1000).cast("string"),
        F.lit("-Reviews-"),
        F.col("attraction"),
    )
    tiers = F.when(n % 5 == 0, F.array(F.lit("1-10"), F.lit("11-30"))).otherwise(
        F.array(F.when(n % 2 == 0, "1-10").otherwise("11-30"))
    )
    return (
        reviews(spark, sf_dir)
        .select("city", "attraction")
        .distinct()
        .select("city", F.explode(tiers).alias("tier"), key.alias("key"))
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each attraction's first page address and number of reviews."""
    n = _number(F.col("attraction"))
    url = F.concat(
        F.lit("https://example.org/g1-d"), (n + 1000).cast("string"), F.lit("-Reviews-"), "attraction", F.lit(".html")
    )
    return (
        reviews(spark, sf_dir)
        .groupBy("city", "attraction")
        .agg(F.count("*").alias("num_reviews"))
        .select("city", "attraction", url.alias("url"), "num_reviews")
    )


def partly_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings, some of them without a number of reviews."""
    known = F.when(_number(F.col("attraction")) % 6 != 5, F.col("num_reviews"))
    return listings(spark, sf_dir).withColumn("num_reviews", known)


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items found on each page of a listing: some pages are short, some empty, whole ones follow them."""
    block = F.floor(F.col("review_id") / PAGE_IDS)
    turn = block + _number(F.col("attraction"))
    seen = (turn % 4 != 3) & ((turn % 3 != 2) | (F.col("review_id") % 3 == 0))
    return (
        reviews(spark, sf_dir)
        .groupBy("city", "attraction", (block * 10).alias("offset"))
        .agg(F.count_if(seen).alias("n_items"))
    )


def barred_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews, many of their bodies with bars at the ends or two in a row."""
    rest, body = F.col("review_id") % 5, F.col("review")
    barred = (
        F.when(rest == 0, F.concat(F.lit("|"), body, F.lit("||x|")))
        .when(rest == 1, F.concat(body, F.lit("|")))
        .when(rest == 2, F.concat(F.lit("&#124;|"), body))
    )
    return reviews(spark, sf_dir).withColumn("review", barred.otherwise(body))


def partly_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews, some of them without a city."""
    city = F.when(F.col("review_id") % 41 != 3, F.col("city"))
    return reviews(spark, sf_dir).withColumn("city", city)


def visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews, their attractions named after the real catalogue's, by number within the city."""
    names = catalogue(spark).groupBy("city").agg(F.array_sort(F.collect_list("attraction")).alias("names"))
    named = reviews(spark, sf_dir).join(F.broadcast(names), "city")
    place = _number(F.col("attraction")) % F.size("names") + 1
    return named.withColumn("attraction", F.element_at("names", place)).drop("names")


def info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the site tells about some of the attractions."""
    told = reviews(spark, sf_dir).filter(_number(F.col("attraction")) % 3 != 1)
    return told.groupBy("city", "attraction").agg(
        F.concat(F.lit("about "), F.min("username")).alias("about"),
        (F.max(F.col("rating").cast("int")) / 10).alias("rating"),
    )
