"""Records, ids and pagination of review pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import html as H
from wayfare.functions.strings import bracketed_count, decimal, empty_if_missing, page_url
from wayfare.operators.joins import lookup_join

#: reviews per page, and the page size below which a listing ends
PAGE_SIZE = 10
SHORT_PAGE = 5
#: pages numbered by one row before the rows are spread over the cluster
CHUNK_PAGES = 10_000


def review_counts(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Number of reviews announced by each page, null if it announces none."""
    return pages.select(
        *keep, bracketed_count(F.trim(H.review_count_text(F.col("html")))).alias("num_reviews")
    )


def headings(
    pages: DataFrame, keep: Sequence[str] = ("page_id",), element_id: str | None = None
) -> DataFrame:
    # the markup is a column of its own: resolving its references names it many times, and each would read the page again
    found = pages.select(*keep, H.heading(F.col("html"), element_id).alias("_heading"))
    return found.select(*keep, H.inner_text(F.col("_heading")).alias("heading"))


def listed_reviews(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per review id of a page, in page order."""
    return pages.select(*keep, F.posexplode_outer(H.review_ids(F.col("html")))).select(
        *keep, F.col("pos").alias("position"), F.col("col").alias("review_id")
    ).filter(F.col("review_id").isNotNull())


def review_records(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One review per review block: position, username, rating, review, date."""
    blocks = pages.select(*keep, F.posexplode_outer(H.review_blocks(F.col("html")))).filter(
        F.col("col").isNotNull()
    )
    block = F.col("col")
    return blocks.select(
        *keep,
        F.col("pos").alias("position"),
        empty_if_missing(H.inner_text(H.block_username(block))).alias("username"),
        H.block_rating(block).alias("rating"),
        H.inner_text(H.block_body(block)).alias("review"),
        H.unescape(H.block_date(block)).alias("date"),
    )


def attraction_info(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Title, overall rating and description of an attraction's page.

    Page, about card and markup are columns of their own, each made once: later steps name
    them many times, and would else read the whole page again for each.
    """
    page, card = F.col("_page"), F.col("_card")
    bare = pages.select(*keep, H.without_comments(F.col("html")).alias("_page"))
    cut = bare.select(
        *keep,
        H.heading_of(page, "HEADING").alias("_title"),
        H.overall_rating_of(page).alias("_rating"),
        H.about_card_of(page).alias("_card"),
    )
    found = cut.select(*keep, "_title", "_rating", H.about_text_of(card).alias("_about"))
    return found.select(
        *keep,
        H.inner_text(F.col("_title")).alias("title"),
        decimal(F.col("_rating")).alias("rating"),
        H.inner_text(F.col("_about")).alias("about"),
    )


def expand_pages(
    listings: DataFrame, page_size: int = PAGE_SIZE, chunk_pages: int = CHUNK_PAGES
) -> DataFrame:
    """One row per page of a listing ``(url, num_reviews, ...)``.

    Offsets run 0, 10, 20 and on while they do not exceed the count. A listing
    is first cut into chunks, so that one with very many pages is numbered by
    many tasks rather than by the one that holds its row. Listings without
    a count have no pages; ``uncounted`` keeps them aside.
    """
    reach = page_size * chunk_pages
    counted = listings.filter(F.col("num_reviews") >= 0)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("num_reviews"), F.lit(reach).cast("bigint"))
    # a fixed number, as these few bytes would else be merged into one task
    tasks = int(listings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = counted.withColumn("_from", F.explode(starts)).repartition(
        tasks, *listings.columns, "_from"
    )
    last = F.least(F.col("num_reviews"), F.col("_from") + (reach - page_size))
    offsets = F.sequence("_from", last, F.lit(page_size).cast("bigint"))
    return (
        chunks.withColumn("offset", F.explode(offsets))
        .drop("_from")
        .withColumn("page_url", page_url(F.col("url"), F.col("offset")))
    )


def uncounted(listings: DataFrame) -> DataFrame:
    """Listings whose number of reviews is missing or negative: pages to fetch again."""
    return listings.filter(F.coalesce(F.col("num_reviews"), F.lit(-1)) < 0)


def until_short_page(
    pages: DataFrame, group: Sequence[str], offset: str = "offset", items: str = "n_items"
) -> DataFrame:
    """Keep the pages of each listing up to its end.

    The end is the first page with fewer than five reviews: that page is kept
    if it has any, later ones never. Found as a minimum per listing, which
    sums up before the shuffle, where a running window would gather a listing.
    """
    ends = (
        pages.filter(F.col(items) < SHORT_PAGE)
        .groupBy(*group)
        .agg(F.min(offset).alias("_end"))
    )
    before = F.col("_end").isNull() | (F.col(offset) < F.col("_end"))
    last = (F.col(offset) == F.col("_end")) & (F.col(items) > 0)
    return lookup_join(pages, ends, group, "left").filter(before | last).drop("_end")
