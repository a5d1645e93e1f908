"""Small string helpers: names, counts, addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.functions.fixed import ATTRACTION_URL, HOME_URL


def last_part(text: Column, separator: str) -> Column:
    """What follows the last ``separator``: ``bubble_50`` gives ``50``."""
    return F.substring_index(text, separator, -1)


def bracketed_count(text: Column) -> Column:
    """``(1,234)`` gives 1234; anything unreadable gives null."""
    inside = F.substring(text, F.lit(2), F.length(text) - 2)
    return F.regexp_replace(inside, ",", "").try_cast("bigint")


def decimal(text: Column) -> Column:
    """A decimal number, null when unreadable."""
    return F.trim(text).try_cast("double")


def empty_if_missing(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def page_url(url: Column, offset: Column) -> Column:
    """Address of the page of reviews that starts at ``offset``."""
    numbered = F.concat(F.lit("Reviews-or"), offset.cast("string"), F.lit("-"))
    return F.replace(url, F.lit("Reviews-"), numbered)


def slug_title(slug: Column) -> Column:
    """``St_James_s_Park`` gives ``St James s Park``."""
    return F.translate(F.trim(slug), "_", " ")


def upper_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))


def attraction_link(geo_id: Column, serial: Column) -> Column:
    return F.concat_ws("-", F.lit(ATTRACTION_URL), geo_id, serial)


def home_link(geo_id: Column) -> Column:
    return F.concat_ws("-", F.lit(HOME_URL), geo_id)


def listing_url(geo_id: Column, key: Column, suffix: Column) -> Column:
    """Address of an attraction's first page of reviews."""
    return F.concat(F.lit(f"{ATTRACTION_URL}-"), geo_id, F.lit("-"), key, suffix)


def key_serial(key: Column) -> Column:
    """``d188159-Reviews-St_Paul_s_Cathedral`` gives ``d188159``."""
    return F.regexp_extract(key, r"^_?(d\d+)-Reviews-(.+)$", 1)


def key_attraction(key: Column) -> Column:
    """``d188159-Reviews-St_Paul_s_Cathedral`` gives ``St_Paul_s_Cathedral``."""
    return F.regexp_extract(key, r"^_?(d\d+)-Reviews-(.+)$", 2)


def _path_parts(path: Column) -> Column:
    # paths from file metadata are percent-encoded; a literal plus stays a plus
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    # a file of many parts is a folder of that name
    whole = F.regexp_replace(F.coalesce(decoded, path), r"(\.txt)/part-[^/]*$", "$1")
    return F.split(whole, "/")


def _folder_value(name: Column) -> Column:
    """What a written folder ``column=value`` stands for; other names stand for themselves.

    Writers escape characters that paths cannot hold; names as collected may hold a literal percent sign.
    """
    value = F.regexp_extract(name, r"^(?:city|file)=(.*)$", 1)
    value = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    # fixed value: how writers name the folder of a missing value
    value = F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__"))
    return F.when(name.rlike(r"^(?:city|file)="), value).otherwise(name)


def path_city(path: Column) -> Column:
    """The folder of ``.../<city>/<attraction>.txt``, or of ``.../city=<city>/file=<attraction>.txt``."""
    return _folder_value(F.try_element_at(_path_parts(path), F.lit(-2)))


def path_attraction(path: Column) -> Column:
    """The file name of ``.../<city>/<attraction>.txt`` without its ending, or that of ``file=...``."""
    return F.regexp_replace(_folder_value(F.try_element_at(_path_parts(path), F.lit(-1))), r"\.txt$", "")
