"""Fields of review pages, found in the markup with JVM regular expressions.

Each element is located by tag and class, so the order of attributes and the
kind of quotes do not matter. Character references are resolved in the JVM too.
"""

from __future__ import annotations

import html as entities

from pyspark.sql import Column
from pyspark.sql import functions as F

#: the named references of HTML, as the standard library has them: names end with a semicolon, but
#: for some old ones that stand without
_NAMED = entities.entities.html5
_OLD = sorted((name for name in _NAMED if not name.endswith(";")), key=len, reverse=True)
#: what follows an ampersand in a reference
_REFERENCE = r"^(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32};?)"
_LAST_CODE, _REPLACEMENT = 0x10FFFF, "\ufffd"


def _character(code: Column) -> Column:
    """The character of a numeric reference; codes that stand for none give nothing or the replacement character."""
    # fixed rule: codes of the C1 controls mean the characters of the Windows code page, where it has them
    windows = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
    nothing = (
        code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
        | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    wrong = code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > _LAST_CODE)
    return (
        F.when(wrong, _REPLACEMENT)
        .when(nothing, "")
        .when(code.between(0x80, 0x9F), F.substr(F.lit(windows), (code - 0x7F).cast("int"), F.lit(1)))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


#: references that texts are full of; the ampersand's own is resolved last, as it makes no others
_COMMON = ["lt;", "gt;", "quot;", "nbsp;", "#x27;", "#39;", "amp;"]


def _number(found: Column) -> Column:
    """The code of a numeric reference; null for numbers beyond any code."""
    digits = F.regexp_extract(found, r"^#[xX]?0*([0-9a-fA-F]+)", 1)
    hexadecimal = F.lower(F.substr(found, F.lit(2), F.lit(1))) == "x"
    return F.when(hexadecimal, F.when(F.length(digits) <= 8, F.conv(digits, 16, 10).cast("bigint"))).otherwise(
        F.when(F.length(digits) <= 10, digits.try_cast("bigint"))
    )


def _named(found: Column) -> Column:
    """The characters of a named reference; null for an unknown name."""
    names, values = " ".join(_NAMED), "\x01".join(_NAMED.values())
    table = F.map_from_arrays(F.split(F.lit(names), " "), F.split(F.lit(values), "\x01"))
    return F.try_element_at(table, found)


def _told(s: Column) -> Column:
    """The characters of one read reference, and what follows it in the piece."""
    rest = lambda length: F.substr(s["piece"], length + 1)
    old = F.regexp_extract(s["found"], "^(?:" + "|".join(_OLD) + ")", 0)
    return (
        F.when(s["found"] == "", F.concat(F.lit("&"), s["piece"]))
        .when(F.startswith(s["found"], F.lit("#")), F.concat(_character(s["code"]), rest(F.length(s["found"]))))
        .when(s["value"].isNotNull(), F.concat(s["value"], rest(F.length(s["found"]))))
        .otherwise(F.coalesce(F.concat(_named(F.nullif(old, F.lit(""))), rest(F.length(old))), F.concat(F.lit("&"), s["piece"])))
    )


def unescape(text: Column) -> Column:
    """Character references such as ``&amp;`` and ``&#233;`` to characters, as browsers read them.

    A text without an ampersand is left alone, and one that holds only the most common
    references has them replaced. In others, what stands after each ampersand is read in steps, so
    that every pattern is matched once.
    """
    plain = text
    for name in _COMMON:
        plain = F.replace(plain, F.lit(f"&{name}"), F.lit(entities.unescape(f"&{name}")))
    others = F.lit("&(?!" + "|".join(_COMMON) + ")")
    pieces = F.split(text, "&", -1)
    after = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    found = F.transform(after, lambda p: F.struct(p.alias("piece"), F.regexp_extract(p, _REFERENCE, 0).alias("found")))
    numeric = lambda s: F.startswith(s["found"], F.lit("#"))
    read = F.transform(found, lambda s: F.struct(
        s["piece"].alias("piece"), s["found"].alias("found"),
        F.when(numeric(s), _number(s["found"])).alias("code"),
        F.when(~numeric(s) & (s["found"] != ""), _named(s["found"])).alias("value")))
    whole = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(read, _told), ""))
    return F.when(~F.contains(text, F.lit("&")), text).when(~F.regexp_like(text, others), plain).otherwise(whole)


# Repetitions are possessive: they are matched in a loop and never tried again, so
# that pages without an expected end cost linear time and no stack.

#: what remains of a tag, with ``>`` only outside quotes
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""


def _before(name: str) -> str:
    """The attributes of a tag up to the one called ``name``, and its equals sign."""
    other = rf"""(?:[\s/]++(?!{name}\s*+=)[^\s=>"'/]++(?:\s*+=\s*+{_VALUE})?+)*+"""
    return rf"""{other}[\s/]++{name}\s*+=\s*+"""


def _open_tag(tag: str, name: str) -> str:
    """Pattern of an opening tag that carries the class ``name``."""
    value = rf"""(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))"""
    return rf"<{tag}{_before('class')}{value}{_REST}"


def _value_of(name: str) -> str:
    """Pattern of an attribute whose value is groups 1, 2 or 3: in either kind of quotes, or bare."""
    return rf"""{_before(name)}(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))"""


def _until(tag: str) -> str:
    """Everything up to the next end of ``tag``."""
    return rf"(?:[^<]++|<(?!/{tag}[\s>]))*+"


def _first(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, null without a match."""
    pattern = "(?is)" + pattern
    found = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    # an empty group looks like no match; only then is the text searched again
    return F.coalesce(found, F.when(F.regexp_like(text, F.lit(pattern)), ""))


def _attribute(tag: Column, element: str, name: str) -> Column:
    """Value of an attribute of the tag that the text begins with; empty without one."""
    pattern = rf"(?is)^<{element}{_value_of(name)}"
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def without_comments(html: Column) -> Column:
    """A page without comments, scripts and styles, whose contents are no markup."""
    return F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*+>|\z)", "")


def inner_text(markup: Column) -> Column:
    """Text of a piece of markup: tags removed, character references resolved."""
    return unescape(F.regexp_replace(markup, rf"(?s)<!--.*?(?:-->|\z)|</?[a-zA-Z]{_REST}", ""))


def review_count_text(html: Column) -> Column:
    """The bracketed count of the second choice in the language filter.

    The page is cut behind the filter's mark and then behind its list of
    choices; what follows is matched once, from there.
    """
    page = without_comments(html)
    mark = "prw_filters_detail_language"
    behind = F.substring(page, F.nullif(F.instr(page, mark), F.lit(0)) + len(mark), F.length(page))
    choices = _first(behind, _open_tag("div", "choices") + r"(.*+)")
    span = _open_tag("span", "count")
    skip = rf"(?:[^<]++|<(?!/div[\s>])(?!{span[1:]}))*+"
    return _first(
        choices,
        rf"^\s*+<div\b{_REST}{_until('div')}</div\s*+>\s*+<div\b{_REST}{skip}{span}([^<]*+)<",
    )


def heading(html: Column, element_id: str | None = None) -> Column:
    """Markup inside the first ``h1``, or inside the one with the given id."""
    return heading_of(without_comments(html), element_id)


def heading_of(page: Column, element_id: str | None = None) -> Column:
    """The same on a page whose comments are gone."""
    wanted = "" if element_id is None else rf"""{_before('id')}(?:"{element_id}"|'{element_id}'|{element_id}(?=[\s>]))"""
    return _first(page, rf"""<h1(?=[\s>]){wanted}{_REST}({_until('h1')})</h1\s*+>""")


def review_ids(html: Column) -> Column:
    """Ids of the reviews on a page; each is written twice, so every second one."""
    value = rf"""(?is)<div{_before('data-reviewid')}["']?+([^"'\s>]*+)"""
    return every_second(F.regexp_extract_all(without_comments(html), F.lit(value), 1))


def every_second(items: Column) -> Column:
    return F.filter(items, lambda _, i: i % 2 == 0)


def links(html: Column) -> Column:
    """The addresses a page links to, in page order."""
    return F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)"'), 1)


def paragraphs(html: Column) -> Column:
    """Markup of the paragraphs of a page, in page order."""
    return F.regexp_extract_all(html, F.lit(r"(?s)<p>(.*?)</p>"), 1)


def review_blocks(html: Column) -> Column:
    """The page cut at each review block; what precedes the first is dropped."""
    # blocks nest further divs, so a block runs until the next one opens
    opens = _open_tag("div", "reviewSelector")
    parts = F.split(without_comments(html), f"(?is)(?={opens})")
    return F.filter(parts, lambda part, i: (i > 0) | F.regexp_like(part, F.lit(f"(?is)^{opens}")))


def block_username(block: Column) -> Column:
    """Markup of the reviewer's name, null when the block has none."""
    inner = r"(?:[^<]++|<(?!/?div[\s>]))*+"
    return _first(block, rf"""{_open_tag("div", "info_text")}{inner}<div\b{_REST}({_until("div")})</div\s*+>""")


def block_rating(block: Column) -> Column:
    """Rating code: the second class of the bubble, after its last underscore."""
    tag = F.regexp_substr(block, F.lit("(?is)" + _open_tag("span", "ui_bubble_rating")))
    value = _attribute(tag, "span", "class")
    return F.substring_index(F.get(F.split(F.trim(value), r"\s+"), F.lit(1)), "_", -1)


def block_body(block: Column) -> Column:
    return _first(block, rf"""{_open_tag("p", "partial_entry")}({_until("p")})</p\s*+>""")


def block_date(block: Column) -> Column:
    tag = F.regexp_substr(block, F.lit("(?is)" + _open_tag("span", "ratingDate")))
    return _attribute(tag, "span", "title")


def overall_rating_of(page: Column) -> Column:
    """The overall rating of a page whose comments are gone."""
    return _first(page, _open_tag("[a-z]++", "overallRating") + r"([^<]*+)</")


def about_card_of(page: Column) -> Column:
    """A page whose comments are gone, from behind the opening of its about card."""
    mark = "taplc_location_detail_about_card_0"
    return _first(page, rf"""<[a-z]++{_before('id')}["']?+{mark}["']?+(?=[\s>]){_REST}(.*+)""")


def about_text_of(card: Column) -> Column:
    """Markup of the first span of the second part of the about card."""
    div = rf"\s*+<div\b{_REST}"
    return _first(card, rf"""^{div}{div}{div}{_until("div")}</div\s*+>{div}\s*+<span\b{_REST}({_until("span")})</span\s*+>""")
