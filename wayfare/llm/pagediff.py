"""Main text of pages by differencing each page with its nearest URLs.

Pages of a host stand in the order of their URL paths; each is aligned with its
neighbours there. Text lines (blocks) in the longest common subsequence of
two neighbours belong to the host's template and are deleted. Two rules keep
that from going wrong where a neighbour proves nothing: two pages that share
nearly all of their content are copies, of which nothing is deleted, and a line
inside ``article`` or ``main`` goes only if it is a label of few words at the
article's beginning or end and each neighbour that is no copy shows it there too, as sentences
may stand in several articles. An exact check follows for what no neighbour shows (a host's
only page, an advert of one page): lines that the markup itself declares to be
menu, header, footer, sidebar, notice, advert, form or comments.

Only hashes of lines are sorted and compared; a page's text is
shuffled once, to meet the lines found.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import sliced, tasks

#: what a line's place in the markup says of it
PLAIN, MAIN, CHROME = 0, 1, 2
#: two pages that share this much of their content (article or main, else plain text) are copies of each other
COPIES = 0.8

# fixed values of HTML
_SILENT = frozenset(
    "head script style template noscript svg math iframe object audio video canvas select button textarea title".split()
)
_CHROME_TAGS = frozenset("nav header footer aside form menu dialog".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
_MAIN_TAGS = frozenset(["article", "main"])
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr input".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose end may be left out: they hold no region open
_LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option optgroup colgroup caption rt rp h1 h2 h3 h4 h5 h6".split())
#: words that classes and ids of page furniture begin or end with
_CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo sponsor sponsored cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription sidebar aside menu menus nav navbar navigation breadcrumb "
    "breadcrumbs header masthead footer comment comments commentlist disqus reply replies respond share sharing social "
    "related recommended recommendations toolbar widget widgets login signup search pagination pager copyright".split()
)
_NEGATED = frozenset("no not has with without".split())

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*+([^\s=>/\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?")
_TOKENS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _furniture(names: str) -> bool:
    """Does a class list or an id name page furniture?"""
    for name in names.split():
        words = _TOKENS.findall(_CAMEL.sub("-", name).lower())
        if words and not _NEGATED & set(words) and (words[0] in _CHROME_WORDS or words[-1] in _CHROME_WORDS):
            return True
    return False


def _role(tag: str, attributes: dict[str, str], outer: int) -> int:
    if outer == CHROME or "hidden" in attributes:
        return CHROME
    if tag in _CHROME_TAGS or attributes.get("role", "").lower() in _CHROME_ROLES:
        return CHROME
    if tag not in ("html", "body", "main") and any(_furniture(attributes.get(a, "")) for a in ("class", "id")):
        if tag != "article" or "comment" in (attributes.get("class", "") + attributes.get("id", "")).lower():
            return CHROME
    if tag in _MAIN_TAGS or attributes.get("role", "").lower() in ("main", "article"):
        return MAIN
    return outer


def _tag_end(page: str, at: int, unclosed: set[str]) -> tuple[dict[str, str], int]:
    """The attributes of the tag whose name ends at ``at``, and the place behind the tag.

    A quote that is never closed ends at the next ``>`` instead; ``unclosed``
    remembers it, so that hostile pages are not read to their end again and again.
    """
    attributes: dict[str, str] = {}
    while True:
        found = _ATTRIBUTE.match(page, at)
        if found:
            attributes.setdefault(found[1].lower(), html.unescape(found[2] or found[3] or found[4] or ""))
            at = found.end()
        while at < len(page) and page[at] in " \t\r\n\f/":
            at += 1
        if at >= len(page):
            return attributes, at
        if page[at] == ">":
            return attributes, at + 1
        if page[at] == "=" and page[at + 1 : at + 2] not in ('"', "'"):
            at += 1
        elif page[at] in "\"'=":
            quote = page[at] if page[at] != "=" else page[at + 1]
            start = page.index(quote, at) + 1
            end = -1 if quote in unclosed else page.find(quote, start)
            if end < 0:
                unclosed.add(quote)
                end = page.find(">", start)
                return attributes, len(page) if end < 0 else end + 1
            at = end + 1
        elif not found:
            at += 1


def lines_of(page: str | None) -> tuple[list[str], list[int]]:
    """The text blocks of a page in order, and the role of each.

    Character references are decoded, white space runs are one blank, blocks
    are trimmed and empty ones left out. Broken markup is read as far as it
    goes; a text without any markup is one plain block.
    """
    page = page or ""
    lines: list[str] = []
    roles: list[int] = []
    buffer: list[str] = []
    stack: list[tuple[str, int]] = []
    role, at, size, unclosed = PLAIN, 0, len(page), set()
    lowered = None

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                lines.append(text)
                roles.append(role)
            buffer.clear()

    while at < size:
        opening = page.find("<", at)
        if opening < 0:
            buffer.append(page[at:])
            break
        if opening > at:
            buffer.append(page[at:opening])
        if page.startswith("<!--", opening):
            end = -1 if "--" in unclosed else page.find("-->", opening + 4)
            if end < 0:
                unclosed.add("--")
                end = page.find(">", opening)
                at = size if end < 0 else end + 1
            else:
                at = end + 3
            continue
        if page[opening + 1 : opening + 2] in ("!", "?"):
            end = page.find(">", opening)
            at = size if end < 0 else end + 1
            continue
        name = _NAME.match(page, opening + 1)
        if not name:
            buffer.append("<")
            at = opening + 1
            continue
        tag = name[0].lower()
        attributes, at = _tag_end(page, name.end(), unclosed)
        closing, tag = tag[0] == "/", tag.lstrip("/")
        if tag == "br":
            buffer.append(" ")
        elif tag in _INLINE:
            continue
        elif closing:
            flush()
            if tag not in _LOOSE and any(t == tag for t, _ in stack):
                while stack:
                    open_tag, outer = stack.pop()
                    role = outer
                    if open_tag == tag:
                        break
        else:
            flush()
            if tag in _SILENT:
                if lowered is None:
                    lowered = page.lower() if len(page.lower()) == size else page
                end = -1 if tag in unclosed else lowered.find("</" + tag, at)
                if end < 0:
                    unclosed.add(tag)
                else:
                    end = page.find(">", end)
                    at = size if end < 0 else end + 1
            elif tag not in _VOID and tag not in _LOOSE:
                stack.append((tag, role))
                role = _role(tag, attributes, role)
    flush()
    return lines, roles


def address(url: str | None) -> tuple[str, str]:
    """Host (lower case, without user and port) and path (without query and fragment)."""
    rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://|^//", "", url or "")
    host, _, path = re.split(r"[?#]", rest, maxsplit=1)[0].partition("/")
    return host.rpartition("@")[2].partition(":")[0].lower(), "/" + path.rstrip("/")


def common_lines(a: list, b: list) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence of two lists, in order.

    Lines that only one list has are left out first. The rest is solved by
    halving: memory follows the length of a list, not the product of both.
    """
    both = set(a) & set(b)
    x = [(i, v) for i, v in enumerate(a) if v in both]
    y = [(j, v) for j, v in enumerate(b) if v in both]
    codes = {v: n for n, v in enumerate(both)}
    p = np.array([codes[v] for _, v in x], np.int64)
    q = np.array([codes[v] for _, v in y], np.int64)
    out: list[tuple[int, int]] = []

    def last_row(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        row = np.zeros(len(q) + 1, np.int64)
        for v in p:
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (q == v)))
        return row

    def solve(p: np.ndarray, q: np.ndarray, i: int, j: int) -> None:
        n = 0
        while n < min(len(p), len(q)) and p[n] == q[n]:
            out.append((i + n, j + n))
            n += 1
        p, q, i, j = p[n:], q[n:], i + n, j + n
        if not len(p) or not len(q):
            return
        if len(p) == 1:
            at = np.flatnonzero(q == p[0])
            if len(at):
                out.append((i, j + int(at[0])))
            return
        half = len(p) // 2
        total = last_row(p[:half], q) + last_row(p[half:][::-1], q[::-1])[::-1]
        cut = int(np.argmax(total))
        solve(p[:half], q[:cut], i, j)
        solve(p[half:], q[cut:], i + half, j + cut)

    solve(p, q, 0, 0)
    return [(x[i][0], y[j][0]) for i, j in out]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, key, url, html -> host, path, id, key, the lines' hashes, lengths and roles."""
    for batch in sliced(batches):
        rows = []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            lines, roles = lines_of(page)
            codes = np.array([xxhash.xxh64_intdigest(t) for t in lines], np.uint64).view(np.int64)
            rows.append((*address(url), codes, np.array([len(t) for t in lines], np.int32), np.array(roles, np.int32)))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), batch.column("page_id"), batch.column("key"),
             pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.list_(pa.int32())),
             pa.array(columns[4], pa.list_(pa.int32()))],
            ["host", "path", "page_id", "key", "codes", "sizes", "roles"],
        )


_LINES = "codes array<long>, sizes array<int>, roles array<int>"


#: a line of an article is a label up to so many words
LABEL_WORDS = 5
#: stands among a page's lines for a neighbour that is no copy
_TELLING = -1


def _shared(a: dict, b: dict) -> tuple[list[int], list[int]]:
    """The lines that two neighbours share, as places in each, with ``_TELLING`` in front.

    If the neighbours are copies of each other, only what the markup declares
    furniture counts. They are judged by what is content in them: with an
    ``article`` or ``main``, the plain text around it is what templates hold.
    """
    pairs = common_lines(a["codes"], b["codes"])
    found, copies = [], []
    for page, other, own in ((a, b, pairs), (b, a, [(j, i) for i, j in pairs])):
        roles, sizes = page["roles"], page["sizes"]
        judged = MAIN if MAIN in roles else PLAIN
        text = sum(n for n, r in zip(sizes, roles, strict=True) if r == judged)
        copies.append(sum(sizes[i] for i, _ in own if roles[i] == judged) >= COPIES * text)
        found.append([i for i, j in own if roles[i] != MAIN or other["roles"][j] == MAIN])
    if all(copies):
        found = [[i for i in own if page["roles"][i] == CHROME] for page, own in zip((a, b), found, strict=True)]
        return found[0], found[1]
    return [_TELLING, *found[0]], [_TELLING, *found[1]]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages -> the lines each shares with the page before it and behind it.

    The first and the last page of the task come out a second time, with
    their lines: their other neighbour is in another task.
    """
    part, place, before = TaskContext.get().partitionId(), 0, None
    schema = kind = None
    for batch in batches:
        kind = kind or batch.schema.field("page_id")
        schema = schema or pa.schema([kind, *_FOUND])
        out = []
        for row in batch.to_pylist():
            row |= {"part": part, "place": place, "shared": None}
            if before is None:
                out.append(row)
            elif before["host"] == row["host"]:
                of_before, of_row = _shared(before, row)
                out.append({"page_id": before["page_id"], "key": before["key"], "shared": of_before})
                out.append({"page_id": row["page_id"], "key": row["key"], "shared": of_row})
            before, place = row, place + 1
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if before is not None:
        yield pa.RecordBatch.from_pylist([before | {"place": place}], schema=schema)


_FOUND = [
    pa.field("key", pa.int64()), pa.field("shared", pa.list_(pa.int32())), pa.field("host", pa.string()),
    pa.field("codes", pa.list_(pa.int64())), pa.field("sizes", pa.list_(pa.int32())), pa.field("roles", pa.list_(pa.int32())),
    pa.field("part", pa.int32()), pa.field("place", pa.int64()),
]


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (other, this) of pages next to each other in two tasks."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            of_other, of_this = _shared(row["other"], row["this"])
            out.append({"page_id": row["other"]["page_id"], "key": row["other"]["key"], "shared": of_other})
            out.append({"page_id": row["this"]["page_id"], "key": row["this"]["key"], "shared": of_this})
        kind = pa.field("page_id", batch.schema.field("this").type.field("page_id").type)
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([kind, *_FOUND[:2]]))


def _label(line: str) -> bool:
    """Few words and no end of a sentence; sentences may be shared content."""
    return line.count(" ") < LABEL_WORDS and line[-1:].isalnum()


def _borders_of_main(roles: list[int], shared: set[int]) -> set[int]:
    """Shared lines at the beginning and the end of the article; a sentence inside it can well stand in others too.

    An article of shared lines alone is left whole.
    """
    main = [i for i, r in enumerate(roles) if r == MAIN]
    first = next((at for at, i in enumerate(main) if i not in shared), len(main))
    last = next((at for at, i in enumerate(reversed(main)) if i not in shared), 0)
    return set() if first == len(main) else {*main[:first], *main[len(main) - last :]}


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        texts, shared, marked = [], [], []
        for lines, roles, found in zip(*(batch.column(n).to_pylist() for n in ("lines", "roles", "shared")), strict=True):
            times = {f["line"]: f["times"] for f in found or ()}
            telling = times.pop(_TELLING, 0)
            everywhere = {i for i, n in times.items() if n == telling and _label(lines[i])}
            template = {i for i in times if roles[i] != MAIN} | _borders_of_main(roles, everywhere)
            kept = [t for i, (t, r) in enumerate(zip(lines, roles, strict=True)) if r != CHROME and i not in template]
            texts.append("\n\n".join(kept))
            shared.append(len(template))
            marked.append(sum(r == CHROME and i not in template for i, r in enumerate(roles)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array(shared, pa.int64()), pa.array(marked, pa.int64())],
            ["page_id", "url", "text", "n_chars", "n_shared", "n_marked"],
        )


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        found = [lines_of(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("key"),
             pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], pa.list_(pa.int32()))],
            ["page_id", "url", "key", "lines", "roles"],
        )


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars, n_shared, n_marked``.

    ``text`` is the page's content blocks joined by two line breaks, empty if
    there are none; ``n_shared`` counts the lines deleted because a neighbour
    shares them, ``n_marked`` those deleted by their markup alone. Null
    html is an empty page; a null url is a host without name; pages of one
    URL are neighbours in the order of their ids; repeated rows share one
    finding; a host's only page has no neighbour; an empty table gives no rows;
    other columns are not read.

    Neighbours are found by one range sort of line hashes, so a host of any
    size is spread over tasks; pages at the borders of tasks are paired by
    themselves, two a task.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    key = F.xxhash64("url", "html")
    plain = pages.select("page_id", "url", "html").withColumn("key", key)
    hashed = plain.mapInArrow(_hashes, f"host string, path string, page_id {kind}, key long, {_LINES}")
    sort = ["host", "path", "page_id", "key"]
    ordered = written(hashed, "lines").repartitionByRange(tasks(spark), *sort).sortWithinPartitions(*sort)
    found = written(
        ordered.mapInArrow(
            _neighbours,
            f"page_id {kind}, key long, shared array<int>, host string, {_LINES}, part int, place long",
        ),
        "neighbours",
    )
    # at most two rows a task, whatever the number of pages
    sides = found.where("shared is null").select(
        "part", "place", "host", F.struct("page_id", "key", "codes", "sizes", "roles").alias("this")
    )
    along = Window.orderBy("part", "place")
    pairs = (
        sides.withColumn("other", F.lag("this").over(along)).withColumn("from", F.lag("part").over(along))
        .withColumn("whose", F.lag("host").over(along))
        .where((F.col("from") != F.col("part")) & (F.col("whose") == F.col("host")))
    )
    at_borders = pairs.select("other", "this").mapInArrow(_borders, f"page_id {kind}, key long, shared array<int>")
    shared = (
        found.where("shared is not null").select("page_id", "key", "shared").unionByName(at_borders)
        .where(F.size("shared") > 0)
        .select("page_id", "key", F.explode("shared").alias("line"))
        .groupBy("page_id", "key", "line").agg(F.count("*").alias("times"))
        .groupBy(F.col("page_id").alias("_id"), F.col("key").alias("_key"))
        .agg(F.collect_list(F.struct("line", "times")).alias("shared"))
    )
    parsed = plain.mapInArrow(
        _parsed, f"page_id {kind}, url string, key long, lines array<string>, roles array<int>"
    )
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    return parsed.join(shared, same, "left").select("page_id", "url", "lines", "roles", "shared").mapInArrow(
        _texts, f"page_id {kind}, url string, text string, n_chars long, n_shared long, n_marked long"
    )
