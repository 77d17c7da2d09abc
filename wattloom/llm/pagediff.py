"""Main text of web pages: nearest pages of a host are differenced, what both show is template."""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, partitions, small, staged

# Element names by their part in a page, and words that name side matter in class, id and role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
UNSEEN = {"script", "style", "template", "noscript", "iframe", "object", "svg", "math", "head", "title", "textarea", "select", "button", "form", "canvas", "audio", "video"}
SIDE = {"nav", "footer", "aside", "menu", "dialog", "header"}
MAIN = {"article", "main"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
SIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "dialog", "disqus", "footer", "gdpr", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "pagination", "paywall", "popup", "promo", "promoted", "related", "search", "share", "sharing", "sidebar", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
CLOSED_BY_NEXT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
RAW = {"script", "style", "textarea", "title", "iframe"}
PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
TOKEN = re.compile(r"[a-z]+")


def is_side(name: str, attributes: str, in_main: bool) -> bool:
    if name in UNSEEN or name in SIDE and not (name == "header" and in_main):
        return True
    if not attributes.strip():
        return False
    said = " ".join("".join(x) for x in NAMED.findall(attributes)).lower()
    # A page-wide element with a side word, as in <body class="has-sidebar">, still holds the text.
    return bool(HIDDEN.search(attributes)) or name not in ("html", "body", *MAIN) and not SIDE_WORDS.isdisjoint(TOKEN.findall(said))


def lines_of(html: str | None) -> list[tuple[str, bool]]:
    """Text lines in page order, each with whether it stands inside the main element; side matter is left out."""
    found: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, side, main
    held: list[str] = []
    page = html or ""
    side = main = False
    at = 0

    def end_line() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            found.append((text, main))

    while at < len(page):
        m = PART.search(page, at)
        upto = m.start() if m else len(page)
        if not side and upto > at:
            held.append(page[at:upto])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if not side and m[0].startswith("<![CDATA["):
                held.append(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            if name in BLOCK and not side:
                end_line()
            last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if last is not None:
                del stack[last:]
        else:
            if name in BLOCK and not side:
                end_line()
            closes = CLOSED_BY_NEXT.get(name, {"p"} if name in BLOCK - {"br", "hr"} else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closes:
                    del stack[i:]
                    break
                if stack[i][0] in BLOCK:
                    break
            inside = stack[-1][2] if stack else False
            if name not in VOID and not m[3].endswith("/"):
                stack.append((name, (stack[-1][1] if stack else False) or is_side(name, m[3], inside), inside or name in MAIN))
                if name in RAW:
                    close = re.compile(rf"</{name}\b", re.I).search(page, at)
                    at = close.start() if close else len(page)
        now = stack[-1][1:] if stack else (False, False)
        if now != (side, main) and not side:
            end_line()
        side, main = now
    if not side:
        end_line()
    return found


def common(a: list[int], b: list[int]) -> set[int]:
    """Places in `a` that a longest common subsequence with `b` takes (matching pairs, then rising chain)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[int, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):  # falling, so that one line of `a` enters a chain once
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    got = {*range(head), *range(len(a) - tail, len(a))}
    link = links[-1] if links else None
    while link:
        got.add(link[0])
        link = link[1]
    return got


def main_lines(lines: list[tuple[str, bool]], partner: list[int] | None, mirror: float) -> list[str]:
    """Lines that the partner does not share, and those inside a main element.

    A repeated sentence inside a marked article is its author's, so the mark keeps shared lines; lines outside
    of it stay if the partner lacks them. A partner that shares the share `mirror` of all lines or more shows the same article,
    not the same template. Without a partner that tells, a page that marks a main element keeps just that.
    """
    if partner:
        shared = common(hashed(lines).tolist(), partner)
        if len(shared) < mirror * len(lines):
            return [t for i, (t, inside) in enumerate(lines) if inside or i not in shared]
    marked = any(inside for _, inside in lines)
    return [t for t, inside in lines if inside or not marked]


def joined_lines(lines: list[tuple[str, bool]]) -> str:
    """Lines, which hold no line break, as one text; each begins with whether it is inside."""
    return "\n".join(("1" if inside else "0") + line for line, inside in lines)


def split_lines(text: str) -> list[tuple[str, bool]]:
    return [(x[1:], x[0] == "1") for x in text.split("\n")] if text else []


def hashed(lines: list[tuple[str, bool]]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t, _ in lines], np.int64)


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path and lines (see joined_lines)."""
    host = F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]+)", 1))
    path = F.regexp_replace(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?[^/?#]+([^?#]*)", 1), r"(?:/index)?(?:\.[a-zA-Z]{3,5})?/*$", "")
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string())]
    schema = pa.schema([*kinds, ("lines", pa.string())])

    def run(batches):
        for b in chunks(batches, text="html"):
            yield batch(schema, *[b.column(k) for k, _ in kinds], [joined_lines(lines_of(t)) for t in b.column("html").to_pylist()])

    read = pages.select(F.col("page_id").cast("bigint"), "url", host.alias("host"), path.alias("path"), "html")
    return read.mapInArrow(run, "page_id bigint, url string, host string, path string, lines string")


def line_hashes(rows: DataFrame) -> DataFrame:
    """row, and the hashes of its lines as bytes."""
    schema = pa.schema([("row", pa.int64()), ("hashes", pa.binary())])

    def run(batches):
        for b in batches:
            yield batch(schema, b.column("row"), [hashed(split_lines(t)).tobytes() for t in b.column("lines").to_pylist()])

    return rows.select("row", "lines").mapInArrow(run, "row bigint, hashes binary")


def packed(rows: DataFrame) -> DataFrame:
    """row, page_id, url and the compressed lines, for the way through a shuffle."""
    schema = pa.schema([("row", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("lines", pa.binary())])

    def run(batches):
        press = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=True)
        for b in batches:
            yield batch(schema, *[b.column(c) for c in ("row", "page_id", "url")], [press.compress(t.encode()) for t in b.column("lines").to_pylist()])

    return rows.select("row", "page_id", "url", "lines").mapInArrow(run, "row bigint, page_id bigint, url string, lines binary")


def nearest(keys: DataFrame) -> DataFrame:
    """(host, path, row) to (host, path, partner): the row of the neighbour in path order that has more leading
    path segments in common, the earlier one on ties.

    Keys are sorted over the cluster by range; neighbours across a border come from one row per range.
    """
    n = partitions(keys.sparkSession)
    ranged = staged(keys.repartitionByRange(n, "host", "path").withColumn("part", F.spark_partition_id()))
    here = F.struct("host", "path", "row")
    by = Window.partitionBy("part").orderBy("host", "path")
    ranged_pairs = ranged.withColumn("before", F.lag(here).over(by)).withColumn("after", F.lead(here).over(by))
    ends = ranged.groupBy("part").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    order = Window.orderBy("part")
    # One row per partition of the sort.
    ends = F.broadcast(ends.select("part", F.lag("last").over(order).alias("earlier"), F.lead("first").over(order).alias("later")))
    own = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), F.col(c))
    joined = ranged_pairs.join(ends, "part").withColumn("before", F.coalesce("before", "earlier")).withColumn("after", F.coalesce("after", "later"))
    joined = joined.withColumn("before", own("before")).withColumn("after", own("after"))
    parts = lambda c: F.split(c, "/")
    alike = lambda c: F.size(F.filter(F.sequence(F.lit(1), F.size(parts("path"))), lambda i: F.slice(parts("path"), 1, i) == F.slice(parts(f"{c}.path"), 1, i)))
    better = F.when(F.col("before").isNull(), F.col("after.row")).when(F.col("after").isNull(), F.col("before.row")).when(alike("after") > alike("before"), F.col("after.row")).otherwise(F.col("before.row"))
    return joined.select("host", "path", better.alias("partner")).where("partner IS NOT NULL")


def main_text(pages: DataFrame, mirror: float = 0.8) -> DataFrame:
    """page_id, url, text and n_chars of every page row.

    Menus, headers, footers, notices, adverts, forms, comments and scripts go by element and by the words
    of class, id and role. Pages are paired with the nearest URL path of their host; query, fragment,
    extension and trailing slash do not count, so copies of one address are no pair. Lines that a longest common
    subsequence finds on both are deleted unless they stand in a marked article (see main_lines). Null html or
    url, hosts with one path and repeated rows are allowed: such a page is left undifferenced; null html gives
    an empty text. Other columns are not read.
    """
    # Text lies better compressed in files than in a shuffle; hashes of lines do not compress and are made where they are asked for.
    rows = staged(parsed(pages).withColumn("row", F.monotonically_increasing_id()), compression="zstd")
    asks = F.coalesce(F.col("host") != "", F.lit(False))
    bare = rows.where(asks)
    keys = rows.where("host <> ''").groupBy("host", "path").agg(F.min("row").alias("row"))
    near = small(staged(bare.select("row", "host", "path").join(nearest(keys), ["host", "path"]).select("row", "partner")), 16)
    other = line_hashes(rows).select(F.col("row").alias("partner"), F.col("hashes").alias("other"))
    # Pages that ask for no partner stay out of the join.
    paired = packed(bare).join(other.join(near, "partner").select("row", "other"), "row", "left").select("page_id", "url", "lines", "other")
    paired = paired.unionByName(packed(rows.where(~asks)).select("page_id", "url", "lines", F.lit(None).cast("binary").alias("other")))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        press = zstandard.ZstdDecompressor()
        for b in batches:
            own = [split_lines(press.decompress(x).decode()) for x in b.column("lines").to_pylist()]
            others = [None if x is None else np.frombuffer(x, np.int64).tolist() for x in b.column("other").to_pylist()]
            texts = [" ".join(main_lines(g, o, mirror)) for g, o in zip(own, others, strict=True)]
            yield batch(schema, b.column("page_id"), b.column("url"), texts, list(map(len, texts)))

    return paired.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
