"""HTML extraction by markup, and by nearest-URL page differencing for pages without an article element.

A page is cut into text lines (blocks); its markup says of each line whether it stands in
an article, and lines in menus, headers, footers, sidebars, forms, adverts, notices and
reader comments go at once.  Pages are then sorted by host and path; each is paired with
the neighbour of its host whose path shares the longer beginning, the lines of the two are
aligned by longest common subsequence, and shared lines are deleted as template text.

Differencing alone can't give right results: an advert that only one page shows isn't
shared, two copies of an article share all of it, and pages of a host quote each other.
So shared lines inside an article element stay, and a pair that shares over half of the
text of either page is taken for copies and loses nothing.

Pages are dealt by ranges of (host, path, page): a host of any size spreads over tasks.
The ranges come from urls and ids alone, and a page at the edge of a range also goes to
the next range as a neighbour, so results don't hang on where ranges end.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import read
from evidentia.llm.url_filter import host_and_path

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_SPACE = re.compile(r"\s+")

#: Elements whose content is not text of the page.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "title", "textarea", "xmp"}
#: Elements that are never part of the main text.
OUTSIDE = {"nav", "header", "footer", "aside", "form", "select", "button", "menu", "dialog", "head", "fieldset", "label", "datalist"}
#: Names of class, id or role that say the same, by themselves or as the last word of a compound (site-header).
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "header", "masthead", "footer", "contentinfo", "sidebar", "complementary", "aside", "related", "widget", "share", "sharing", "social", "notice", "notices",
    "cookie", "cookies", "consent", "newsletter", "subscribe", "popup", "modal", "alert", "comment", "comments", "replies", "disqus", "search", "form", "toolbar", "pagination",
}
#: Compounds of these two are outside as well (ad-slot, comment-list).
OUTSIDE_FIRST = {"ad", "ads", "advert", "nav", "menu", "sidebar", "footer", "cookie", "related", "share", "social", "comment", "comments", "newsletter", "breadcrumb", "promo", "sponsored"}
HOLDERS = {"container", "wrapper", "wrap", "area", "list", "box", "block", "bar", "section", "item", "items", "links", "buttons", "posts", "signup", "left", "right", "top", "bottom", "slot", "unit", "inner"}
#: Compounds that begin so are headers and the like of the article itself, and stay (entry-header).
OWN_FIRST = {"article", "post", "entry", "content", "story"}
OWN_LAST = {"header", "banner", "footer", "notice", "alert"}
BLOCK = {
    "address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr",
    "html", "legend", "li", "main", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def _named_outside(name: str) -> bool:
    """Whether a single class, id or role says that an element is no main text."""
    if name in OUTSIDE_NAMES:
        return True
    words = re.split(r"[-_]+", name)
    first, last = words[0], words[-1]
    if len(words) > 1 and last in OUTSIDE_NAMES:
        return not (first in OWN_FIRST and last in OWN_LAST)
    return len(words) == 2 and first in OUTSIDE_FIRST and last in HOLDERS


def _is_outside(name: str, attrs: str, in_article: bool) -> bool:
    if name in OUTSIDE:
        return not (name == "header" and in_article)  # an article's header holds its title
    if name in ("html", "body", "article", "main") or not attrs:
        return False
    return any(_named_outside(w) for _, v in _ATTR.findall(attrs) for w in v.strip("\"'").lower().split())


def lines(page: str) -> list[tuple[str, int]]:
    """Text lines of a page in order, without what stands outside the main text; 2: in an article, 1: in main, 0: elsewhere."""
    out: list[tuple[str, int]] = []
    buf: list[str] = []
    article = main = 0
    skip, depth = "", 0
    at, end = 0, len(page)
    low = None

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(buf))).strip(" ")
        buf.clear()
        if text:
            out.append((text, 2 if article else 1 if main else 0))

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            break
        if not skip:
            buf.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closing = bool(m[1])
        if name in RAW and not closing:
            low = page.lower() if low is None else low
            stop = low.find(f"</{name}", at)
            at = end if stop < 0 else max(low.find(">", stop) + 1, stop + 1)
            continue
        if skip:
            if name == skip:
                depth += -1 if closing else name not in VOID
            elif closing and name in ("article", "main", "body", "html"):
                depth = 0
            if depth > 0:
                continue
            skip = ""
            if name not in ("article", "main", "body", "html"):
                continue
        if name in BLOCK or name in OUTSIDE:
            flush()
        if closing:
            article -= name == "article" and article > 0
            main -= name == "main" and main > 0
        elif name not in VOID and not m[3].endswith("/") and _is_outside(name, m[3], article > 0):
            flush()
            skip, depth = name, 1
        else:
            article += name == "article"
            main += name == "main"
    if not skip:
        buf.append(page[at:])
    flush()
    best = max((k for _, k in out), default=0)
    return [x for x in out if x[1] == best]


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    head, tail = list(range(lo)), list(range(len(a) - hi, len(a)))
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not a or not b:
        return head + tail
    if len(a) > 1 and len(a) * len(b) > 50_000_000:  # too many rows of bits to keep: split as Hirschberg does
        half = len(a) // 2
        first, last = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: first[j] + last[len(b) - j])
        left, right = common_lines(a[:half], b[:cut]), common_lines(a[half:], b[cut:])
        return head + [lo + i for i in left] + [lo + half + i for i in right] + tail
    rows = list(_rows(a, b))
    j, mid = len(b), []
    for i in range(len(a) - 1, -1, -1):
        # a zero bit of a row says that the common length grows there
        below = rows[i - 1] if i else -1
        mask = (1 << j) - 1
        if j and _zeros(rows[i], mask) > _zeros(below, mask):
            while a[i] != b[j - 1] or _zeros(rows[i], (1 << (j - 1)) - 1) == _zeros(rows[i], (1 << j) - 1):
                j -= 1
            mid.append(lo + i)
            j -= 1
    return head + mid[::-1] + tail


def _zeros(row: int, mask: int) -> int:
    return mask.bit_length() - (row & mask).bit_count()


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    """Bit-parallel rows of the table of common lengths: bit j is 0 where the length grows from b[:j] to b[:j + 1]."""
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: list[str], b: list[str]) -> list[int]:
    for v in _rows(a, b):
        pass
    out = [0]
    for j in range(len(b)):
        out.append(out[-1] + (not v >> j & 1))
    return out


def difference(own: list[str], other: list[str], protected: bool) -> list[str]:
    """``own`` without the lines that ``other`` shares; all of it if ``protected`` or if the two look like copies."""
    if protected or not own or not other:
        return own
    shared = set(common_lines(own, other))
    size = sum(len(own[i]) for i in shared)
    if 2 * size > min(sum(map(len, own)), sum(map(len, other))):
        return own
    return [x for i, x in enumerate(own) if i not in shared]


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _key(host: str, path: str, page_id) -> tuple:
    return host, path, page_id is not None, 0 if page_id is None else page_id


def _ranges(keys: DataFrame, n: int) -> tuple[list[tuple], list[tuple]]:
    """First and last keys of at most ``n`` ranges of about as many pages; ``n`` rows reach the driver."""
    d = keys.repartitionByRange(n, "host", "path", "page_id").withColumn("part", F.spark_partition_id())
    key = F.struct("host", "path", "page_id")
    found = d.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last")).collect()
    return tuple(sorted(_key(*r[c]) for r in found) for c in ("first", "last"))


def extract(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """page_id, url, text, n_chars of ``pages`` (page_id, url, html, ...).

    Null and empty html give empty text.  A page without host, or alone on its host, is
    not differenced.  White space of any kind, no-break spaces included, becomes one space
    inside a block.  Tags, attributes and references that are broken are read as browsers
    do, or left as text.  Of neighbours whose paths are alike equally far, the one before
    counts.  Repeated rows each stay; with equal urls and ids they are neighbours, and
    copies.  Pages of any length are read whole.  An empty table gives an empty one; other
    columns are ignored, whatever their names.  ``ranges``, by default the session's shuffle
    partitions, spreads the work and changes no result.
    """
    spark = pages.sparkSession
    id_type = pages.schema["page_id"].dataType.simpleString()
    host, path = host_and_path(F.col("url"))
    d = pages.select("page_id", "url", host.alias("host"), path.alias("path"), F.coalesce("html", F.lit("")).alias("html"))
    firsts, lasts = _ranges(d.select("host", "path", "page_id"), ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, url, host, path, page in zip(b["page_id"].astype(object).where(b["page_id"].notna(), None), b["url"], b["host"], b["path"], b["html"], strict=True):
                found = lines(page)
                row = (page_id, url, host, path, [x for x, _ in found], bool(found) and found[0][1] == 2)
                key = _key(host, path, page_id)
                part = min(bisect_left(lasts, key), len(lasts) - 1)
                rows.append((*row, part, True))
                if part + 1 < len(lasts) and key == lasts[part]:
                    rows.append((*row, part + 1, False))
                if part and key == firsts[part]:
                    rows.append((*row, part - 1, False))
            yield pd.DataFrame(rows, columns=["page_id", "url", "host", "path", "lines", "protected", "part", "own"])

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = here = None  # of the page before, and of the page whose turn it is once its next one is known

        def done(before, here, after) -> tuple:
            near = [x for x in (before, after) if x is not None and here.host and x.host == here.host and x.part == here.part]
            other = max(near, key=lambda x: _alike(x.path, here.path), default=None)
            text = " ".join(difference(list(here.lines), list(other.lines) if other else [], here.protected))
            return here.page_id, here.url, text, len(text)

        for b in batches:
            out = []
            b["page_id"] = b["page_id"].astype(object).where(b["page_id"].notna(), None)
            for after in b.itertuples(index=False):
                if here is not None and here.own:
                    out.append(done(before, here, after))
                before, here = here, after
            yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"])
        if here is not None and here.own:
            yield pd.DataFrame([done(before, here, None)], columns=["page_id", "url", "text", "n_chars"])

    d = d.mapInPandas(cut, f"page_id {id_type}, url string, host string, path string, lines array<string>, protected boolean, part int, own boolean")
    d = d.repartitionById(max(1, len(lasts)), F.col("part")).sortWithinPartitions("part", "host", "path", "page_id", "lines")
    return d.mapInPandas(pair, f"page_id {id_type}, url string, text string, n_chars long")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(read(spark, sf_dir, "pages"))
