"""Main text of web pages: lines of the page, less what markup sets aside, less lines shared with the nearest page.

Pages are paired by URL: of the neighbours in the order of path within the host, the one that shares more of the
path. The lines of both are aligned by a longest common subsequence. Lines inside the article element are the article's own and stay;
of the other lines that markup does not set aside, those that both pages share are deleted.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitchenlight.llm.common import stored
from kitchenlight.llm.ordering import with_neighbours

# ---- lines of a page ----

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][\w:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([\w:-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_SPACE = set("br td th img".split())
_HOLDERS = set("html body div section article main nav header footer aside form ul ol dl table thead tbody tfoot tr td th figure blockquote details dialog fieldset center menu button select object figcaption".split())
_SET_ASIDE = set("nav footer aside form dialog menu button select object head".split())
# Words of class and id names; the first kind sets a block aside anywhere, the second outside the article only.
_ASIDE_WORDS = "ads?|adverts?|advertisement|advertising|sponsor|sponsored|promo|promotion|comments?|replies|disqus|respond|share|sharing|social|related|recommended|newsletter|subscribe|signup|cookies?|consent|gdpr|popup|modal|overlay|sidebar|sidenav|pagination|pager|breadcrumbs?|toolbar|notice|notices|banner|alert"
_FRAME_WORDS = "header|masthead|footer|nav|navbar|navigation|navi|menu|topbar|search|login|skip|copyright|legal|widget|widgets|tags|meta"
_NAME = r"^(?:(?:site|page|global|top|main|left|right|bottom|user|reader|post|blog|article|sticky|js|the|google|side|cookies?|privacy|email|share|comments?|ad)[-_])*(?:%s)(?:[-_]?(?:box|bar|list|area|wrap|wrapper|container|section|block|inner|content|contents|item|link|links|slot|unit|form|text|message|\d+))*$"
_ASIDE_NAME, _FRAME_NAME = (re.compile(_NAME % words, re.I) for words in (_ASIDE_WORDS, _FRAME_WORDS))
_ASIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())

ASIDE, ARTICLE, MAIN, OPEN = range(4)


def _is_aside(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _SET_ASIDE or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name in ("class", "id"):
            if any(_ASIDE_NAME.match(v) or not inside and _FRAME_NAME.match(v) for v in value.split()):
                return True
        elif name == "role" and value.lower() in _ASIDE_ROLES and not (inside and tag == "header"):
            return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def page_lines(page: str) -> list[tuple[int, str]]:
    """``(kind, text)`` of each block of a page that has text, in order; kinds are ``ASIDE``, ``ARTICLE``, ``MAIN``, ``OPEN``."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool]] = []  # open holders and set-aside elements; whether they set aside
    depth = {"aside": 0, "article": 0, "main": 0}

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                kind = ASIDE if depth["aside"] else ARTICLE if depth["article"] else MAIN if depth["main"] else OPEN
                out.append((kind, text))

    def push(tag: str, aside: bool) -> None:
        stack.append((tag, aside))
        depth["aside"] += aside
        if tag in ("article", "main"):
            depth[tag] += 1

    def pop() -> None:
        tag, aside = stack.pop()
        depth["aside"] -= aside
        if tag in ("article", "main"):
            depth[tag] -= 1

    def close(tag: str, barrier: tuple[str, ...] = ()) -> None:
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == tag:
                while len(stack) > at:
                    pop()
                return
            if stack[at][0] in barrier:
                return

    at = 0
    while m := _MARKUP.search(page, at):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        slash, tag, attributes = m[1] or m[4] or "", (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if not tag:
            continue
        if tag in _RAW and not slash:
            end = _RAW[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _SPACE:
            parts.append(" ")
        elif tag not in _INLINE:
            flush()
        if slash:
            if tag in _HOLDERS or any(t == tag for t, _ in stack):
                flush()
                close(tag)
            continue
        if tag in _VOID or attributes.endswith("/") and tag not in _HOLDERS:
            continue
        if tag not in _INLINE:
            close("p", tuple(_HOLDERS))
            if tag in ("li", "dt", "dd"):
                close(tag, ("ul", "ol", "dl", "menu"))
        aside = _is_aside(tag, attributes, bool(depth["article"] or depth["main"]))
        if tag in _HOLDERS or aside:
            if aside:
                flush()
            push(tag, aside)
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def candidates(lines: list[tuple[int, str]]) -> tuple[list[int], set[int]]:
    """Positions of the lines that may be main text, and those of them that differencing may not delete.

    With an article element, its lines and those of the main element around it; else those of the main element; else
    every line that markup does not set aside.
    """
    kinds = {kind for kind, _ in lines}
    wanted = {ARTICLE, MAIN} if kinds & {ARTICLE, MAIN} else {OPEN}
    chosen = [i for i, (kind, _) in enumerate(lines) if kind in wanted]
    return chosen, {i for i in chosen if lines[i][0] == ARTICLE}


# ---- pairing and alignment ----


def url_key(url: str | None) -> tuple[str, str]:
    """Host and path of a URL: lower-case host without ``www.``, path without query, fragment, ending slash or suffix."""
    rest = (url or "").split("#", 1)[0].split("?", 1)[0]
    rest = rest.split("://", 1)[-1]
    host, _, path = rest.partition("/")
    path = re.sub(r"(?:/index)?\.(?:html?|php|aspx?)$", "", path.rstrip("/"), flags=re.I)
    return re.sub(r"^www\.", "", host.lower()), path


def shared_path(a: str, b: str) -> tuple[int, int]:
    """How near two paths are: equal leading segments, then equal leading characters."""
    x, y = a.split("/"), b.split("/")
    segments = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    letters = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
    return segments, letters


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b, offset = a[head:], b[head:], head
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    kept_tail = list(range(offset + len(a) - tail, offset + len(a)))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []  # the least end in b of a common subsequence of each length
    links: list[tuple] = []  # its last pair and the chain before it
    for i, line in enumerate(a):
        for j in places.get(line, ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    middle = []
    link = links[-1] if links else None
    while link:
        middle.append(offset + link[0])
        link = link[1]
    return [*range(head), *reversed(middle), *kept_tail]


def _partner(row) -> list[int] | None:
    """Lines of the nearer neighbour of the host, which never has the very same lines."""
    options = []
    for side, near in ((1, row.before), (0, row.after)):
        if near is not None and near["host"] == row.host:
            options.append((shared_path(near["path"], row.path), side, list(near["lines"])))
    return max(options)[2] if options else None


LINES = "page_key long, host string, path string, lines array<int>, lines_key long, open array<int>"


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"),
        F.xxhash64("page_id", "url", "html").alias("page_key"),
    )


def shared_lines(pages: DataFrame) -> DataFrame:
    """``(page_key, shared, n_aligned)``: deletable lines shared with the nearest page, and how many lines align in all.

    Only checksums of lines travel. Pages of a host with the very same lines tell each other nothing, so the first of them by
    path is aligned with the nearest page that differs, and what it shares holds for all of them: copies give equal texts, however many there are.
    """

    def checksums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, url, page in zip(batch["page_key"], batch["url"], batch["html"]):
                lines = page_lines(page)
                chosen, own = candidates(lines)
                sums = [zlib.crc32(t.encode("utf-8", "surrogatepass")) - (1 << 31) for _, t in lines]
                lines_key = xxhash.xxh64_intdigest("\n".join(t for _, t in lines).encode("utf-8", "surrogatepass"))
                rows.append((key, *url_key(url), sums, lines_key - (1 << 63), [i for i in chosen if i not in own]))
            yield pd.DataFrame(rows, columns=["page_key", "host", "path", "lines", "lines_key", "open"])

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                partner = _partner(row)
                rows.append((row.host, row.lines_key, common_lines(list(row.lines), partner) if partner is not None else []))
            yield pd.DataFrame(rows, columns=["host", "lines_key", "aligned"])

    found = stored(_keyed(pages).mapInPandas(checksums, LINES), "lines")
    first = found.groupBy("host", "lines_key").agg(F.min(F.struct("path", "page_key")).alias("first")).select("first.page_key")
    apart = found.join(first, "page_key", "left_semi").dropDuplicates(["page_key"])
    near = with_neighbours(apart, ["host", "path", "page_key"], ["host", "path", "lines"])
    aligned = near.mapInPandas(align, "host string, lines_key long, aligned array<int>")
    rows = found.select("page_key", "host", "lines_key", "open").dropDuplicates(["page_key"]).join(aligned, ["host", "lines_key"])
    return rows.select("page_key", F.array_intersect("aligned", "open").alias("shared"), F.size("aligned").alias("n_aligned"))


def main_text(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points) and n_aligned (lines aligned with the nearest page).

    Blocks are in page order, their white space collapsed, joined by line breaks. A null or empty page gives an empty text; a null
    URL is a host of its own; copies (equal lines) of a host lose the same lines; of equal lines each is aligned once; repeated rows come back each; extra columns are ignored.
    """

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blocks = []
            for page in batch["html"]:
                lines = page_lines(page)
                blocks.append([{"i": i, "t": lines[i][1]} for i in candidates(lines)[0]])
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "page_key": batch["page_key"], "blocks": pd.Series(blocks, dtype=object, index=batch.index)})

    found = _keyed(pages).mapInPandas(texts, "page_id long, url string, page_key long, blocks array<struct<i int, t string>>")
    joined = found.join(shared_lines(pages), "page_key")
    kept = F.filter("blocks", lambda b: ~F.array_contains("shared", b["i"]))
    text = F.array_join(F.transform(kept, lambda b: b["t"]), "\n")
    return joined.select("page_id", "url", text.alias("text"), "n_aligned").select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_aligned")
