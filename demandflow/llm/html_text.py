"""Main text of HTML pages by two passes of block rules.

Markup is read as a stream of tags and text. Block-level elements end blocks;
inline ones do not. Scripts, styles, forms, comments in markup and the like
have no text. Blocks inside navigation, headers, footers, asides, adverts,
notices and reader comments (by element, role or class) are boilerplate.

First pass, on the other blocks: in a page with an article (a main element, or a
block that is named content), blocks outside it are boilerplate, blocks inside are content; items that are
nearly all link text are boilerplate. In a page without one, blocks with a high
share of link text are boilerplate, and length and stop-word density decide:
long blocks, and blocks with enough stop words, are content. Headings and
short blocks without links stay ambiguous.
Second pass: an ambiguous block takes the label of the nearest decided block
(ties, and pages where nothing is decided: content).

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one newline in page order.

Defined results: null and empty pages have empty text; unclosed comments and
scripts reach to the end of the page; a ``<`` that opens no tag is text;
repeated rows are read each; null ids and urls stay null; a very long page is
read as a whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import ship_code

SLICE_BYTES = 4 << 20

_RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp|noscript|template|svg|math|select|object|canvas"
_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<!\[CDATA\[(?s:.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+(?:/>|>(?s:.*?)(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|(?P<text>[^<]+|<)", re.IGNORECASE)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_WORD = re.compile(r"[^\W\d_]+")

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset(("article", "main"))
BOILERPLATE = frozenset("nav aside footer form menu dialog head button fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar alert dialog".split())
HINTS = frozenset("""ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs
 masthead footer cookie cookies consent notice notices alert popup modal overlay comment comments reply replies disqus share sharing social related recommended
 newsletter subscribe signup login widget pagination pager toolbar topbar copyright legal disclaimer gdpr privacy side rail teaser promoted discussion responses respond feedback""".split())
HINT_STARTS = ("comment", "advert", "sponsor", "cookie", "newsletter", "breadcrumb", "sidebar", "navbar", "navig")
CONTENT_NAMES = frozenset("content main main-content main_content maincontent article article-body article-content post-content post-body entry-content story story-body".split())
STOP_WORDS = frozenset("""a about all also an and are as at be because been but by can for from had has have he her his i if in into is it its more no not of on one or our out
 she so some than that the their them then there they this to was we were what when which who will with you your
 der die das den dem des ein eine einer eines einem einen und ist im mit von zu auf für nicht auch sich es an als wie aus bei nach über oder aber wird sind war hat
 le la les un une des du de et est que qui dans pour pas sur au aux avec par en ce il elle se ne plus ou mais son sa ses
 el los las una unos del y es por con para no su al lo como más pero sus se""".split())

SHORT, LONG = 60, 150
LINK_SHARE, ITEM_LINK_SHARE = 0.33, 0.8
STOP_SHARE, LONG_STOP_SHARE = 0.2, 0.05


def _is_boilerplate(name: str, attrs: str, inside_content: bool) -> bool:
    if name in BOILERPLATE or (name == "header" and not inside_content):
        return True
    if not attrs or name in ("body", "html"):
        return False
    for kind, *values in _ATTR.findall(attrs):
        kind, value = kind.lower(), "".join(values)
        if kind == "hidden" or (kind == "aria-hidden" and value.lower() == "true") or (kind == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE)):
            return True
        if kind == "role" and value.lower() in ROLES:
            return True
        if kind in ("class", "id"):
            for one in value.split():
                parts = [p.lower() for p in _PART.findall(one)]
                if parts and parts[0] not in ("has", "no", "with", "without") and any(p in HINTS or p.startswith(HINT_STARTS) for p in parts):
                    return True
                if "header" in parts and not inside_content and name not in CONTENT:
                    return True
    return False


def _is_content(name: str, attrs: str) -> bool:
    if name in CONTENT:
        return True
    values = ("".join(v) for kind, *v in _ATTR.findall(attrs) if kind.lower() in ("class", "id")) if attrs and name in ("div", "section") else ()
    return any(not CONTENT_NAMES.isdisjoint(v.lower().split()) for v in values)


def blocks_of(page: str) -> list[tuple[str, int, str, bool, bool]]:
    """(text, characters of it in links, name of its element, in boilerplate, in an article) of each block in page order."""
    found, text, linked, links, breaks = [], [], 0, 0, 0
    stack = [("", False, False)]
    name_now = ""

    def flush() -> None:
        nonlocal linked, breaks
        whole = " ".join(html.unescape("".join(text)).split())
        if whole:
            found.append((whole, linked, name_now, stack[-1][1], stack[-1][2]))
        text.clear()
        linked = breaks = 0

    for m in _TOKEN.finditer(page):
        if m["text"] is not None:
            text.append(m["text"])
            if links:
                linked += len(" ".join(html.unescape(m["text"]).split()))
            if breaks and not m["text"].isspace():
                breaks = 0
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name == "br":
            breaks += 1
            if breaks > 1:
                flush()
            text.append(" ")
            continue
        if name == "a":
            links = 0 if m["end"] else 1
            continue
        if name in BLOCKS:
            flush()
            name_now = "" if m["end"] else name
        if m["end"]:
            if any(s[0] == name for s in reversed(stack)):
                while stack[-1][0] != name:
                    stack.pop()
                stack.pop()
                if name in BLOCKS:
                    name_now = stack[-1][0]
        elif name not in VOID and (name in BLOCKS or name in BOILERPLATE or name == "span") and not m["attrs"].endswith("/"):
            if name in BLOCKS and stack[-1][0] == "p":
                stack.pop()
            _, boiler, content = stack[-1]
            own = _is_boilerplate(name, m["attrs"], content)
            if own and not boiler and name not in BLOCKS:
                flush()
            stack.append((name, boiler or own, content or _is_content(name, m["attrs"])))
    flush()
    return found


def main_text(page: str | None) -> str:
    """The text of a page's content blocks."""
    blocks = blocks_of(page or "")
    article = any(content and not boiler for *_, boiler, content in blocks)
    labels: list[bool | None] = []
    for text, linked, name, boiler, content in blocks:
        share = linked / len(text)
        if boiler or (article and not content):
            label = False
        elif article:
            label = False if name == "li" and share > ITEM_LINK_SHARE else True if len(text) >= SHORT else None
        elif share > LINK_SHARE or (linked and len(text) < SHORT):
            label = False
        elif name in HEADINGS or len(text) < SHORT:
            label = None
        else:
            words = _WORD.findall(text.lower())
            stop = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
            label = True if stop >= STOP_SHARE or (len(text) >= LONG and stop >= LONG_STOP_SHARE) else False if stop < LONG_STOP_SHARE and len(text) < LONG else None
        labels.append(label)
    before, after = [], []
    for order, near in ((range(len(labels)), before), (range(len(labels) - 1, -1, -1), after)):
        last = None
        for i in order:
            if labels[i] is not None and not (article and not blocks[i][4]) and not blocks[i][3]:
                last = (i, labels[i])
            near.append(last)
    after.reverse()
    kept = []
    for i, block in enumerate(blocks):
        label = labels[i]
        if label is None:
            near = [x for x in (after[i], before[i]) if x]
            least = min((abs(x[0] - i) for x in near), default=0)
            label = any(x[1] for x in near if abs(x[0] - i) == least) if near else True
        if label:
            kept.append(block[0])
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in T.row_slices(batches, "html", SLICE_BYTES):
        texts = pa.array([main_text(x) for x in T.column(part, "html").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([T.column(part, "id"), T.column(part, "url"), texts], ["id", "url", "text"])


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row for each page: (id_col, url_col, text)."""
    ship_code(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_extract, f"id {id_type}, url string, text string").withColumnsRenamed({"id": id_col, "url": url_col})
