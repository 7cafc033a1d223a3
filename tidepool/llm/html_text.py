"""Op 1, HTML extraction: line-block distribution.

Markup is stripped into lines, one per block element. Elements that never
hold main text (scripts, styles, navigation, page headers and footers,
sidebars, notices, adverts, forms, comments - by tag, role, class or id)
leave empty lines, and so do the borders of an article container. The text
length is summed over a sliding window of lines: a surge is a line where the
sum rises from nothing, a dive the line where it falls back; between them lies
a block of text. Blocks inside an article container are kept when the page
has one; otherwise all from the first to the last whose densest window reaches a
fair share of the page's densest one. Every line of a kept block stays, however
short. An element dropped for a layout mark (a sidebar, a banner ...) gives up
the article container that it wraps where the page has no other.

Character references are decoded, white space inside a line becomes one
space, lines are trimmed and joined by an empty line. Extraction needs one
page at a time, so the operator is one narrow pass without any shuffle.

Defined cases: null, empty or text-free pages give an empty text; text
outside any tag counts as a block; unclosed elements end with the page, and an
element left open inside a dropped one ends with it; every input row gives
one output row; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import common

SCHEMA = "page_id long, url string, text string, n_chars long, n_lines long, n_blocks long"

#: Lines of a window, and the share of the densest window that a block's own
#: densest one must reach on pages without an article container.
WINDOW = 3
SHARE = 0.2

# A quote counts only behind "=", as in it's it belongs to the value.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")

# Elements whose content is raw text up to their own end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "canvas", "object"}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINER = {"article", "main"}
BLOCK = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
         "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main",
         "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# Words of class, id or role that mark an element as no main text.
MARKS = re.compile(
    r"^(ads?|adverts?|advertise(ment)?s?|advertising|banner|sponsor(ed)?|promo(tion)?s?|sidebar|side-bar|nav(bar|igation)?|"
    r"menu(bar)?|breadcrumbs?|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|"
    r"comments?|respond|replies|disqus|discussion|social|share|sharing|related|recommended|footer|masthead|"
    r"copyright|adsense|adsbygoogle|outbrain|taboola|pagination|pager|complementary|contentinfo|search|login|toolbar|widget|skip-link)$")


# Marks of page layout: an element may bear one and still wrap the whole article.
LAYOUT = re.compile(r"^(banner|sidebar|side-bar|nav(bar|igation)?|menu(bar)?|notices?|alert|modal|overlay|toolbar|widget|"
                    r"search|social|share|sharing|masthead|complementary)$")
# Words that only qualify what follows, as in notice-period, unless that names a box
# or place (notice-box); words that take the mark from what follows, as in with-sidebar.
QUALIFIERS = {"notice", "notices", "alert", "search", "banner", "copyright"}
BOXES = re.compile(r"^(box|bar|wrap(per)?|container|block|panel|area|section|top|bottom|left|right|main|inner|outer|list|items?|"
                   r"message|form|text|content|strip|header|footer|\d*)$")
RELATIONS = {"with", "has", "no", "without", "non", "not"}
PAGE_HEAD = re.compile(r"^(site-|page-)?header$|^top-?bar$")

#: What an open element is: nothing special, an article container, dropped for
#: its layout mark, dropped in any case.
PLAIN, HOLDS, LAYOUT_DROP, DROP = range(4)


def _mark(word: str, parted: bool) -> int:
    """What a word of class, id or role makes of its element."""
    parts = re.split(r"[-_]+", word) if parted else []
    last = len(parts) - 1
    marks = [p for i, p in enumerate(parts) if not (i and parts[i - 1] in RELATIONS)
             and not (i < last and p in QUALIFIERS and not BOXES.match(parts[i + 1]))]
    marks = [m for m in (word, *marks) if MARKS.match(m)]
    if not marks:
        return PLAIN
    return LAYOUT_DROP if all(LAYOUT.match(m) for m in marks) else DROP


def _unwanted(tag: str, attributes: str, inside: bool) -> int:
    """Does the element hold no main text? A header inside an article may
    carry its heading, one outside belongs to the page."""
    if tag in DROPPED or tag in RAW or (tag == "header" and not inside):
        return DROP
    if not attributes or tag in ("html", "body", "article", "main"):
        return PLAIN
    kind = PLAIN
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and (a or b or c) == "true"):
            return DROP
        if name == "style" and "display:none" in (a or b or c).replace(" ", "").lower():
            return DROP
        if name in ("class", "id", "role"):
            for word in (a or b or c).lower().split():
                if not inside and PAGE_HEAD.match(word):
                    return DROP
                kind = max(kind, _mark(word, name != "role"))
    return kind


def strip(page: str, unwrap: bool = False) -> tuple[list[tuple[str, bool]], bool]:
    """The page as lines, (text, inside an article container), and whether an
    element dropped for its layout mark holds a container. Dropped
    elements and container borders are runs of ``WINDOW`` empty lines. With
    ``unwrap`` such containers count."""
    lines: list[tuple[str, bool]] = []
    here: list[str] = []
    opened: list[tuple[str, int]] = []  # (tag, kind) of open elements
    places: dict[str, list[int]] = {}   # where each tag stands in it
    drops: list[int] = []               # where the dropped elements stand
    within: list[int] = []              # where the containers stand
    firm = 0                            # open elements dropped in any case
    wrapped, at = False, 0

    def push(tag: str, kind: int) -> None:
        nonlocal firm
        where = len(opened)
        opened.append((tag, kind))
        places.setdefault(tag, []).append(where)
        if kind == HOLDS:
            within.append(where)
        elif kind != PLAIN:
            drops.append(where)
            firm += kind == DROP

    def pop() -> None:
        nonlocal firm
        tag, kind = opened.pop()
        places[tag].pop()
        if kind == HOLDS:
            gap()
            within.pop()
        elif kind != PLAIN:
            drops.pop()
            firm -= kind == DROP

    def dropped() -> bool:
        # a container inside a wrapper takes its content out of the wrapper
        return bool(drops) and not (within and within[-1] > drops[-1])

    def close_line() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(here))).strip()
        here.clear()
        if text:
            lines.append((text, bool(within)))

    def gap() -> None:
        close_line()
        lines.extend([("", False)] * WINDOW)

    n, last = len(page), page.rfind(">") + 1  # no tag ends behind `last`
    while at < n:
        m = TAG.search(page, at, last)
        if m is None:
            if not dropped():
                here.append(page[at:])
            break
        if not dropped():
            here.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--") and at == last and not m[0].endswith("-->"):
                break  # a comment left open ends with the page
            continue
        tag, attributes = m[2].lower(), m[3]
        if not m[1]:
            if tag == "br" or tag == "hr":
                here.append(" ")
            if tag in VOID:
                continue
            closed = attributes.endswith("/") and tag == "svg"
            if tag in RAW and not closed:
                # raw text reaches to the element's own end tag, whatever it holds
                if not dropped():
                    gap()
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = n if end is None else end.end()
                continue
            if dropped():
                if tag in CONTAINER and not firm:
                    wrapped = True
                    if unwrap:
                        push(tag, HOLDS)
                        continue
                push(tag, PLAIN)
                continue
            if tag in CONTAINER:
                gap()
                push(tag, HOLDS)
                continue
            kind = _unwanted(tag, attributes, bool(within))
            if kind != PLAIN:
                gap()
            elif tag in BLOCK:
                close_line()
            push(tag, kind)
            continue
        where = places[tag][-1] if places.get(tag) else None
        if where is None:
            if not dropped() and tag in BLOCK:
                close_line()
            continue
        if dropped():
            if where < drops[-1] and tag not in BLOCK and tag not in CONTAINER:
                continue  # a stray inline end tag does not end the dropped element
        elif tag in BLOCK:
            close_line()
        while len(opened) > where:
            pop()
    close_line()
    return lines, wrapped


def blocks(lines: list[tuple[str, bool]]) -> list[tuple[int, int]]:
    """(surge, dive) of every run of lines whose sliding window sum is not
    nothing: lines [surge, dive)."""
    size = [len(t) for t, _ in lines]
    total, out, start = 0, [], None
    for i in range(len(size) + WINDOW):
        total += size[i] if i < len(size) else 0
        total -= size[i - WINDOW] if i >= WINDOW else 0
        if total and start is None:
            start = i
        elif not total and start is not None:
            out.append((start, i - WINDOW + 1))
            start = None
    return out


def main_text(page: str | None) -> tuple[str, int, int]:
    """(main text, its lines, its blocks) of one page."""
    if not page:
        return "", 0, 0
    lines, wrapped = strip(page)
    if wrapped and not any(own for _, own in lines):
        lines, _ = strip(page, unwrap=True)
    found = blocks(lines)
    chosen = [(a, b) for a, b in found if any(own for _, own in lines[a:b])]
    if not chosen and found:
        def density(a: int, b: int) -> int:
            return max(sum(len(t) for t, _ in lines[i:min(i + WINDOW, b)]) for i in range(a, b))
        dense = [density(a, b) for a, b in found]
        full = [i for i, d in enumerate(dense) if d >= SHARE * max(dense)]
        chosen = found[full[0]:full[-1] + 1]
    kept = [t for a, b in chosen for t, _ in lines[a:b] if t]
    return "\n\n".join(kept), len(kept), len(chosen)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array([t for t, _, _ in found], pa.string()),
             pa.array([len(t) for t, _, _ in found], pa.int64()), pa.array([n for _, n, _ in found], pa.int64()),
             pa.array([b for _, _, b in found], pa.int64())],
            ["page_id", "url", "text", "n_chars", "n_lines", "n_blocks"])


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page."""
    return common.columns(pages, page_id="long", url="string", html="string").mapInArrow(_extract, SCHEMA)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(common.table(spark, sf_dir, "pages"))
