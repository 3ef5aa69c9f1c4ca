"""Main text of web pages by line-block distribution.

Markup becomes lines: scripts, styles, comments and the like are dropped, every block
element starts a line, inline markup leaves nothing. Elements that say of themselves
that they are menus, headers, footers, sidebars, notices, adverts, forms or reader
comments give no lines; they say so by element, or by a whole word of class, id or role.

Every line weighs as much as its text outside links has letters, and the weights are
summed over sliding windows of ``WINDOW`` lines. Where a sum surges over ``surge`` text
begins, where the sums dive to nothing it ends, and the lines between are kept, short ones
included. Where a page marks its article, a line of it weighs as much as all its text,
lists of links too, and any weight surges, while the other lines weigh nothing and are
never kept. Of a page that marks no article, the heaviest stretch is kept with those that
have at least ``SHARE`` of its weight; stretches that only lines within links part count
as one, and those lines stay.

Character references are decoded after the markup is gone, white space within a line
becomes one space, and the lines are joined by line feeds. The scan is linear in the
length of the page whatever it holds: a tag whose quotes hide its end twice over makes
the rest of the page be read without regard to quotes.

Defined cases: null or empty html gives empty text; a page without markup is one line;
unclosed and wrongly nested elements end with the element around them; a page with
links only has no text unless it marks them as its article; repeated rows each give a row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SURGE, SHARE = 3, 40, 0.3
STEP_BYTES = 4_000_000  # of html that is worked on at a time

START = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
SPECIAL = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

#: Their content is no markup.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe", "template", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements that never hold article text, and those that don't outside an article.
APART = {"nav", "aside", "footer", "form", "button", "select", "svg", "object", "dialog", "menu", "canvas", "audio", "video", "head", "fieldset"}
APART_OUTSIDE = {"header"}
#: Whole words of class, id and role that say the same.
NAMES = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|global|cookies?|consent|privacy|user|reader|post|article)[-_]?)?"
    r"(?:ads?|advert|adverts|advertisements?|sponsored|promo|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|aside|footer|masthead|notices?|"
    r"cookies?|consent|gdpr|popup|modal|newsletter|signup|login|share|social|comments?|commentlist|replies|disqus|pagination|"
    r"complementary|contentinfo|form|hidden)"
    r"(?:[-_]?(?:box|area|section|list|wrapper|container|bar|block|thread|buttons?|form|links))?",
    re.I,
)
NAMES_OUTSIDE = re.compile(r"(?:site|page)?[-_]?header", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ARTICLE = re.compile(r"(?:^|\s)(?:articleBody|main)(?:$|\s)", re.I)
#: An open one of these ends where the other begins.
ENDS = {"p": BLOCK - {"table"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}


def marked(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is apart from the article, and whether it is the article."""
    apart = tag in APART or (not inside and tag in APART_OUTSIDE)
    article = tag in ("article", "main")
    if attributes and not apart and tag not in ("html", "body"):
        given = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
        names = " ".join(given.get(k, "") for k in ("class", "id", "role"))
        article = article or bool(ARTICLE.search(given.get("itemprop", "") + " " + given.get("role", "")))
        if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or HIDDEN.search(given.get("style", "")):
            apart = True
        elif names.strip() and not article:
            apart = any(NAMES.fullmatch(n) or (not inside and NAMES_OUTSIDE.fullmatch(n)) for n in names.split())
    return apart, article and not apart


class Tags:
    """The tags of a page, from left to right."""

    def __init__(self, html: str):
        self.html, self.last, self.hidden = html, html.rfind(">"), 0

    def end_of(self, at: int) -> int:
        """Behind the next > outside quotes; there is one behind ``at``, if within them."""
        html, start = self.html, at
        while self.hidden < 2:
            found = SPECIAL.search(html, at)
            if not found:
                self.hidden += 1
                break
            if found[0] == ">":
                return found.end()
            close = html.find(found[0], found.end())
            at = close + 1 if close >= 0 else found.end()
        return html.index(">", start) + 1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, end, name, whether it closes, attributes) of the next tag; the name is
        empty for comments and the like."""
        while True:
            found = START.search(self.html, at)
            if not found:
                return None
            comment, section, other, closing, name = found.groups()
            if comment or section:
                mark = "-->" if comment else "]]>"
                end = self.html.find(mark, found.end())
                return found.start(), len(self.html) if end < 0 else end + 3, "", False, ""
            if found.end() > self.last:
                return None  # no tag ends here or later
            if other:
                return found.start(), self.html.index(">", found.end()) + 1, "", False, ""
            end = self.end_of(found.end())
            return found.start(), end, name.lower(), bool(closing), self.html[found.end() : end - 1]


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """(text, characters outside links, whether in a marked article) of every line."""
    lines: list[tuple[str, int, bool]] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, apart, article
    blocks: list[int] = []  # places of block elements in it
    number: Counter[str] = Counter()  # of open elements by tag
    parts: list[tuple[str, bool]] = []
    apart = article = links = heading = 0

    def push(tag: str, is_apart: bool, is_article: bool) -> None:
        nonlocal apart, article, links, heading
        if tag in BLOCK:
            blocks.append(len(open_))
        open_.append((tag, is_apart, is_article))
        number[tag] += 1
        apart += is_apart
        article += is_article
        links += tag == "a"
        heading += tag in HEADINGS

    def pop() -> None:
        nonlocal apart, article, links, heading
        tag, is_apart, is_article = open_.pop()
        if tag in BLOCK:
            blocks.pop()
        number[tag] -= 1
        apart -= is_apart
        article -= is_article
        links -= tag == "a"
        heading -= tag in HEADINGS

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(t for t, _ in parts)).split())
            if text:
                free = " ".join(unescape("".join(t for t, linked in parts if not linked)).split())
                lines.append((text, len(free), article > 0))
            parts.clear()

    at, length, tags = 0, len(html), Tags(html)
    while at < length:
        found = tags.next(at)
        start, end, tag, closing, attributes = found or (length, length, "", False, "")
        if start > at and not apart:
            parts.append((html[at:start], links > 0 and not heading))
        at = end
        if not tag:
            continue
        if tag in BLOCK:
            flush()
        elif tag == "br" and not apart:
            parts.append((" ", False))
        if closing:
            if number[tag]:
                while open_[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            ends = re.compile(rf"</{re.escape(tag)}\b", re.I).search(html, at)
            close = html.find(">", ends.end()) if ends else -1
            at = close + 1 if close >= 0 else length
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        while open_ and tag in ENDS.get(open_[-1][0], ()):
            pop()
        if tag in BLOCK and open_ and open_[-1][0] not in BLOCK and blocks and tag in ENDS.get(open_[blocks[-1]][0], ()):
            # Inline elements left open end with the paragraph that a new one ends.
            below = blocks[-1]
            while len(open_) > below:
                pop()
        push(tag, *marked(tag, attributes, article > 0))
    flush()
    return lines


def stretches(weight: np.ndarray, surge: int) -> list[tuple[int, int]]:
    """Lines from each surge point to its dive point: the sum over the windows that
    hold a line exceeds ``surge`` somewhere, and is nothing just outside."""
    sums = np.convolve(weight, np.ones(WINDOW), "full")  # windows that end at a line or after
    out, at = [], 0
    while at < len(weight):
        if not weight[at]:
            at += 1
            continue
        end, top = at, 0.0
        while end < len(weight) and sums[end : end + 1].max() > 0:
            top = max(top, sums[end])
            end += 1
        while not weight[end - 1]:
            end -= 1
        if top >= surge:
            out.append((at, end))
        at = end + 1 if end < len(weight) else end
    return out


def bridged(found: list[tuple[int, int]], weight: np.ndarray) -> list[tuple[int, int]]:
    """Stretches with nothing but lines within links between them as one."""
    out: list[tuple[int, int]] = []
    for a, b in found:
        if out and not weight[out[-1][1] : a].any():
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    lines = lines_of(html)
    if not lines:
        return ""
    marks = np.array([inside for _, _, inside in lines], bool)
    if marks.any():
        weight = np.array([len(text) if inside else 0 for text, _, inside in lines], float)
        found = stretches(weight, 1)
    else:
        marks[:] = True
        weight = np.array([free for _, free, _ in lines], float)
        found = bridged(stretches(weight, SURGE) or stretches(weight, 1), weight)
        heavy = [weight[a:b].sum() for a, b in found]
        found = [x for x, h in zip(found, heavy) if h >= SHARE * max(heavy)]
    return "\n".join(lines[i][0] for a, b in found for i in range(a, b) if marks[i])


def steps(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about ``STEP_BYTES`` of the column ``at``, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + STEP_BYTES, "right")))
        yield batch.slice(first, end - first)
        first = end


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text as column ``out``, which replaces one of the name."""
    kept = [c for c in pages.columns if c.lower() != out.lower()]
    at = kept.index(html)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole, at):
                text = pa.array([main_text(x) for x in batch.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*kept, out])

    return pages.select(*(pages[c] for c in kept)).mapInArrow(run, f"{fields}, `{out}` string")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
