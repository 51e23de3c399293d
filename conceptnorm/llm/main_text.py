"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams a page's events. They make lines: runs of text between block
tags, each with the number of tags met since the last. A line's ratio is its characters by its tags;
ratios are smoothed with a Gaussian, and lines above a threshold (a part of the ratios' deviation)
are the cluster of content. The region is what holds that content: the page's article elements or,
if none has a content line, its main ones; without either, the smallest container around all content
lines. Lists, tables, quotes and sections are parts of a text and so no containers. All lines of the
region and of every article are the text, short ones too, but for those in elements that their tag,
class, id or role marks as something else (menus, adverts, comments, ...).

Defined results: a null or empty page, or one without text, has the empty text; text outside any
element counts as a line; tags that are never closed end where an outer one does, or with the page;
an element that is left open by a page's end keeps its text; each row gets its own result. Other
columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA, RADIUS, THRESHOLD = 1.0, 2, 0.5

# fixed values: what HTML and common practice mark
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main nav ol option p pre section
summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("""script style noscript template head title nav footer aside form button select textarea input
iframe object svg math canvas audio video map dialog menu datalist""".split())
CONTENT = frozenset(("article", "main"))
CONTAINERS = frozenset("html body main article div center".split())
OTHER_ROLES = frozenset("""navigation banner contentinfo complementary search form menu menubar alert alertdialog
dialog tablist toolbar""".split())
OTHER_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit sponsor sponsors
sponsored sponsoring promo promos promotion promoted nav navbar navigation menu menus submenu breadcrumb breadcrumbs
sidebar sidebars aside footer footers siteheader pageheader masthead topbar toolbar cookie cookies consent gdpr notice notices
banner banners popup modal overlay newsletter subscribe subscription signup signin login register paywall share sharing
social related recommended recommendations comment comments commentlist disqus reply replies respond discussion pagination
pager widget widgets skip search copyright disclaimer""".split())
# fixed values: what an article element that holds no article is called
NO_ARTICLE = frozenset("comment comments reply replies related ad advert promo sponsored".split())


def marked_other(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element is marked as no part of an article. inside: it stands in one."""
    if tag in NO_TEXT or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "article", "main"):
        words = [x for k, v in attrs if k in ("class", "id") for x in _words(v)] if tag == "article" else []
        return bool(NO_ARTICLE.intersection(words))
    for key, value in attrs:
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and (value or "").strip().lower() in OTHER_ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value or "", re.I):
            return True
        if key in ("class", "id") and any(w in OTHER_WORDS for w in _words(value)):
            return True
    return False


def _words(value: str | None) -> list[str]:
    return [w.lower() for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])", value or "") if w]


class Lines(HTMLParser):
    """Lines of a page: (text, tags before it, open elements, in something marked as other)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...], bool]] = []
        self.kind: list[str] = []                # of each element, by number
        self.stack: list[tuple[str, int, bool]] = []
        self.path: tuple[int, ...] = ()
        self.text: list[str] = []
        self.tags = 0

    def line(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text.clear()
        if text:
            self.lines.append((text, self.tags, self.path, bool(self.stack) and self.stack[-1][2]))
            self.tags = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in BLOCK:
            self.line()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):
                self._implied(tag)
        self.tags += 1
        if tag in VOID:
            return
        other = bool(self.stack) and self.stack[-1][2]
        if not other and marked_other(tag, attrs, any(self.kind[i] in CONTENT for i in self.path)):
            if tag not in BLOCK:
                self.line()
            other = True
        number = -1
        if tag in BLOCK:
            number = len(self.kind)
            self.kind.append("other" if other else tag)
        self.stack.append((tag, number, other))
        if number >= 0:
            self.path += (number,)

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in BLOCK:
            self.line()
        self.tags += 1

    def _implied(self, tag: str) -> None:
        """An open element of the kind is ended by the next one of its kind."""
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                return self._pop(i)
            if name in BLOCK and name != "p":
                return None

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.line()
        self.tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                return self._pop(i)

    def _pop(self, i: int) -> None:
        if self.stack[i][2] and self.text:
            self.line()
        del self.stack[i:]
        self.path = tuple(n for _, n, _ in self.stack if n >= 0)

    def handle_data(self, data: str) -> None:
        self.text.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """The ratios, each a Gaussian mean of those around it; weights beyond the ends are left out."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    kernel = np.convolve(ratios, kernel)[radius:radius + len(ratios)], np.convolve(np.ones(len(ratios)), kernel)[radius:radius + len(ratios)]
    return kernel[0] / kernel[1]


def extract(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.line()
    lines = [x for x in parser.lines if not x[3]]
    if not lines:
        return ""
    ratios = smoothed(np.array([len(text) / max(1, tags) for text, tags, _, _ in lines]))
    content = ratios >= min(THRESHOLD * float(ratios.std()), float(ratios.max()))
    kind = parser.kind
    paths = [path for (_, _, path, _), c in zip(lines, content, strict=True) if c]
    held = {n for path in paths for n in path}
    articles = {n for _, _, path, _ in lines for n in path if kind[n] == "article"}
    if held & articles:
        region = articles
    elif mains := {n for n in held if kind[n] == "main"}:
        region = mains | articles
    else:
        # the element that itself holds a page's only content line isn't what stands around it
        around = os.path.commonprefix(paths) if len(paths) > 1 else paths[0][:-1]
        while around and kind[around[-1]] not in CONTAINERS:
            around = around[:-1]
        if not around:
            return " ".join(text for text, _, _, _ in lines)
        region = {around[-1]} | articles
    return " ".join(text for text, _, path, _ in lines if region.intersection(path))


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", extra: list[str] | None = None) -> DataFrame:
    """One row per page: id, the columns named in ``extra``, text."""
    kept = [id_col, *(extra or [])]
    rows = pages.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(html_col).cast("string").alias("html"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([extract(x.as_py()) for x in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*batch.schema.names[:-1], "text"])

    return rows.mapInArrow(run, f"{schema}, text string").withColumnsRenamed({f"c{i}": c for i, c in enumerate(kept)})
