"""Main text of web pages by tag path ratios.

A page is a list of blocks, each on a path of tags and classes from the root. Text length and punctuation
per block are aggregated by path, smoothed along the page and fused to one ratio per path; telling tags and
names only weigh it. Paths far above the rest mark the article's region; blocks are content whose ratio
passes a threshold, which is lower inside of the region than outside.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_with_id

#: Fixed values of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = set("script style noscript template iframe textarea title".split())
CLOSES_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main menu nav ol p pre section table ul".split()
)
CLOSES_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}}
CLOSES_LIKE |= {"td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_BOUNDS = set("ul ol dl table select".split())
#: What is seldom part of an article; ``header`` only outside of one.
SELDOM_TEXT = set("object svg math canvas audio video button select nav footer aside menu dialog".split())
SELDOM_ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
OTHER_VOICES = r"comments?|replies|reply|disqus|respond|discussions?|related|recommended|teasers?"
SELDOM_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?"
    r"|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|sidebars?|side|menus?|nav"
    r"|navbar|navigation|breadcrumbs?|footers?|masthead|share|sharing|social|newsletter|subscribe"
    rf"|subscription|signup|login|pagination|pager|widgets?|toolbar|tags|hidden|{OTHER_VOICES})(?:$|[\s_-])"
    r"|(?:^|\s)(?:(?:site|page|top)[_-])?header(?:$|\s)",
    re.I,
)
OTHER_VOICES_NAMES = re.compile(rf"(?:^|[\s_-])(?:{OTHER_VOICES})(?:$|[\s_-])", re.I)

# A quote opens a value only after "="; what is never closed reaches to the page's end. No part is read twice.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|[^>=]++|=)*+)(?P<closed>>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for tag in RAW}
_NAMED = re.compile(
    r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|style)(?![^\s=/])"
    r"(?:\s*+=\s*+(\"[^\"]*+\"?|'[^']*+'?|[^\s\"'>]++))?",
    re.I,
)
_PUNCTUATION = re.compile(r"[,.;:!?，。；：！？、]")


@dataclass(frozen=True)
class Settings:
    """``inside`` and ``outside`` are the thresholds in shares of the page's typical ratio; ``held`` is the
    share of the strong paths' text that the region holds, ``article_held`` that of an article element.
    ``seldom``, ``form`` and ``headline`` weigh telling elements, ``linked`` a character within a link;
    below ``least`` a page has no content."""

    inside: float = 0.05
    outside: float = 0.9
    held: float = 0.9
    article_held: float = 0.6
    seldom: float = 0.005
    form: float = 0.02
    headline: float = 3.0
    linked: float = 0.1
    least: float = 0.05
    kernel: tuple[float, ...] = (0.25, 0.5, 0.25)


class _Element:
    __slots__ = ("tag", "number", "parent", "path", "weight", "linked", "in_article", "scope", "holder")


@dataclass
class _Block:
    element: _Element
    parts: list[str]
    linked: int = 0
    marks: int = 0


def _attributes(attrs: str) -> dict[str, str]:
    return {n.lower(): v.strip("\"'").lower() for n, v in _NAMED.findall(attrs)} if attrs else {}


def _weight(tag: str, named: dict[str, str], in_article: bool, settings: Settings) -> float:
    if tag in SELDOM_TEXT or (tag == "header" and not in_article):
        return settings.seldom
    if named and tag not in ("body", "html"):
        telling = OTHER_VOICES_NAMES if tag in ("article", "main") else SELDOM_NAMES
        if (
            any(telling.search(named.get(name, "")) for name in ("class", "id"))
            or named.get("role") in SELDOM_ROLES
            or "hidden" in named
            or named.get("aria-hidden") == "true"
            or "display:none" in named.get("style", "").replace(" ", "")
        ):
            return settings.seldom
    return {"form": settings.form, "h1": settings.headline}.get(tag, 1.0)


class _Page:
    """Elements in page order and blocks of text; time and memory follow the page's length."""

    def __init__(self, page: str, settings: Settings):
        self.settings = settings
        self.paths: dict[tuple, int] = {}
        self.elements: list[_Element] = []
        self.blocks: list[_Block] = []
        self.open: dict[str, int] = {}
        self.current = None
        self.current = self.root = self._element("#root", "")
        self.block: _Block | None = None
        at = 0
        while at < len(page):
            token = _TOKEN.match(page, at)
            at = token.end()
            if token["text"] is not None:
                self._text(html.unescape(token["text"]))
            elif token["tag"] is not None and token["closed"]:
                tag = token["tag"].lower()
                if tag in RAW and not token["end"]:
                    self.block = None
                    end = _RAW_ENDS[tag].search(page, at)
                    at = end.end() if end else len(page)
                else:
                    self._tag(tag, bool(token["end"]), token["attrs"])

    def _element(self, tag: str, attrs: str) -> _Element:
        e, parent, named = _Element(), self.current, _attributes(attrs)
        e.tag, e.number, e.parent = tag, len(self.elements), parent
        inline = tag in INLINE
        key = (parent.path if parent else -1, tag, named.get("class", ""))
        e.path = parent.path if inline else self.paths.setdefault(key, len(self.paths))
        e.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        inside = parent is not None and parent.in_article
        e.weight = (parent.weight if parent else 1.0) * _weight(tag, named, inside, self.settings)
        e.linked = tag == "a" or (parent is not None and parent.linked)
        e.holder = parent.holder if inline else e
        # The open elements that a later start tag may close, as seen from here.
        e.scope = parent.scope if parent else {}
        if tag in CLOSES_PARAGRAPH and "p" in e.scope:
            e.scope = {t: x for t, x in e.scope.items() if t != "p"}
        if tag in LIST_BOUNDS and e.scope:
            e.scope = {t: x for t, x in e.scope.items() if t == "p"}
        if tag == "p" or tag in CLOSES_LIKE:
            e.scope = {**e.scope, tag: e}
        self.elements.append(e)
        self.open[tag] = self.open.get(tag, 0) + 1
        return e

    def _close(self, element: _Element) -> None:
        """Close ``element`` and all that is open in it."""
        while True:
            node, self.current = self.current, self.current.parent
            self.open[node.tag] -= 1
            if node is element:
                return

    def _tag(self, tag: str, ends: bool, attrs: str) -> None:
        if tag == "head":
            return
        if tag not in INLINE:
            self.block = None
        if ends:
            if self.open.get(tag) and tag != "#root":
                node = self.current
                while node.tag != tag:
                    node = node.parent
                self._close(node)
            return
        closes = CLOSES_LIKE.get(tag, {"p"} if tag in CLOSES_PARAGRAPH else ())
        found = [self.current.scope[t] for t in closes if t in self.current.scope]
        if found:
            self._close(min(found, key=lambda e: e.number))
        if tag == "br":
            self._text(" ")
        elif tag not in VOID and not attrs.endswith("/"):
            self.current = self._element(tag, attrs)

    def _text(self, text: str) -> None:
        if self.block is None:
            if not text.strip():
                return
            self.block = _Block(self.current, [])
            self.blocks.append(self.block)
        self.block.parts.append(text)
        if self.current.linked:
            self.block.linked += sum(map(len, text.split()))
        else:
            self.block.marks += len(_PUNCTUATION.findall(text))


def content_blocks(page: _Page, lines: list[str], settings: Settings) -> np.ndarray:
    """Which blocks lie on paths whose fused ratio of text and punctuation passes the threshold."""
    blocks = page.blocks
    chars = np.array([len(line) for line in lines], float)
    linked = np.minimum(np.array([b.linked for b in blocks], float), chars)
    chars += (settings.linked - 1) * linked
    marks = np.array([b.marks for b in blocks], float)
    weight = np.array([b.element.weight for b in blocks])
    _, of, size = np.unique([b.element.path for b in blocks], return_inverse=True, return_counts=True)
    own, near = [], []
    for values in (chars, marks):
        by_path = np.bincount(of, values) / size
        along = np.pad(by_path[of], len(settings.kernel) // 2, mode="edge")
        own.append(by_path)
        near.append(np.bincount(of, np.convolve(along, settings.kernel, "valid")) / size)
    fused = np.log1p(own[0]) + np.log1p(own[1])
    smooth = np.log1p(near[0]) + np.log1p(near[1])
    ratio = np.sqrt(fused * smooth)[of] * weight
    if ratio.max() < settings.least:
        return np.zeros(len(blocks), bool)
    # The ratio that most text has, seldom kinds of text apart.
    typical = (chars * ratio**3).sum() / (chars * ratio**2).sum()
    strong = ratio >= min(settings.outside * typical, ratio.max())
    region = _region(page, np.where(strong, chars * ratio, 0), settings)
    within = np.array([region[b.element.number] for b in blocks])
    return strong | (within & (ratio >= settings.inside * typical))


def _region(page: _Page, text: np.ndarray, settings: Settings) -> np.ndarray:
    """Which elements lie in the deepest one that holds nearly all strong text; an article with most of
    it goes before."""
    held = np.zeros(len(page.elements))
    for block, amount in zip(page.blocks, text):
        # A block's own element isn't its region, unless it is an article.
        holder = block.element.holder
        if holder.parent and holder.tag not in ("article", "main"):
            holder = holder.parent
        held[holder.number] += amount
    for element in reversed(page.elements[1:]):
        held[element.parent.number] += held[element.number]
    total = held[0]
    best = page.root
    for element in page.elements:
        if held[element.number] >= settings.article_held * total and element.tag in ("article", "main"):
            best = element
    if best is page.root:
        for element in page.elements:
            if held[element.number] >= settings.held * total and element.tag not in INLINE:
                best = element
    inside = np.zeros(len(page.elements), bool)
    inside[best.number] = True
    for element in page.elements[best.number + 1 :]:
        inside[element.number] = inside[element.parent.number]
    return inside


def main_text(page: str | None, settings: Settings = Settings()) -> str:
    """The article of a whole page, a line for each block; empty if there is none."""
    if not page:
        return ""
    read = _Page(page, settings)
    if not read.blocks:
        return ""
    lines = [" ".join("".join(block.parts).split()) for block in read.blocks]
    chosen = content_blocks(read, lines, settings)
    return "\n".join(line for line, content in zip(lines, chosen) if content and line)


def extracted(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html, ...).

    Null and empty pages, and pages without content, give the empty text; what a tag, comment or script
    that never ends holds is not text. Repeated rows and null ids and urls come back as given; other
    columns are ignored, and no rows give none. Pages are read whole, in time that follows their length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page, settings) for page in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return map_with_id(rows, run, "page_id long, url string, text string, n_chars long", "page_id")
