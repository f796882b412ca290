"""Main text of web pages by tree scoring.

A page becomes a tree of elements and, in page order, blocks of text.  Blocks give points for
their length and commas, discounted by the share of their text that is links, to the container
around them and half of it to the next.  The best container is kept, with the siblings that score
well enough.  Parts that are not article text by their element or by their names (menus, adverts,
comments, forms, ...) are left out before scoring.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import lean_batches

# A tag that is not closed before the next one is text.  A quoted value may hold "<" if it is not too long: the
# search for its end must not go to the end of the page from every tag.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|"
    r"<(/?)([A-Za-z][^\s/<>]*+)((?:[^<>\"']|\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,1000}+\"|'[^']{0,1000}+')*+)>|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul caption".split()
)
LEFT_OUT = frozenset("nav footer aside button select input menu dialog head object audio video canvas".split())
IN_HEAD = frozenset("base basefont bgsound link meta title script style noscript template".split())
FOREIGN = frozenset("svg math".split())
LISTS = frozenset("ul ol dl tr tbody thead table".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH = frozenset("p pre td th blockquote li dd dt".split())
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Names (class, id, role) of parts that are not article text.
NAMED_OUT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|banners?|"
    r"comments?|commentlist|replies|reply|disqus|respond|discussion|nav|navbar|navigation|menus?|menubar|breadcrumbs?|"
    r"sidebars?|side|aside|widgets?|footer|foot|masthead|topbar|cookies?|consent|gdpr|notices?|alerts?|popups?|"
    r"modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|"
    r"recommendations|more-stories|pagination|pager|toolbar|search|forms?|complementary|contentinfo|tags|teasers?)(?:$|[\s_-])",
    re.I,
)
# Of these, names that a wrapper around the whole page may carry as well ("with-sidebar").
LAYOUT = re.compile(r"(?:^|[\s_-])(?:sidebars?|side|nav|navbar|search|forms?|tags|banners?|social|share)(?:$|[\s_-])", re.I)
NAMED_IN = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|hentry|main|page|post|text|story|blog)(?:$|[\s_-])", re.I)
START = {"article": 30.0, "main": 20.0, "div": 5.0, "section": 3.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}


@dataclass
class Element:
    tag: str
    parent: int
    out: bool  # it or something around it is left out
    layout: bool = False  # left out by a name that may be a wrapper's
    base: float = 0.0
    cause: int = 0  # the element that leaves it out
    depth: int = 0  # place among the open elements
    block: int = 0  # the element of the block around it (itself, if it is one)
    form: int = 0  # the form around it, if any
    points: float = 0.0
    last: int = 0  # number of the last element inside
    text: int = 0
    linked: int = 0


@dataclass
class Block:
    element: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def _names(attributes: str) -> tuple[str, bool]:
    names, hidden = [], False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            names.append(value)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            hidden = True
    return " ".join(names), hidden


class Page:
    """Elements and blocks of one page; the time follows the length of the source, however broken it is."""

    def __init__(self, source: str):
        self.elements = [Element("#page", -1, False)]
        self.blocks: list[Block] = []
        self.open = [0]
        self.count: Counter[str] = Counter()  # open elements by tag
        self.inline = [Counter()]  # of these, the ones within each open block
        self.left_out = 0  # open elements that are left out by their tag, whatever is inside
        self.wrappers: set[int] = set()  # forms with an article or main part
        self.block: Block | None = None
        self._read(source)
        while len(self.open) > 1:
            self._close()
        self.elements[0].last = len(self.elements) - 1

    def _read(self, source: str) -> None:
        at, lower = 0, None
        while at < len(source):
            token = TOKEN.match(source, at)
            at = token.end()
            text = token.group(0)
            if token.group(2) is None:
                if not text.startswith(("<!", "<?")):
                    self._text(text)
                continue
            tag = token.group(2).lower()
            if token.group(1):
                self._end(tag)
                continue
            if tag in RAW and not (tag in FOREIGN and token.group(3).rstrip().endswith("/")):
                lower = source.lower() if lower is None else lower
                end = lower.find(f"</{tag}", at)
                stop = lower.find(">", end) if end >= 0 else -1
                at = stop + 1 if stop >= 0 else len(source)
            elif tag not in RAW:
                self._start(tag, token.group(3))

    def _text(self, raw: str) -> None:
        if self.elements[self.open[-1]].tag == "head" and raw.strip():
            self._close()  # its end tag may be missing
        element = self.elements[self.open[-1]]
        if element.out:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if self.block is None:
            if not text.strip():
                return
            self.block = Block(element.block)
            self.blocks.append(self.block)
        self.block.parts.append(text)
        if self.count["a"]:
            self.block.linked += len(text)

    def _start(self, tag: str, attributes: str) -> None:
        if self.elements[self.open[-1]].tag == "head" and tag not in IN_HEAD:
            self._close()  # its end tag may be missing
        if tag == "br":
            if self.block is not None:
                self.block.parts.append(" ")
            return
        if tag in BLOCK:
            self.block = None
            if tag in CLOSES_ITSELF:
                self._close_item(CLOSES_ITSELF[tag])
            else:
                self._close_paragraph()
        if tag in VOID:
            return
        around = self.elements[self.open[-1]]
        names, hidden = _names(attributes) if attributes else ("", False)
        out = around.out or hidden or tag in LEFT_OUT
        if not out and tag == "header":
            out = not self.count["article"]
        layout = False
        if tag in ("article", "main"):
            other = bool(names and NAMED_OUT.search(names) and not LAYOUT.search(names))
            # something around is left out for good, and not just by a wrapper's name
            behind = around.out and not self.elements[around.cause].layout or self.left_out > 0
            out = other or behind
            if not out:
                if around.out:
                    for k in self.open[self.elements[around.cause].depth :]:
                        self.elements[k].out = False
                self.wrappers.add(around.form)
        elif not out and names and tag not in ("html", "body", *HEADING):
            named, wrapper = bool(NAMED_OUT.search(names)), bool(LAYOUT.search(names))
            out = named and not (wrapper and tag == "form")
            layout = out and wrapper
        base = START.get(tag, 0.0) + (10.0 if names and NAMED_IN.search(names) else 0.0)
        own = len(self.elements)
        self.elements.append(
            Element(
                tag, self.open[-1], out, layout, base, around.cause if around.out else own, len(self.open),
                own if tag in BLOCK else around.block, own if tag == "form" else around.form,
            )
        )
        self.open.append(own)
        self.count[tag] += 1
        self.left_out += tag in LEFT_OUT or tag == "header"
        if tag in BLOCK:
            self.inline.append(Counter())
            self.block = None
        else:
            self.inline[-1][tag] += 1

    def _close(self) -> None:
        element = self.elements[self.open.pop()]
        element.last = len(self.elements) - 1
        self.count[element.tag] -= 1
        self.left_out -= element.tag in LEFT_OUT or element.tag == "header"
        if element.tag in BLOCK:
            self.inline.pop()
            self.block = None
        else:
            self.inline[-1][element.tag] -= 1

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._close()

    def _close_paragraph(self) -> None:
        near = self.elements[self.elements[self.open[-1]].block]
        if near.tag == "p" or near.tag in HEADING:
            self._close_to(near.depth)

    def _close_item(self, like: set[str]) -> None:
        if not any(self.count[t] for t in like):
            return
        stop = {"ul", "ol", "dl", "table", "select", "menu", "div", "section", "article", "body"}
        k = self.elements[self.open[-1]].block if not like & {"option"} else self.open[-1]
        while k > 0:
            tag = self.elements[k].tag
            if tag in like:
                self._close_to(self.elements[k].depth)
                return
            if tag in stop:
                return
            k = self.elements[self.elements[k].parent].block

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self.block = None
        # a stray end tag does not reach out of its block
        if not (self.count[tag] if tag in BLOCK else self.inline[-1][tag]):
            return
        while self.elements[self.open[-1]].tag != tag:
            self._close()
        self._close()

    # -------------------------------------------------------------- scoring

    def _left_blocks(self) -> list[tuple[Block, str]]:
        """Blocks with their texts, without those of forms that are no wrappers of the page."""
        blocks = [(b, " ".join("".join(b.parts).split())) for b in self.blocks]
        inside: Counter[int] = Counter()
        for b, text in blocks:
            inside[self.elements[b.element].form] += max(0, len(text) - b.linked)
        whole = sum(inside.values())
        wrappers = self.wrappers | {f for f, n in inside.items() if 2 * n > whole} | {0}
        return [(b, t) for b, t in blocks if self.elements[b.element].form in wrappers]

    def _holders(self) -> list[int]:
        """Of every element, the container that points of a text in it go to."""
        found = [0]
        for k, e in enumerate(self.elements[1:], 1):
            found.append(k if e.tag in BLOCK and e.tag not in LISTS else found[e.parent])
        return found

    def _passed_down(self, own: list[bool]) -> list[bool]:
        """Whether it holds for an element or for something around it."""
        found = own[:1]
        for e, mine in zip(self.elements[1:], own[1:]):
            found.append(mine or found[e.parent])
        return found

    def main_text(self) -> str:
        elements, blocks = self.elements, self._left_blocks()
        holders = self._holders()
        scored: set[int] = set()
        for block, text in blocks:
            share = min(1.0, block.linked / max(1, len("".join(block.parts))))
            element = elements[block.element]
            element.text += len(text)
            element.linked += int(share * len(text))
            if element.tag in HEADING or not text:
                continue
            points = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - share)
            near = holders[element.parent if element.tag in PARAGRAPH else block.element] if block.element else 0
            for k, part in ((near, 1.0), (holders[elements[near].parent] if near else 0, 0.5)):
                elements[k].points += part * points
                scored.add(k)
                if k == 0:
                    break
        for e in reversed(elements[1:]):  # children come after their parents
            elements[e.parent].text += e.text
            elements[e.parent].linked += e.linked
        if not scored:  # without any paragraph, headings of an article or main part are all there is
            inside = self._passed_down([e.tag in ("article", "main") for e in elements])
            return " ".join(t for b, t in blocks if t and inside[b.element])

        def score(k: int) -> float:
            e = elements[k]
            return (e.base + e.points) * (1 - e.linked / max(1, e.text))

        best = max(sorted(scored), key=score)
        kept = [(best, elements[best].last)]
        if best and elements[best].tag not in ("article", "main"):
            least = max(10.0, 0.2 * score(best))
            for k in range(1, len(elements)):
                e = elements[k]
                if e.parent == elements[best].parent and k != best and not e.out:
                    density = e.linked / max(1, e.text)
                    good_text = e.tag == "p" and e.text > 80 and density < 0.25
                    if k in scored and e.points > 0 and score(k) >= least or good_text or e.tag == "h1":
                        kept.append((k, e.last))
        kept.sort()
        firsts = [a for a, _ in kept]
        # inside the container, a list or table that is nearly all links is a menu
        menu = self._passed_down([k > best and e.tag in ("ul", "ol", "table") and e.linked > 0.8 * e.text for k, e in enumerate(elements)])
        found = []
        for block, text in blocks:
            at = bisect_right(firsts, block.element) - 1
            if text and at >= 0 and block.element <= kept[at][1] and not menu[block.element]:
                found.append(text)
        return " ".join(found)


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extracted(source: Column) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return extract(source)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page, text, n_chars`` for every row of ``pages``; ``page`` is the row itself.

    Null and empty sources give an empty text, and so do pages without article text.  Markup that
    is broken or cut off is read as far as it goes, in time that follows its length, as do very long
    pages: a tag that is not closed before the next one is text, a head ends with the first element or
    text that has no place in it, and a form that holds the article or most of the text is a wrapper.  Character references are decoded, white space
    within a block becomes one space, and the blocks are joined by one space in page order.
    Repeated rows give the same text.  An empty table stays empty.
    """
    text = F.coalesce(extracted(F.col("page.html")), F.lit(""))
    whole = lean_batches(pages).select(F.struct(*[pages[c] for c in pages.columns]).alias("page"))
    return whole.select("page", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
