"""Main text of web pages by tree scoring: paragraphs give points to their ancestors, the best container is kept.

A page becomes a tree of block elements. What is no article by its tag, role or class (menus, page headers, footers,
sidebars, notices, adverts, forms, scripts, reader comments) is left out while the tree is built. Each paragraph then
passes points for its length and its commas to the element that holds it and, fading, to those above; an element's
points are discounted by the share of its text that is links. The best element, or the ``article`` around it, is kept
with those of its siblings that read like parts of the same text.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plenum.llm.text import fresh, parse_schema, with_struct

EXTRACTED = parse_schema("text string,n_chars bigint")

# Fixed element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("p pre blockquote li dt dd td th figcaption address summary caption".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body main article section div center ul ol dl menu table thead tbody tfoot tr figure details header footer nav "
    "aside form fieldset hgroup dialog search hr head template noscript".split())
HEAD_ONLY = frozenset("base link meta title script style noscript template".split())
LEFT_OUT = frozenset(
    "head nav aside footer form fieldset script style noscript template textarea title iframe noembed noframes xmp "
    "button select datalist option menu dialog search svg math canvas object audio video map".split())
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# An open element of the first kind ends where the second starts; the third kind shields it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

# Words in a class or id that mark what is no part of an article, even where an article element stands inside it.
FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle adslot adunit adbox sponsor "
    "sponsored sponsors promo promos promotion comment comments commentlist commentform commentbox disqus respond reply "
    "replies related recommended recommendations newsletter subscribe signup cookie cookies consent gdpr".split())
# Words that mark it unless a main or article element stands inside: page layouts carry them as well.
LAYOUT = frozenset(
    "banner banners notice notices alert alerts sidebar sidebars aside widget widgets share sharing sharebar social nav "
    "navbar navigation menu menus menubar breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar popup "
    "modal overlay login search skip skiplink".split())
NEGATED = frozenset("no not non has with without".split())
GOOD = frozenset("article articlebody content entry main post story text body".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
OPEN_TAIL = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
COMMAS = re.compile("[,،、，]")

KEPT, LEAD, SOFT, OUT = 0, 1, 2, 3  # all text, headings only, left out by layout, left out


def tokens(names: str) -> list[str]:
    return [t.lower() for t in TOKEN.findall(names)]


@lru_cache(maxsize=4096)
def judge(rest: str) -> tuple[int, bool, bool, bool]:
    """From a start tag's attributes: state, whether they speak for an article, whether of main text, of a header."""
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), unescape(a or b or c))
    role = found.get("role", "").lower()
    names = tokens(f"{found.get('class', '')} {found.get('id', '')}")
    main = role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    said = {t for t, before in zip(names, ["", *names]) if before not in NEGATED}
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(
        r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I) is not None
    state = KEPT
    if hidden or role in LEFT_OUT_ROLES or said & FOREIGN:
        state = OUT
    elif said & LAYOUT and not main:
        state = SOFT
    return state, bool(said & GOOD), main, "header" in said


class Page:
    """The blocks of one page, and the tree of block elements that hold them."""

    def __init__(self, html: str):
        self.tag, self.parent, self.good, self.main = ["html"], [-1], [False], [False]
        self.block_children = [0]
        self.blocks: list[tuple[str, int, int, bool]] = []  # text, element, characters of links, heading
        self.stack: list[tuple[str, int, int, bool]] = [("html", 0, KEPT, False)]  # name, element, state, in a link
        self.open: dict[str, int] = {"html": 1}
        self.pieces: list[str] = []
        self.linked = 0
        self.read(html)

    def read(self, html: str) -> None:
        at, find = 0, TAG.search
        while True:
            match = find(html, at)
            if match is None:
                tail = OPEN_TAIL.search(html, at)
                self.text(html[at : tail.start() if tail else len(html)])
                break
            if match.start() > at:
                self.text(html[at : match.start()])
            at = match.end()
            name = match["name"] or match["name2"]
            if name is None:
                continue
            name = name.lower()
            if match["end"] or match["end2"]:
                self.end(name)
                continue
            rest = match["rest"] or match["rest2"] or ""
            if name in RAW:
                closing = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = closing.end() if closing else len(html)
                continue
            self.start(name, rest)
        self.flush()

    def text(self, raw: str) -> None:
        _, _, state, link = self.stack[-1]
        if state >= SOFT:
            return
        if "&" in raw:
            raw = unescape(raw)
        self.pieces.append(raw)
        if link:
            self.linked += len(raw.strip())

    def flush(self) -> None:
        """End the block that is being read; white space inside it becomes one space."""
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        linked, self.linked = self.linked, 0
        if text:
            element = next(e for e in reversed(self.stack) if e[0] in BLOCKS)
            heading = element[0] in HEADINGS
            if element[2] == KEPT or heading:
                self.blocks.append((text, element[1], min(linked, len(text)), heading))

    def pop(self, upto: int) -> None:
        """Close the elements of the stack from place ``upto`` on."""
        if any(entry[0] in BLOCKS for entry in self.stack[upto:]):
            self.flush()
        for entry in self.stack[upto:]:
            self.open[entry[0]] -= 1
        del self.stack[upto:]

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
            return
        if name in ("html", "body") or not self.open.get(name):
            return
        for place in range(len(self.stack) - 1, 0, -1):
            found = self.stack[place][0]
            if found == name:
                self.pop(place)
                return
            if name not in BLOCKS and found in BLOCKS:
                return

    def imply_ends(self, name: str) -> None:
        """Close what a start tag closes without saying so."""
        if self.open.get("head") and name not in HEAD_ONLY and name != "head":
            self.pop(next(i for i, e in enumerate(self.stack) if e[0] == "head"))
        if name in BLOCKS and self.open.get("p"):
            place = next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] in BLOCKS)
            if self.stack[place][0] == "p":
                self.pop(place)
        if name in HEADINGS and self.stack[-1][0] in HEADINGS:
            self.pop(len(self.stack) - 1)
        if name in ENDS and any(self.open.get(x) for x in ENDS[name][0]):
            ended, shield = ENDS[name]
            for place in range(len(self.stack) - 1, 0, -1):
                if self.stack[place][0] in ended:
                    self.pop(place)
                    break
                if self.stack[place][0] in shield:
                    break

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            if self.stack[-1][2] < SOFT:
                self.pieces.append(" ")
            return
        if name == "html":
            return
        self.imply_ends(name)
        if name == "body" and self.open.get("body"):
            return
        if name in BLOCKS:
            self.flush()
        if name in VOID:
            return
        _, element, state, link = self.stack[-1]
        said, good, main, header = judge(rest) if rest else (KEPT, False, False, False)
        main = main or name in ("main", "article")
        if name in ("body", "main"):
            said = KEPT
        if state == SOFT and main and said == KEPT:
            state = KEPT  # the word was about a page layout
        elif name in LEFT_OUT:
            state = OUT
        elif name == "header" or header:
            # in an article the header holds its headline
            state = max(state, LEAD if any(self.main[e[1]] for e in self.stack) else OUT)
        state = max(state, said)
        if name in BLOCKS:
            self.tag.append(name)
            self.parent.append(element)
            self.good.append(good or main)
            self.main.append(main)
            self.block_children.append(0)
            self.block_children[element] += 1
            element = len(self.tag) - 1
        self.stack.append((name, element, state, link or name == "a"))
        self.open[name] = self.open.get(name, 0) + 1

    def scores(self) -> tuple[list[float], list[float]]:
        """Points and link density of each element."""
        n = len(self.tag)
        points, chars, links = [0.0] * n, [0] * n, [0] * n
        for text, element, linked, heading in self.blocks:
            chars[element] += len(text)
            links[element] += linked
            if heading:
                continue
            given = min(1.0, len(text) / 25) + len(COMMAS.findall(text)) + min(len(text) / 100, 3.0)
            holder = self.parent[element] if self.tag[element] in PARAGRAPHS and element else element
            level = 0
            while holder >= 0:
                points[holder] += given * (1 if level == 0 else 0.5 if level == 1 else 1 / (3 * level))
                holder = self.parent[holder]
                level += 1
                if level > 8:  # what is left is less than a twenty-fourth
                    break
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            links[self.parent[i]] += links[i]
        density = [b / a if a else 0.0 for a, b in zip(chars, links)]
        scored = [(p + 10 * g) * (1 - d) if p else 0.0 for p, g, d in zip(points, self.good, density)]
        self.chars = chars
        return scored, density

    def main_text(self) -> str:
        if not self.blocks:
            return ""
        score, density = self.scores()
        best = max(range(len(score)), key=lambda i: (score[i], -i))
        if not score[best]:  # no paragraph at all
            best = next((i for i in range(len(score)) if self.main[i] and self.chars[i]), -1)
            if best < 0:
                return ""
        around = best
        while around > 0 and not self.main[around]:
            around = self.parent[around]
        if around > 0:
            best = around
        chosen = [False] * len(self.tag)
        chosen[best] = True
        above = self.parent[best]
        enough = max(10.0, score[best] / 5)
        last_heading = None
        for i in range(1, len(self.tag)):
            if self.parent[i] != above or above < 0 or i == best:
                continue
            if self.tag[i] in HEADINGS and i < best:
                last_heading = i
            elif score[i] >= enough:
                chosen[i] = True
            elif self.tag[i] in ("p", "pre", "blockquote") and self.chars[i] > 80 and density[i] < 0.25:
                chosen[i] = True
        if last_heading is not None and not any(
            self.parent[i] == above and self.chars[i] and not chosen[i] for i in range(last_heading + 1, best)
        ):
            chosen[last_heading] = True
        for i in range(1, len(self.tag)):
            chosen[i] = chosen[i] or chosen[self.parent[i]]
        loose = [e == above and len(t) > 80 and linked < 0.25 * len(t) for t, e, linked, _ in self.blocks]
        return "\n".join(block[0] for block, near in zip(self.blocks, loose) if chosen[block[1]] or near)


def main_text(html: str | None) -> str:
    """Main text of one page: its blocks in page order, joined by line ends; empty if there is none."""
    return Page(html).main_text() if html else ""


def extract_main_text(pages: DataFrame, html: str = "html", name: str = "extracted") -> DataFrame:
    """``pages`` plus a struct ``name`` (or a free name like it) of the main ``text`` and its ``n_chars`` code points.

    Pages stay where they are, one at a time in memory besides their batch. A null or empty page, and one without an
    article, has the empty text. Elements that are never closed end with the element around them; a tag cut off by
    the end of the page is dropped. Of equal scores the first element counts. Repeated rows and other columns, of
    whatever name, pass through; an empty table gives an empty one.
    """

    def work(column: pa.Array) -> dict[str, pa.Array]:
        made = [main_text(value.as_py()) for value in column]
        return {"text": pa.array(made, pa.string()), "n_chars": pa.array(np.array(list(map(len, made)), np.int64))}

    return with_struct(pages, [html], fresh(pages, name), EXTRACTED, work)
