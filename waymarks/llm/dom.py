"""A forgiving reader of HTML: elements with their paths, and text blocks in page order."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import xxhash

_TAG = re.compile(
    r"<(?:!--(?:.*?-->|.*)"
    r"|(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*|[^>]*)>"
    r"|[!?][^>]*>)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_DIGITS = re.compile(r"\d+")
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1

# Elements of HTML by what they mean for text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img".split()
)
CHROME = set(
    "head nav footer aside form button select option input dialog menu svg canvas object audio video "
    "map math fieldset".split()
)
#: Block elements that are no node of the style tree: the page itself.
PAGE = {"", "html", "body"}
#: Starting one of these ends an open one of the named elements.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: What an implied end does not reach past.
SCOPES = set("html body article main section div table ul ol dl td th form aside nav".split())
#: Parts of class names and ids of what surrounds an article.
NAMES = set(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo "
    "promotion promotions banner banners cookie cookies consent gdpr notice notices notification "
    "notifications alert alerts popup modal overlay newsletter subscribe subscription signup sidebar "
    "sidebars rail widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination "
    "pager comment comments commentlist disqus respond replies related recommended recommendations "
    "share sharing social footer masthead topbar toolbar skip login search copyright".split()
)
COMMENTS = {"comment", "comments", "commentlist", "reply", "replies", "respond"}
ROLES = set(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar status".split()
)

BODY, MAIN, ARTICLE = 1, 2, 3


def _named(value: str, names: set[str]) -> bool:
    """Whether a class or id has a first or last part among the names."""
    for name in value.lower().split():
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        if parts and (parts[0] in names or parts[-1] in names):
            return True
    return False


@dataclass
class Element:
    tag: str
    path: int
    level: int
    dropped: bool
    children: list[str] = field(default_factory=list)
    first_block: int = 0
    holds: int = 0


@dataclass
class Block:
    level: int
    text: str
    dropped: bool


@dataclass
class Page:
    """Text blocks in page order, and every block element with its branch.

    A branch is (path, children's tags joined, first block, block behind the last, the highest level
    that it or an element in it begins).
    """

    blocks: list[Block] = field(default_factory=list)
    branches: list[tuple[int, str, int, int, int]] = field(default_factory=list)
    root: int = BODY

    def contents(self) -> list[tuple[int, str, int]]:
        """Of every branch the path, the children's tags and a hash of its whole text.

        Hashes of blocks are summed along the page as a polynomial, so a branch is one difference.
        """
        sums, powers = [0], [1]
        for block in self.blocks:
            own = xxhash.xxh3_64_intdigest(block.text.encode("utf-8", "surrogatepass"))
            sums.append((sums[-1] * _BASE + own) & _MASK)
            powers.append(powers[-1] * _BASE & _MASK)
        return [
            (path, tags, ((sums[b] - sums[a] * powers[b - a]) & _MASK) - (1 << 63))
            for path, tags, a, b, _ in self.branches
        ]

    def text(self, low: frozenset[int] = frozenset()) -> str:
        """The article, without branches of ``low`` paths.

        A branch that has the article or main element in it, and most of its text, is the article,
        whatever its importance.
        """
        shown = [not b.dropped and b.level >= self.root for b in self.blocks]
        size = [0]
        for block, on in zip(self.blocks, shown):
            size.append(size[-1] + (len(block.text) if on else 0))
        for path, _, a, b, holds in self.branches:
            article = self.root > BODY and holds >= self.root and 2 * (size[b] - size[a]) > size[-1]
            if path in low and not article:
                shown[a:b] = [False] * (b - a)
        return "\n".join(block.text for block, on in zip(self.blocks, shown) if on)


class Reader:
    """Reads pages; remembers paths and the meaning of attributes up to a bound."""

    LIMIT = 1 << 16

    def __init__(self):
        self.paths: dict[tuple[int, str, str], int] = {}
        self.meanings: dict[tuple[str, str], tuple[str, bool, int]] = {}

    def _path(self, parent: int, tag: str, key: str) -> int:
        node = (parent, tag, key)
        path = self.paths.get(node)
        if path is None:
            if len(self.paths) >= self.LIMIT:
                self.paths.clear()
            raw = f"{parent}/{tag}/{key}".encode("utf-8", "surrogatepass")
            path = self.paths[node] = xxhash.xxh3_64_intdigest(raw) - (1 << 63)
        return path

    def _meaning(self, tag: str, raw: str) -> tuple[str, bool, int]:
        """Key of an element in its path, whether it surrounds articles, and its level."""
        known = self.meanings.get((tag, raw))
        if known is not None:
            return known
        level = {"article": ARTICLE, "main": MAIN}.get(tag, 0)
        chrome = tag in CHROME
        key = ""
        if raw.strip():
            at = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}
            names = f"{at.get('class', '')} {at.get('id', '')}"
            role = at.get("role", "").lower()
            key = _DIGITS.sub("#", f"{names.strip()} {role}".strip())
            if role == "main":
                level = max(level, MAIN)
            if role == "article" or "articlebody" in at.get("itemprop", "").lower():
                level = ARTICLE
            if tag not in ("html", "body"):
                chrome |= _named(names, COMMENTS if level else NAMES) or role in ROLES
                chrome |= "hidden" in at or at.get("aria-hidden") == "true"
                chrome |= "display:none" in at.get("style", "").replace(" ", "").lower()
        if len(self.meanings) >= self.LIMIT:
            self.meanings.clear()
        known = self.meanings[tag, raw] = (key, chrome, level)
        return known

    def read(self, html: str | None) -> Page:
        page = Page()
        stack = [Element("", 0, BODY, False)]
        held: list[str] = []
        html = html or ""

        def flush():
            if held:
                text = " ".join(unescape("".join(held)).split())
                if text:
                    page.blocks.append(Block(stack[-1].level, text, stack[-1].dropped))
                held.clear()

        def close(to: int):
            flush()
            while len(stack) > to:
                e = stack.pop()
                # Every block element is a node, whatever its name says.
                if e.tag not in PAGE and e.tag not in INLINE:
                    blocks = (e.first_block, len(page.blocks))
                    page.branches.append((e.path, " ".join(e.children), *blocks, e.holds))
                stack[-1].holds = max(stack[-1].holds, e.holds)

        at, end = 0, len(html)
        while at < end:
            m = _TAG.search(html, at)
            if m is None:
                held.append(html[at:])
                break
            if m.start() > at:
                held.append(html[at : m.start()])
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        if tag in INLINE:
                            # Inline text stays in its block.
                            if i == len(stack) - 1 and stack[i].dropped == stack[i - 1].dropped:
                                stack.pop()
                            elif i == len(stack) - 1:
                                close(i)
                        else:
                            close(i)
                        break
                    if tag in INLINE and stack[i].tag not in INLINE:
                        break
                continue
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(html, at)
                at = stop.end() if stop else end
                continue
            if tag in VOID or m[3].endswith("/") and tag not in INLINE | SCOPES:
                if tag == "br":
                    held.append(" ")
                elif tag == "hr":
                    flush()
                continue
            key, chrome, level = self._meaning(tag, m[3])
            if tag in INLINE and not chrome:
                stack[-1].children.append(tag)
                top = stack[-1]
                stack.append(Element(tag, top.path, top.level, top.dropped))
                continue
            flush()
            # Block elements end open inline ones and an open paragraph.
            ends = ENDS.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in SCOPES:
                    break
            while len(stack) > 1 and stack[-1].tag in INLINE:
                stack.pop()
            top = stack[-1]
            top.children.append(tag)
            # The header of an article holds its title; the header of a page surrounds it.
            chrome |= tag == "header" and top.level < ARTICLE
            path = self._path(top.path, tag, key)
            dropped = top.dropped or chrome
            if level > page.root and not dropped:
                page.root = level
            holds, level = level, max(level, top.level)
            stack.append(Element(tag, path, level, dropped, [], len(page.blocks), holds))
        close(1)
        flush()
        return page
