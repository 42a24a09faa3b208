"""HTML to a sequence of leaf blocks: runs of text between block-level tags, each with its path of ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: The roles of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split())
RAW = ("script", "style", "template", "svg", "iframe", "textarea", "select", "title", "noscript", "object", "canvas", "math")
#: Those of them whose text goes on to the end of the page where no closing tag follows; the others then hold what stands in them.
ENDLESS = frozenset("script style textarea title iframe".split())
#: Elements whose text readers may see: it is not dropped where they are closed either.
SEEN = frozenset("math object noscript".split())
#: An opening tag closes an open element of the first set, unless one of the second stands between.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Words in class, id and role that tell what an element is for.
CUES = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pager pagination toc skip tabs topbar toolbar",
    "header": "header masthead banner head top logo branding site hero",
    "footer": "footer foot bottom colophon copyright contentinfo legal",
    "side": "sidebar side aside widget widgets related recommended recommend complementary trending popular more rail recent",
    "ad": "ad ads adv advert adverts advertisement advertisements adbox adslot adsense sponsor sponsored sponsors promo promoted promotion banner dfp doubleclick",
    "notice": "cookie cookies consent gdpr notice notices notification alert popup modal dialog overlay newsletter subscribe subscription signup paywall disclaimer message toast warning announcement",
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback reviews review reader readers responses thread",
    "share": "share sharing social follow buttons tools like tweet",
    "main": "content article post entry story main text body page primary maincontent articlebody prose",
    "form": "form login search input field contact register",
    "meta": "meta byline author date tags tag category categories timestamp info",
    "hidden": "hidden sr only invisible offscreen none",
}
_CUE = {}
for _k, _words in CUES.items():
    for _w in _words.split():
        _CUE.setdefault(_w, []).append(_k)

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
#: Attributes up to the end of the tag; a ``>`` in quotes does not end it.
_QUOTED = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_CLOSE = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def cues(attributes: str) -> frozenset[str]:
    """What class, id, role and visibility attributes say an element is for."""
    out: set[str] = set()
    for name, value in _ATTR.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.add("hidden")
        elif name in ("class", "id", "role"):
            for part in _PART.findall(value):
                out.update(_CUE.get(part.lower(), ()))
    return frozenset(out)


@dataclass(slots=True)
class Block:
    text: str
    path: int
    linked: int


class Paths:
    """Ancestor paths by number: each is a parent path, a tag and its cues."""

    def __init__(self):
        self.parent, self.tag, self.cue = [-1], ["body"], [frozenset()]
        self._known: dict[tuple, int] = {}
        #: What a reader has worked out for paths, from the parent's to the child's.
        self.state: dict[int, tuple] = {}
        self._cues: dict[str, frozenset[str]] = {"": frozenset()}

    def down(self, path: int, tag: str, attributes: str) -> int:
        attributes = attributes.strip("/ \n\t\r")
        cue = self._cues.get(attributes)
        if cue is None:
            cue = cues(attributes)
            if len(attributes) <= 400:  # longer ones are read again rather than remembered
                if len(self._cues) > 50_000:
                    self._cues = {"": frozenset()}
                self._cues[attributes] = cue
        key = (path, tag, cue)
        if key not in self._known:
            self._known[key] = len(self.tag)
            self.parent.append(path)
            self.tag.append(tag)
            self.cue.append(cue)
        return self._known[key]


class _Open:
    """The open elements, and where those of each tag stand among them."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("body", 0)]
        self.at: dict[str, list[int]] = {}

    def push(self, tag: str, path: int) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, path))

    def last(self, tags) -> int:
        """Place of the innermost open element with one of the tags; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close(self, place: int) -> None:
        """End the element at ``place`` and all inside it."""
        while len(self.stack) > place > 0:
            self.at[self.stack.pop()[0]].pop()


def blocks(page: str, paths: Paths) -> list[Block]:
    """Leaf blocks of a page in order. Sloppy markup is read as browsers do, roughly: implied ends, stray ends, open ends.

    One pass: what a search did not find in the rest of the page is not searched for again, so time is in proportion to the page.
    """
    out: list[Block] = []
    open_ = _Open()
    stack = open_.stack
    held: list[str] = []
    linked, links, at = 0, 0, 0
    quotes = ends = True  # whether quotes of attributes still pair up, and whether any tag still ends
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        if text:
            out.append(Block(text, stack[-1][1], linked))
        held.clear()
        linked = 0

    size = len(page)
    while at < size:
        start = page.find("<", at)
        start = size if start < 0 else start
        if start > at:
            held.append(page[at:start])
            if links:
                linked += start - at
            if start == size:
                break
        m = _OPEN.match(page, start) if ends or page[start + 1 : start + 2] in ("!", "?") else None
        if m is not None and m[4] is None:
            end = page.find("-->" if m[1] else ">", m.end())
            at = size if end < 0 else end + (3 if m[1] else 1)
            continue
        tail = None
        if m is not None:
            tail = _QUOTED.match(page, m.end()) if quotes else None
            stop = tail.end() - 1 if tail else page.find(">", m.end())
            quotes, ends = tail is not None, stop >= 0
        if m is None or not ends:
            held.append("<")
            linked += 1 if links else 0
            at = start + 1
            continue
        at = stop + 1
        tag, end, attributes = m[4].lower(), m[3] == "/", page[m.end() : stop]
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if end else 1
            continue
        if tag == "br":
            held.append(" ")
            continue
        flush()
        if end:
            open_.close(open_.last((tag,)))
            links = 0 if tag not in ("li", "p") else links
            continue
        if tag in RAW and not attributes.endswith("/"):
            m = None if tag in SEEN or tag in unclosed else _CLOSE[tag].search(page, at)
            if m or tag in ENDLESS:
                at = m.end() if m else size
                continue
            if tag not in SEEN:
                # left open: what follows is read as if the tag were not there
                unclosed.add(tag)
                continue
        if tag in VOID or tag in ("html", "head", "body"):
            continue
        if stack[-1][0] == "p":
            open_.close(len(stack) - 1)
        if tag in CLOSES:
            same, fence = CLOSES[tag]
            place = open_.last(same)
            if place > open_.last(fence):
                open_.close(place)
        open_.push(tag, paths.down(stack[-1][1], tag, attributes))
    flush()
    return out
