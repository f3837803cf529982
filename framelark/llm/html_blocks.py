"""Leaf blocks of a web page, read tag by tag as the HTML standard reads them, in time and memory linear in the page."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass
from functools import lru_cache

#: Elements of the HTML standard that stand as blocks; all others, unknown ones too, stand in the line.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary svg table tbody td template tfoot "
    "th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup, and none of it text of the page. Without an end, the first two reach to the end of the page.
RAW = frozenset("script style iframe noembed noframes textarea title".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: A start tag ends an open element of these, unless one of those was opened inside it.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)), "thead": (("caption",), ("table",)), "tfoot": (("tbody", "thead", "tr", "td", "th"), ("table",)),
}
CELLS, TABLE = ("td", "th", "caption"), frozenset("table tbody td tfoot th thead tr caption".split())
#: Elements that say nothing about what their text is for.
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr td th caption pre blockquote figure figcaption center hgroup".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

_SPACE = r"[ \t\n\f\r]"
_VALUE = r""""[^"]*+"|'[^']*+'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+"""
#: Slashes and white space, or a name with or without a value.
_PARTS = rf"[ \t\n\f\r/]++|=?+[^ \t\n\f\r/>=]++(?:{_SPACE}*+={_SPACE}*+(?:{_VALUE})?+)?+|="
_TAG = re.compile(rf"<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:{_PARTS})*+)>")
_ATTRIBUTE = re.compile(rf"(=?+[^ \t\n\f\r/>=]++)(?:{_SPACE}*+={_SPACE}*+({_VALUE})?+)?+")
_LAST = re.compile(rf"(?:{_PARTS})")
_LONG_NUMBER = re.compile(r"&#(?:[xX]([0-9a-fA-F]{9,})|([0-9]{9,}));?")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.IGNORECASE) for tag in RAW}
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    """A block element: fresh, those of its words (its tag, names and roles) that none of its ancestors has; near, the words of
    itself or its nearest ancestor that has any beyond those of plain text; home, the innermost article or main element that it is
    or is in."""

    __slots__ = ("parent", "tag", "fresh", "near", "home", "score")

    def __init__(self, parent: Node | None, tag: str, fresh: tuple[str, ...], near: tuple[str, ...]):
        self.parent, self.tag, self.fresh, self.near = parent, tag, fresh, near
        self.home: Node | None = self if tag in ("article", "main") else parent.home if parent else None
        self.score: float | None = None


@dataclass(frozen=True, slots=True)
class Block:
    """text without markup, white space as one space; node: the block element it is in; linked: its share of link text; links:
    how many links begin in it."""

    text: str
    node: Node
    linked: float
    links: int = 0


@lru_cache(1 << 14)
def _words(tag: str, attributes: str) -> tuple[str, ...]:
    words = [] if tag in ("div", "section", "html", "body") else [f"<{tag}>"]
    seen = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in seen:
            continue
        seen.add(name)
        if name in ("class", "id", "role"):
            words += _NAME.findall(_CAMEL.sub(" ", value).lower())
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _UNSEEN.search(value)):
            words.append("<hidden>")
    return tuple(dict.fromkeys(words))


def _shortened(number: re.Match) -> str:
    """A numeric reference without leading zeros; one beyond all code points is the replacement character."""
    digits = (number[1] or number[2]).lstrip("0")
    return "\ufffd" if len(digits) > 8 else f"&#{'x' if number[1] else ''}{digits or '0'};"


def unescaped(text: str) -> str:
    return entities.unescape(_LONG_NUMBER.sub(_shortened, text) if "&#" in text else text)


def _closes_itself(attributes: str) -> bool:
    parts = _LAST.findall(attributes)
    return bool(parts) and "/" in parts[-1] and not parts[-1].strip(" \t\n\f\r/")


class _Page:
    """What is open while a page is read. Places of open elements are known by tag, so nothing searches the stack."""

    def __init__(self) -> None:
        self.out: list[Block] = []
        self.text: list[str] = []
        self.linked = self.links = self.begun = 0
        self.tags: list[str] = []
        self.words: list[tuple[str, ...]] = []
        self.nodes = [Node(None, "", (), ())]
        self.blocks: list[int] = []  # places of block elements on the stack
        self.places: dict[str, list[int]] = {}
        self.active: dict[str, int] = {}  # words of open elements

    def add(self, piece: str) -> None:
        if "&" in piece:
            piece = unescaped(piece)
        self.text.append(piece)
        if self.links:
            self.linked += len(piece.strip())

    def flush(self) -> None:
        if self.text:
            joined = " ".join("".join(self.text).split())
            if joined:
                self.out.append(Block(joined, self.nodes[-1], min(1.0, self.linked / len(joined)), self.begun))
            self.text.clear()
        self.linked = self.begun = 0

    def last(self, tags: tuple[str, ...]) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            words = _words(tag, attributes) if len(attributes) < 1000 else _words.__wrapped__(tag, attributes)
            fresh = tuple(w for w in words if not self.active.get(w))
            for w in words:
                self.active[w] = self.active.get(w, 0) + 1
            up = self.nodes[-1]
            named = words if tag not in PLAIN else words[1:]
            self.nodes.append(Node(up, tag, fresh, named or up.near))
            self.blocks.append(len(self.tags))
            self.words.append(words)
        elif tag == "a":
            self.links += 1
            self.begun += 1
        self.places.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)

    def close(self, where: int) -> None:
        if self.blocks and self.blocks[-1] >= where:
            self.flush()
        while len(self.tags) > where:
            tag = self.tags.pop()
            if not tag:  # ended before
                continue
            self.places[tag].pop()
            if tag in BLOCK:
                self.nodes.pop()
                self.blocks.pop()
                for w in self.words.pop():
                    self.active[w] -= 1
            elif tag == "a":
                self.links -= 1

    def end(self, tag: str) -> None:
        at = self.last(HEADINGS if tag in HEADINGS else (tag,))
        if tag == "br":
            self.text.append(" ")
        elif tag == "p" and at < 0:
            self.flush()
        elif tag in BLOCK:
            if at >= 0 and (tag in TABLE or at > self.last(CELLS)):
                self.close(at)
        elif at >= 0:
            if not self.blocks or at > self.blocks[-1]:
                self.close(at)
            else:  # ends within a block that it holds: what follows isn't its text
                self.places[tag].pop()
                self.tags[at] = ""
                self.links -= tag == "a"

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body", "head"):
            return
        if tag in BLOCK:
            self.flush()
            if tag in CLOSES_P and (p := self.last(("p",))) > self.last(("button", *CELLS)):
                self.close(p)
            if tag in HEADINGS and self.blocks and self.tags[self.blocks[-1]] in HEADINGS:
                self.close(self.blocks[-1])
            if tag in CLOSES:
                own, inside = CLOSES[tag]
                border = self.last(inside)
                first = min((i for t in own for i in self.places.get(t, ())[-1:] if i > border), default=-1)
                if first >= 0:
                    self.close(first)
        elif tag == "a" and (at := self.last(("a",))) >= 0:
            self.end("a")
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
        elif not (self.last(("svg", "math")) >= 0 and _closes_itself(attributes)):
            self.open(tag, attributes)


def blocks(page: str) -> list[Block]:
    """The leaf blocks in page order: text between tags of block elements. Character references are decoded; a br is white
    space. Comments, scripts, styles, titles, text fields and frames hold no text. Unclosed elements end with their parents.
    As in the standard, a tag, comment, script or style that never ends takes the rest of the page; other elements without an
    end tag don't."""
    p, at, n, endless = _Page(), 0, len(page), set()
    while at < n:
        sign = page.find("<", at)
        if sign != at:
            p.add(page[at : sign if sign >= 0 else n])
            if sign < 0:
                break
        at = sign
        m = _TAG.match(page, at)
        if not m:
            sort, letter = page[at + 1 : at + 2], page[at + 2 : at + 3]
            if page.startswith("<!--", at):
                found = _COMMENT_END.search(page, at + 2 if page.startswith((">", "->"), at + 4) else at + 4)
                at = found.end() if found else n
            elif sort in ("!", "?") or (sort == "/" and not (letter.isascii() and letter.isalpha())):
                end = page.find(">", at)
                at = end + 1 if end >= 0 else n
            elif sort == "/" or (sort.isascii() and sort.isalpha()):
                break  # a tag that never ends
            else:
                p.add("<")
                at += 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            p.end(tag)
        elif tag in RAW and tag not in endless:
            found = _RAW_END[tag].search(page, at)
            if found:
                close = _TAG.match(page, found.start())
                at = close.end() if close else n
            elif tag in ("script", "style"):
                break
            else:
                endless.add(tag)
        elif tag not in RAW:
            p.start(tag, m[3])
    p.flush()
    return p.out
