"""One page's HTML as text blocks with the elements they stand in.

No tree is built: a stack of open elements suffices, with the end tags HTML lets
authors leave out. Every scan step is linear in the page.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|title)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?"
    r"|<[!?][^>]*+>?",
    re.S | re.I,
)
NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.I)

# Element names by how HTML treats them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends an open element of the listed kinds.
ENDS = {
    **dict.fromkeys(
        "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split(),
        frozenset({"p"}),
    ),
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
    "body": frozenset({"head"}),
}
#: An omitted end tag is not looked for outside these.
WALLS = frozenset("ul ol dl table article section div aside nav main body html".split())


@dataclass(frozen=True)
class Element:
    """An open element: its name and what its attributes call it."""

    name: str
    called: tuple[str, ...] = ()

    def __str__(self) -> str:
        return ".".join((self.name, *self.called))


@dataclass
class Block:
    path: tuple[Element, ...]
    text: str
    words: int
    linked: int
    #: For each element of the path, the how manieth of the page it is.
    opened: tuple[int, ...] = ()


def called(attributes: str) -> tuple[str, ...]:
    """The names in class, id and role, and whether the element is hidden."""
    out: set[str] = set()
    for kind, *values in NAMED.findall(attributes):
        value = next((v for v in values if v), "").lower()
        kind = kind.lower()
        if kind in ("class", "id", "role"):
            out.update(re.sub(r"\d+", "0", value).split())
        elif kind == "hidden" or kind == "aria-hidden" and value == "true":
            out.add("hidden")
        elif kind == "style" and re.search(r"display\s*:\s*none", value):
            out.add("hidden")
    return tuple(sorted(out))


class _Page:
    def __init__(self) -> None:
        self.open: list[Element] = []
        self.opened: list[int] = []
        self.blocks: list[Block] = []
        self.tags: list[tuple[tuple[Element, ...], bool]] = []
        self.parts: list[str] = []
        self.links = 0
        self.linked = 0

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            words = text.count(" ") + 1
            self.blocks.append(Block(tuple(self.open), text, words, min(self.linked, words), tuple(self.opened)))
        self.parts, self.linked = [], 0

    def close_to(self, depth: int) -> None:
        self.flush()
        del self.open[depth:], self.opened[depth:]

    def start(self, name: str, attributes: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            before = self.open[depth].name
            if before in ENDS.get(name, ()):
                self.close_to(depth)
            elif before in WALLS:
                break
        self.flush()
        element = Element(name, called(attributes) if attributes.strip() else ())
        if name not in VOID:
            self.open.append(element)
            self.opened.append(len(self.tags))
            self.tags.append((tuple(self.open), True))

    def end(self, name: str) -> None:
        self.flush()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].name == name:
                self.tags.append((tuple(self.open[: depth + 1]), False))
                self.close_to(depth)
                return


def parse(source: str | None) -> tuple[list[Block], list[tuple[tuple[Element, ...], bool]]]:
    """The text blocks of a page in order, and its block tags as (path, is start)."""
    page, at, source = _Page(), 0, source or ""
    for tag in TAG.finditer(source):
        said = source[at : tag.start()]
        if said:
            page.parts.append(said)
            if page.links:
                page.linked += len(said.split())
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            page.parts.append(" " if tag["raw"] else "")
        elif name in INLINE:
            if name == "a":
                page.links = max(0, page.links + (-1 if tag["end"] else 1))
            elif name == "br":
                page.parts.append(" ")
        elif tag["end"]:
            page.end(name)
        else:
            page.start(name, tag["attributes"])
    page.parts.append(source[at:])
    page.flush()
    return page.blocks, page.tags
