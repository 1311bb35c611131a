"""HTML as a sequence of text blocks with the tag path of each."""

from __future__ import annotations

import html
import re

#: Elements inside a line, elements without content, elements whose content is no markup up to a like end tag.
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "title", "textarea", "iframe")
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

_ASIDE, _CUT = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", r"(?P<cut><[/!?a-zA-Z][^>]*(?:>|\Z))|[^<]+|<"
_TOKEN = re.compile(rf"""{_ASIDE}|</?[a-zA-Z][^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*>|{_CUT}""", re.S)
_CUT_TOKEN = re.compile(f"{_ASIDE}|{_CUT}", re.S)
_QUOTE_OR_END = re.compile("""[>"']""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Element:
    """An open element: its name, the words of its class, id and role, and the element around it."""

    __slots__ = ("name", "hints", "parent", "depth", "seen")

    def __init__(self, name: str, hints: tuple[str, ...], parent: Element | None):
        self.name, self.hints, self.parent = name, hints, parent
        self.depth = parent.depth + 1 if parent else 1
        self.seen = None  # room for what a reader makes of the path down to here


class Block:
    """Text with white space as single spaces; the innermost element around it; characters in links."""

    __slots__ = ("text", "inside", "linked")

    def __init__(self, text: str, inside: Element | None, linked: int):
        self.text, self.inside, self.linked = text, inside, linked


def _hints(tag: str) -> tuple[str, ...]:
    return tuple(w.lower() for value in _HINT.findall(tag) for w in _WORDS.findall(value))


def _tag_end(source: str, at: int, dead: set[int]) -> int:
    """Past the first > behind `at` that stands in no quotes; 0 if there is none.

    `dead` keeps the opening quotes from which there is none: a search ends at the first that it meets, so all searches in a
    page together look at each quote once.
    """
    met = []
    found = _QUOTE_OR_END.search(source, at)
    while found and found.start() not in dead:
        if found[0] == ">":
            return found.end()
        met.append(found.start())
        end = source.find(found[0], found.end())
        found = _QUOTE_OR_END.search(source, end + 1) if end >= 0 else None
    dead.update(met)
    return 0


class _Open:
    """The open elements, with the places of each name and of those that an element cannot close over: no tag walks them."""

    def __init__(self):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []

    def top(self) -> Element | None:
        return self.stack[-1] if self.stack else None

    def push(self, name: str, hints: tuple[str, ...]) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in INLINE and name not in SELF_CLOSING:
            self.walls.append(len(self.stack))
        self.stack.append(Element(name, hints, self.top()))

    def close(self, name: str, over_walls: bool) -> None:
        """Closes the innermost element of that name and all in it, if there is one."""
        own = self.places.get(name)
        if not own or not over_walls and self.walls and self.walls[-1] > own[-1]:
            return
        for k in range(len(self.stack) - 1, own[-1] - 1, -1):
            self.places[self.stack.pop().name].pop()
            if self.walls and self.walls[-1] == k:
                self.walls.pop()


def blocks(source: str | None, titles: bool = False) -> list[Block]:
    """Blocks in page order; never fails. Time is in proportion to the page.

    A tag ends at the first > outside quotes, or, where its quotes leave none, at the first > of all.

    Comments, scripts, styles, text areas, inline frames, and without `titles` titles are left out. One of those that is
    never closed goes to the end of the page; all other elements that are not closed, or closed but not open, are
    taken as they come.
    """
    if not source:
        return []
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked, in_link, at, size = 0, 0, 0, len(source)
    dead: set[int] = set()

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, open_.top(), linked))
        parts.clear()
        linked = 0

    while at < size:
        match = (_CUT_TOKEN if dead else _TOKEN).match(source, at)
        token, start, at = match[0], at, match.end()
        named = _NAME.match(token) if token[0] == "<" else None
        if named and match["cut"] and (end := _tag_end(source, start, dead)):
            token, at = source[start:end], end
        if named is None:
            if token[:2] not in ("<!", "<?", "</"):
                parts.append(token)
                linked += len(token) if in_link else 0
            continue
        name, closing = named[1].lower(), token[1] == "/"
        if name in VOID:
            if name not in INLINE:
                flush()
            elif name in ("br", "wbr", "img"):
                parts.append(" " if name == "br" else "")
            continue
        if name in _END:
            flush()
            if not closing and not token.endswith("/>"):
                end = _END[name].search(source, at)
                if titles and name == "title":
                    parts.append(source[at : end.start() if end else size])
                    flush()
                at = end.end() if end else size
            continue
        if name == "a":
            in_link = 0 if closing else 1
        if name not in INLINE:
            flush()
        if closing:
            open_.close(name, True)
            continue
        if name in SELF_CLOSING:
            open_.close(name, False)
        if not token.endswith("/>"):
            open_.push(name, _hints(token))
    flush()
    return out


def plain_text(source: str | None) -> str:
    """All text of a page, its title first of all where it stands, one block a line."""
    return "\n".join(b.text for b in blocks(source, titles=True))
