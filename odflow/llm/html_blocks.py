"""Leaf blocks of raw HTML, in page order: their text, tag path and share of link text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Element names of the HTML standard by their role for text flow.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split())
RAW = frozenset("script style noscript template svg math iframe object textarea select title xmp noembed noframes".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: Start tags that end an open element of the same group, up to the given containers.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}

_TOKEN = re.compile(r"<!--|<!|<\?|<(/?)([A-Za-z][A-Za-z0-9:-]*)", re.S)
#: Attributes as the HTML standard reads them: quotes count only right after the equals sign; elsewhere they are ordinary characters.
_ATTR = re.compile(r"""(=?[^\s/>=]+|=)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|((?!["'])[^\s>]+)))?""")
_REST = re.compile(r"""(?:[\s/]++|(?>=?[^\s/>=]++|=)(?>\s*+=\s*+(?>"[^"]*"|'[^']*'|(?=>)|(?!["'])[^\s>]++))?+)*+>""")
_NAMES = re.compile(r"[a-z]+")


class Open:
    """An open element: name, path entry (its name and the words of class, id and role) and the element around it. Blocks share
    these, so a page of any depth takes memory in proportion to its length."""

    __slots__ = ("name", "entry", "parent")

    def __init__(self, name: str, entry: str, parent: "Open | None"):
        self.name, self.entry, self.parent = name, entry, parent


@dataclass(slots=True)
class Block:
    text: str
    inside: Open | None
    link_chars: int

    @property
    def path(self) -> tuple[str, ...]:
        """Entries of the elements open where the block's text begins, outermost first."""
        out, node = [], self.inside
        while node is not None:
            out.append(node.entry)
            node = node.parent
        return tuple(reversed(out))


def _names(attributes: str) -> tuple[str, ...]:
    """Lower-case words of the class, id and role attributes."""
    if not attributes or attributes.isspace():
        return ()
    out = []
    for name, *values in _ATTR.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            text = html.unescape("".join(values))
            out += _NAMES.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", text).lower())
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """Non-empty leaf blocks. A block is the text between two boundaries of block-level elements or line breaks; character
    references are decoded and white space is turned into single spaces. Comments, scripts, styles, the
    head's title and other raw content are no text; unclosed ones, and a cut-off tag, reach to the end.

    The path has an entry for each element open where the block's text begins: its name, and the words of
    its class, id and role. Time and memory grow with the page's length, however deep its elements lie.
    """
    out: list[Block] = []
    stack: list[Open] = []
    places: dict[str, list[int]] = {}  # of each name's open elements in the stack
    pieces: list[str] = []
    inside: Open | None = None
    begun = False
    links = 0

    def end_block() -> None:
        nonlocal links, inside, begun
        text = " ".join("".join(pieces).split())
        if text:
            out.append(Block(text, inside, links))
        pieces.clear()
        links, inside, begun = 0, None, False

    def add(raw: str) -> None:
        nonlocal links, inside, begun
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            if not begun and not text.isspace():
                inside, begun = stack[-1] if stack else None, True
            pieces.append(text)
            if places.get("a"):
                links += len("".join(text.split()))

    def last(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def push(name: str, entry: str) -> None:
        places.setdefault(name, []).append(len(stack))
        stack.append(Open(name, entry, stack[-1] if stack else None))

    def pop_to(names: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
        k = last(names)
        if k >= 0 and k > last(stops):
            while len(stack) > k:
                places[stack.pop().name].pop()

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        name = m.group(2)
        if name is None:
            end = page.find("-->", m.end()) if m.group() == "<!--" else page.find(">", m.end())
            at = n if end < 0 else end + (3 if m.group() == "<!--" else 1)
            continue
        rest = _REST.match(page, m.end())
        if rest is None:
            plain = page.find(">", m.end())
            if plain < 0:
                break
            attributes, at = page[m.end():plain], plain + 1
        else:
            attributes, at = rest.group()[:-1], rest.end()
        name = name.lower()
        if m.group(1):
            if name in INLINE:
                pop_to({name}, CLOSES_P)
            else:
                end_block()
                pop_to({name}, set())
            continue
        if name in INLINE:
            if name not in VOID:
                push(name, name)
            continue
        end_block()
        if name in RAW:
            close = re.compile(r"</" + name + r"(?=[\s/>])", re.I).search(page, at)
            if attributes.rstrip().endswith("/"):
                continue
            end = page.find(">", close.end()) if close else -1
            at = n if end < 0 else end + 1
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            pop_to({"p"}, {"button", "table", "td", "th"})
        if name in SIBLINGS:
            pop_to(*SIBLINGS[name])
        push(name, " ".join((name, *_names(attributes))))
    end_block()
    return out
