"""HTML as a flat table of nodes: a forgiving parser, and the inside, the text and the attributes of an element.

Elements are numbered in document order. A node's subtree is the numbers from its own to ``last``, so ancestors, and what an
element holds, are ranges of numbers; its markup and its text are ranges of the page and of the page's text.

What browsers forgive is forgiven: end tags may be missing (a list item ends where the next one begins, a paragraph where a
block does, everything where its parent does), end tags of nothing are ignored, attributes may lack quotes, and what is open
at the end of the page ends there. Comments, declarations and the content of scripts and styles hold no elements.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable
from typing import NamedTuple

# Elements without content, elements whose content is no markup, and elements that end others.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title"))
UNSEEN = frozenset(("script", "style"))
_BLOCKS = "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
#: Start tag -> what it ends if open, unless one of the second lies between.
_ENDS = {
    **{name: (frozenset(("p",)), frozenset(("td", "th", "button"))) for name in _BLOCKS},
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))), "td": (frozenset(("td", "th")), frozenset(("tr", "table"))), "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([A-Za-z][^\s/>]*)[^>]*>?|<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class Node(NamedTuple):
    node: int
    parent: int  # -1 above the first level
    depth: int
    last: int  # the highest number of its subtree
    place: int  # among the elements of its parent, from 1
    places: int  # how many these are
    tag: str
    attributes: dict[str, str]
    open: int  # ranges of code points: with and without its own tags, then of the page's text
    start: int
    stop: int
    close: int
    text_from: int
    text_to: int


def attributes_of(tag: str) -> dict[str, str]:
    """Attributes of a start tag's inside, names in lower case; of repeated ones the first holds."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag):
        found.setdefault(m[1].lower(), entities.unescape(next((x for x in m.groups()[1:] if x is not None), "")))
    return found


def parse(page: str, decode: Callable[[str], str] = entities.unescape) -> tuple[list[Node], str]:
    """The nodes of a page in document order, and its text (entities decoded by ``decode``, without scripts and styles)."""
    rows: list[list] = []
    texts: list[str] = []
    stack: list[int] = []
    children = {-1: 0}
    length = at = 0

    def say(piece: str) -> None:
        nonlocal length
        if piece and not (stack and rows[stack[-1]][6] in UNSEEN):
            texts.append(decode(piece))
            length += len(texts[-1])

    def end(down_to: int, stop: int, close: int) -> None:
        """Closes open elements until ``down_to`` are left; the last one closed has the end tag."""
        while len(stack) > down_to:
            row = rows[stack.pop()]
            row[3], row[10], row[11], row[13] = len(rows) - 1, stop, close if len(stack) == down_to else stop, length

    while True:
        m = _TOKEN.search(page, at)
        if not m:
            break
        say(page[at : m.start()])
        at = m.end()
        if m[1]:
            name = m[1].lower()
            level = next((k for k in range(len(stack) - 1, -1, -1) if rows[stack[k]][6] == name), None)
            if level is not None:
                end(level, m.start(), at)
        elif m[2]:
            name = m[2].lower()
            ended, within = _ENDS.get(name, ((), ()))
            for k in range(len(stack) - 1, -1, -1) if ended else ():
                tag = rows[stack[k]][6]
                if tag in ended:
                    end(k, m.start(), m.start())
                if tag in ended or tag in within:
                    break
            parent = stack[-1] if stack else -1
            children[parent] += 1
            node = len(rows)
            children[node] = 0
            rows.append([node, parent, len(stack), node, children[parent], 0, name, attributes_of(m[3]), m.start(), at, at, at, length, length])
            if name in VOID or (m[3].endswith("/") and m[0].endswith(">")):
                continue
            stack.append(node)
            if name in RAW:
                closing = re.compile(rf"</{re.escape(name)}(?![A-Za-z0-9])[^>]*>?", re.I).search(page, at)
                stop, close = (closing.start(), closing.end()) if closing else (len(page), len(page))
                say(page[at:stop])
                end(len(stack) - 1, stop, close)
                at = close
    say(page[at:])
    end(0, len(page), len(page))
    for row in rows:
        row[5] = children[row[1]]
    return [Node(*row) for row in rows], "".join(texts)


def decode_ampersands(text: str) -> str:
    """Only what stands for an ampersand itself is decoded; other entities, and ones without their semicolon, stay."""
    return text.replace("&amp;", "&")


def inner_html(page: str) -> str:
    """What stands inside the first element; empty without one."""
    nodes, _ = parse(page)
    return page[nodes[0].start : nodes[0].stop] if nodes else ""


def inner_text(page: str) -> str:
    """The text inside the first element, or all of it where there is none."""
    nodes, text = parse(page)
    return text[nodes[0].text_from : nodes[0].text_to] if nodes else text


def attribute(page: str, name: str) -> str:
    """An attribute of the first element; empty without one."""
    nodes, _ = parse(page)
    return nodes[0].attributes.get(name.lower(), "") if nodes else ""
