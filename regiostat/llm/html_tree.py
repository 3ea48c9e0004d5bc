"""A small forgiving HTML reader: elements with their parents, and text runs.

Only what extraction needs: block elements (and inline ones whose class names
them as clutter) are nodes, other inline elements belong to the node around
them; raw text elements are skipped; optional end tags are implied."""

from __future__ import annotations

import re
from html import unescape

# Fixed values from the HTML standard: which elements are blocks, close an
# open paragraph, are void, or hold no page text.
CLOSE_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
                    "main menu nav ol p pre search section summary table ul".split())
BLOCKS = CLOSE_P | frozenset("html body head li dd dt tr td th tbody thead tfoot caption legend button select option optgroup label output datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math canvas audio video object applet".split())
#: A new element of the key ends an open one of these, up to the nearest of the others.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"td", "th", "tr"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}), "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}), "body": ({"head"}, {"html"}),
}
#: An end tag reaches no further than these.
FENCE = frozenset("table td th".split())

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAMING = ("class", "id", "role", "itemprop", "hidden", "style", "aria-label", "aria-hidden")


class Node:
    __slots__ = ("tag", "names", "parent", "depth", "chars", "links")

    def __init__(self, tag: str, names: dict[str, str], parent: int, depth: int):
        self.tag, self.names, self.parent, self.depth, self.chars, self.links = tag, names, parent, depth, 0, 0


def read(html: str, is_clutter) -> tuple[list[Node], list[tuple[int, bool, str]]]:
    """``(nodes, runs)``; node 0 is the page.  A run is (node, new block
    begins here, raw text decoded).  ``is_clutter(names)`` tells which inline
    elements are nodes of their own."""
    nodes, runs = [Node("#page", {}, -1, 0)], []
    stack: list[tuple[str, int, bool]] = [("#page", 0, True)]  # tag, node, block
    at, new_block, links = 0, True, 0
    lower = None

    def text(raw: str) -> None:
        nonlocal new_block
        if raw:
            node = stack[-1][1]
            decoded = unescape(raw) if "&" in raw else raw
            n = len(decoded.strip())
            nodes[node].chars += n
            if links:
                nodes[node].links += n
            runs.append((node, new_block, decoded))
            new_block = False

    def cut(i: int) -> None:
        """Close everything from place ``i`` of the stack on."""
        nonlocal new_block, links
        new_block |= any(entry[2] for entry in stack[i:])
        if links:
            links -= sum(entry[0] == "a" for entry in stack[i:])
        del stack[i:]

    while True:
        m = _TAG.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at, name = m.end(), m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            block = name in BLOCKS
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    cut(i)
                    break
                if stack[i][0] in FENCE and name != "table" or (not block and stack[i][0] in BLOCKS):
                    break
            continue
        if name == "br":
            runs.append((stack[-1][1], new_block, " "))
            continue
        if name in SKIPPED:
            if not m[3].endswith("/"):
                lower = html.lower() if lower is None else lower
                if len(lower) != len(html):
                    end = re.compile("</" + re.escape(name), re.I).search(html, at)
                    end = end.start() if end else -1
                else:
                    end = lower.find("</" + name, at)
                at = len(html) if end < 0 else end
            continue
        if name in VOID:
            new_block |= name == "hr"
            continue
        if name in CLOSE_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    cut(i)
                    break
                if stack[i][0] in BLOCKS and stack[i][0] != "label":
                    break
        if name in IMPLIED:
            ends, fence = IMPLIED[name]
            hit = None
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in fence:
                    break
                if stack[i][0] in ends:
                    hit = i
            if hit is not None:
                cut(hit)
        names = {}
        if len(m[3]) > 3:
            for a in _ATTR.finditer(m[3]):
                key = a[1].lower()
                if key in _NAMING:
                    names[key] = (a[2] or "").strip("\"'").lower()
        block = name in BLOCKS
        node = stack[-1][1]
        if block or (names and is_clutter(names)):
            nodes.append(Node(name, names, node, nodes[node].depth + 1))
            node = len(nodes) - 1
        new_block |= block
        links += name == "a"
        stack.append((name, node, block))
    return nodes, runs
