"""A forgiving reader of HTML into a light tree of block nodes.

Inline elements are not nodes: their text, tag count and link text count for the block they stand in.
Reading is one pass over the tags with explicit stacks, so depth and size are bounded by memory only.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""html head body article section main nav header footer aside address div p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd
    blockquote pre figure figcaption table caption thead tbody tfoot tr td th form fieldset legend details summary dialog menu
    center hr script style noscript template iframe object svg canvas button select option textarea title xmp noembed noframes video audio search""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr main menu nav ol p pre search section table ul""".split())
# An opening tag ends an open sibling of these kinds, looked for up to the nearest of the given holders.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
            "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
# A comment, a declaration, or the name of a tag, whose attributes are read by ``_tag_end``.
MARKUP = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)""", re.S)
IN_TAG = re.compile(r"""[>"']""")
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}


def _tag_end(html: str, at: int) -> int:
    """Where the ``>`` stands that ends a tag, outside quoted values of any length; -1 if there is none."""
    while m := IN_TAG.search(html, at):
        if m[0] == ">":
            return m.start()
        at = html.find(m[0], m.end()) + 1
        if not at:
            return -1
    return -1


class Node:
    """A block element; ``parts`` are texts and child blocks in page order, each text with a link flag."""

    __slots__ = ("tag", "attrs", "parent", "parts", "tags", "links")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[tuple[str, bool] | Node] = []
        self.tags = self.links = 0      # inline tags and links that begin in this block

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(self.attrs)}


def parse(html: str, links: list[str] | None = None) -> list[Node]:
    """All block nodes in page order, the first is the root; character references in texts are decoded.
    ``links`` gets the targets of the page's links."""
    root = Node("#root", "", None)
    nodes, here = [root], root
    link_depth = 0
    at = 0
    quotes = True       # until a tag does not end by its quotes: it and all later ones end at the first >

    def text(s: str) -> None:
        if s:
            here.parts.append((unescape(s), link_depth > 0))

    while True:
        m, stop = MARKUP.search(html, at), -1
        if m and m["tag"]:
            if quotes:
                stop = _tag_end(html, m.end())
                quotes = stop >= 0
            stop = stop if quotes else html.find(">", m.end())
            m = m if stop >= 0 else None        # nothing after this place is a tag
        text(html[at:m.start()] if m else html[at:])
        if not m:
            return nodes
        if not m["tag"]:
            at = m.end()
            continue
        at, attrs = stop + 1, html[m.end():stop]
        tag = m["tag"].lower()
        if m["end"]:
            if tag not in BLOCK:
                if tag == "a":
                    link_depth = 0
                continue
            node = here
            while node is not root and node.tag != tag:
                # A paragraph's end does not reach out of the block around it.
                node = root if tag == "p" and node.tag not in ("p", "center") else node.parent
            if node is not root:
                here, link_depth = node.parent, 0
            continue
        if tag not in BLOCK:
            here.tags += 1
            if tag == "a":
                here.links += 1
                link_depth = 1
                if links is not None:
                    links += [unescape(v[2] or v[3] or v[4] or "").strip() for v in ATTR.finditer(attrs) if v[1].lower() == "href"][:1]
            elif tag == "br":
                here.parts.append((" ", False))
            continue
        if tag in CLOSES_P:
            node = here
            if node.tag == "p":
                here = node.parent
        if tag in SIBLINGS:
            kinds, holders = SIBLINGS[tag]
            node = here
            while node is not root and node.tag not in holders:
                if node.tag in kinds:
                    here = node.parent
                    break
                node = node.parent
        node = Node(tag, attrs, here)
        here.parts.append(node)
        nodes.append(node)
        if tag in RAW:
            end = RAW_END[tag].search(html, at)
            inner = html[at:end.start()] if end else html[at:]
            node.parts.append((unescape(inner) if tag in ("title", "textarea") else inner, False))
            at = end.end() if end else len(html)
        elif tag not in VOID and not attrs.endswith("/"):
            here = node
            if tag != "a":
                link_depth = 0


def page_text(top: Node, hidden: Callable[[Node], bool]) -> str:
    """The texts below ``top`` in page order, one line for each block, without hidden blocks."""
    lines: list[str] = []
    run: list[str] = []
    todo: list = [top]
    while todo:
        p = todo.pop()
        if isinstance(p, tuple):
            run.append(p[0])
            continue
        line = " ".join("".join(run).split())
        run.clear()
        if line:
            lines.append(line)
        if p is not None and not hidden(p):
            todo.append(None)
            todo.extend(reversed(p.parts))
    return "\n".join(lines)
