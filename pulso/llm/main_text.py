"""Main text of web pages by composite text density.

For every block of the page's tree, with C characters, T tags, and LC characters in LT
links below it, the composite density is

    C/T * log_b( C/LC * T/LT ),   b = ln( C/(C-LC) * LC + LCbody/Cbody * C + e )

(zero divisors count as one), so text in few tags is dense and linked text
is not. A block's density sum adds up the densities of its child blocks. Blocks that say what they are by
element, role, class or id (navigation, page header, footer, sidebar, notice, advert, form, comments, script) are
set aside first, but never one around an article or main element, nor one with most of the unlinked text of the article or main
element around it (of the page, if it names no main element). Reader comments beside an article are set aside at any size. If all
of a page would go that way, only what is no text (scripts, controls) is set aside. The block with the largest density sum is the core of the main text; the smallest density on
its path to the body, body included, is the threshold. The core grows to its parent while another child of that parent joins,
and to the article or main element around it; children of the body (or of the page, without body) that join it are kept beside it.
A block joins unless it is set aside or mostly linked; beside an article or main element it must also reach the threshold.
Beside the core, link lists below the threshold are left out; inside it, and inside the article or main element around it, linked text stays. Names
do not count there on what holds text itself (headings, paragraphs, quotations, lists' items, tables and their cells): a heading's id says what the heading says.
Where the body itself is the core, such a block's class still counts, its id does not.

Texts of a block have white space turned into single spaces; blocks stand in page order, one a
line. Inline elements and line breaks do not end a block.

Defined results: NULL, empty and text-free pages give the empty text; pages without markup are one block;
unclosed and misnested elements are closed by the usual rules; repeated rows repeat; an empty table gives an empty result. All columns are kept.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .htmltree import Node, page_text, parse

ASIDE_TAGS = frozenset("""nav footer aside form script style noscript template iframe object svg canvas button select option textarea head title
    dialog menu xmp noembed noframes video audio search""".split())
# These hold no text of the page, whatever stands around or in them.
NO_TEXT = frozenset("""script style noscript template iframe object svg canvas button select option textarea head title
    xmp noembed noframes video audio""".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words of class and id values.
ASIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr
    notice notices notification alert popup modal overlay newsletter subscribe subscription signup login menu menus nav navbar navigation breadcrumb breadcrumbs
    sidebar aside widget widgets footer masthead share sharing social related recommended recommendations comment comments disqus
    reply replies respond toolbar pagination pager skip toc disclaimer copyright paywall donate adbox adslot adsense adunit""".split())
# Beginnings of such words where they are written together (commentlist, cookiebar, ...).
ASIDE_STEMS = ("comment", "advert", "cookie", "sidebar", "footer", "navig", "navbar", "breadcrumb", "newsletter", "sponsor")
# A class of these beginnings describes the page around (has-sidebar, no-banner).
ABOUT_OTHERS = frozenset("has with without no not js is".split())
HEADER_WORDS = frozenset(("header", "topbar"))
HOLDERS = frozenset(("article", "main"))
HEADINGS = frozenset("p h1 h2 h3 h4 h5 h6".split())
WORD = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


# These hold text themselves; their names say what the text is about.
TEXT_TAGS = HEADINGS | frozenset("blockquote li dt dd pre figure figcaption table caption thead tbody tfoot tr td th".split())
KEEP, BY_ID, BY_NAME, BY_KIND = range(4)


def _set_aside(node: Node, in_article: bool) -> int:
    """What sets a block aside: nothing, the id of a block that holds text, another name of one, or what the block is."""
    if node.tag in ASIDE_TAGS or (node.tag == "header" and not in_article):
        return BY_KIND
    if node.tag in ("#root", "html", "body") or not node.attrs:
        return KEEP
    attrs = node.attributes()
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ASIDE_ROLES:
        return BY_KIND
    if node.tag in HOLDERS:     # a reader comment may be an article of its own
        return BY_KIND if _comments(_words(attrs)) else KEEP
    said = lambda words: bool(words & ASIDE_WORDS or any(w.startswith(ASIDE_STEMS) for w in words) or (not in_article and words & HEADER_WORDS))
    if node.tag not in TEXT_TAGS:
        return BY_KIND if said(_words(attrs)) else KEEP
    return BY_NAME if said(_words(attrs, ("class",))) else BY_ID if said(_words(attrs, ("id",))) else KEEP


def _words(attrs: dict[str, str], of: tuple[str, ...] = ("class", "id")) -> set[str]:
    words: set[str] = set()
    for name in " ".join(attrs.get(a, "") for a in of).split():
        parts = WORD.findall(CAMEL.sub(" ", name).lower())
        if parts and parts[0] not in ABOUT_OTHERS:
            words.update(parts)
    return words


def _comments(words: set[str]) -> bool:
    return any(w.startswith("comment") or w in ("reply", "replies") for w in words)


def _core_path(nodes: list[Node], up: list[int], named: list[int], free: list[int], never: list[bool]) -> set[int]:
    """The blocks that are not set aside whatever they are called: those around an article or main element, and those with
    most of the unlinked text. ``named`` are the blocks called something aside, ``free`` the unlinked characters below each."""
    size = len(nodes)
    talk = [bool(named[k] and n.attrs) and _comments(_words(n.attributes())) for k, n in enumerate(nodes)]
    under_talk = talk[:]
    for k in range(1, size):
        under_talk[k] = talk[k] or under_talk[up[k]]
    holders = {k for k, n in enumerate(nodes) if n.tag in HOLDERS and not named[k] and not never[k] and free[k]}
    # An article among reader comments is one of them, unless the page has no other.
    holders = {k for k in holders if nodes[k].tag == "main" or not under_talk[k]} or holders
    has_main = any(nodes[k].tag == "main" for k in holders)
    whole: set[int] = set()
    for a in holders:
        a = up[a]
        while a >= 0 and a not in whole:
            whole.add(a)
            a = up[a]
    scope, in_main = [0] * size, [False] * size
    for k in range(size):
        a = up[k]
        if a >= 0:
            scope[k], in_main[k] = (a if a in holders else scope[a]), in_main[a]
        in_main[k] = in_main[k] or (k in holders and nodes[k].tag == "main")
        if 2 * free[k] > free[scope[k]] and (in_main[k] or not has_main) and not (talk[k] and holders):
            whole.add(k)
    return whole


def density(c: int, t: int, lc: int, lt: int, body_share: float) -> float:
    """Composite text density; ``body_share`` is the linked share of the body's characters."""
    if not c:
        return 0.0
    t = max(t, 1)
    base = math.log(c / max(c - lc, 1) * lc + body_share * c + math.e)
    inner = (c / max(lc, 1)) * (t / max(lt, 1))
    # Without any link on the page the correction has no base; the plain density remains.
    return c / t * (max(math.log(inner), 0.0) / math.log(base) if base > 1 + 1e-9 else 1.0)


def main_text(html: str) -> str:
    """The main text of one page (see the module's notes)."""
    nodes = parse(html)
    number = {id(n): k for k, n in enumerate(nodes)}
    up = [number[id(n.parent)] if n.parent else -1 for n in nodes]
    size = len(nodes)
    inside, never, named = [False] * size, [False] * size, [KEEP] * size
    chars, linked_chars = [0] * size, [0] * size
    all_c = all_lc = 0
    for k, n in enumerate(nodes):
        above = up[k]
        inside[k] = n.tag in HOLDERS or (above >= 0 and inside[above])
        never[k] = n.tag in NO_TEXT or (above >= 0 and never[above])
        named[k] = _set_aside(n, above >= 0 and inside[above])
        for p in n.parts:
            if not isinstance(p, Node):
                found = len("".join(p[0].split()))
                chars[k] += found
                linked_chars[k] += found * p[1]
        if n.tag not in ("script", "style", "title", "head"):
            all_c, all_lc = all_c + chars[k], all_lc + linked_chars[k]
    free = [0 if never[k] else chars[k] - linked_chars[k] for k in range(size)]
    for k in range(size - 1, 0, -1):
        free[up[k]] += free[k]
    whole = _core_path(nodes, up, named, free, never)

    def without(least: int) -> list[bool]:
        out = [False] * size
        for k in range(size):
            out[k] = never[k] or (up[k] >= 0 and out[up[k]]) or (named[k] >= least and k not in whole)
        return out

    aside = without(BY_ID)
    if free[0] and not any(chars[k] > linked_chars[k] and not aside[k] for k in range(size)):
        return _grow(nodes, up, never, never, never, chars, linked_chars, all_lc / max(all_c, 1))
    return _grow(nodes, up, aside, without(BY_NAME), without(BY_KIND), chars, linked_chars, all_lc / max(all_c, 1))


def _sums(nodes: list[Node], up: list[int], aside: list[bool], chars: list[int], linked_chars: list[int], share: float) -> tuple[list, list, list, list, list]:
    """Per block: characters, linked characters and links below it, composite density, and the sum of its child blocks' densities."""
    size = len(nodes)
    c, lc, t, lt = chars[:], linked_chars[:], [n.tags for n in nodes], [n.links for n in nodes]
    for k in range(size - 1, 0, -1):
        if not aside[k]:
            a = up[k]
            c[a], t[a], lc[a], lt[a] = c[a] + c[k], t[a] + t[k] + 1, lc[a] + lc[k], lt[a] + lt[k]
    dense = [0.0 if aside[k] else density(c[k], t[k], lc[k], lt[k], share) for k in range(size)]
    total = [0.0] * size
    for k in range(1, size):
        total[up[k]] += dense[k]
    return c, lc, lt, dense, total


def _grow(nodes: list[Node], up: list[int], aside: list[bool], in_body: list[bool], in_core: list[bool], chars: list[int], linked_chars: list[int], share: float) -> str:
    """The text of the core and what belongs to it; ``chars`` and ``linked_chars`` count each block's own text. Blocks are left out by
    ``aside``, but by ``in_core`` below the core, or by ``in_body`` if that is the body."""
    size = len(nodes)
    c, lc, lt, dense, total = _sums(nodes, up, aside, chars, linked_chars, share)
    frame = {k for k, n in enumerate(nodes) if n.tag in ("#root", "html", "body")}
    core = max((k for k in range(size) if not aside[k]), key=lambda k: (total[k], -k))
    if total[core] <= 0:
        core = 0
    path = first = core
    threshold = dense[core]
    held = False
    while path >= 0:
        threshold, held = min(threshold, dense[path]), held or nodes[path].tag in HOLDERS
        path = -1 if path in frame else up[path]
    kids: dict[int, list[int]] = {}
    for k in range(1, size):
        kids.setdefault(up[k], []).append(k)
    linked = lambda k: lt[k] > 1 and 2 * lc[k] > c[k]

    def joins(j: int) -> bool:
        if j == core or j in frame or aside[j] or linked(j):
            return False
        return dense[j] >= threshold > 0 or (not held and 2 * lc[j] < c[j])

    def company(k: int) -> bool:
        return any(map(joins, kids.get(k, ()))) or (not held and linked_chars[k] < chars[k])

    while core not in frame and up[core] not in frame and company(up[core]):
        core = up[core]
    if core in frame:
        # Blocks side by side: an article or main element with most of the text is the main text.
        core = next((k for k, n in enumerate(nodes) if n.tag in HOLDERS and not aside[k] and 2 * c[k] >= c[core] > 0), core)
    holder = core
    while holder >= 0 and nodes[holder].tag not in HOLDERS:
        holder = up[holder]
    if holder >= 0:
        core, held = holder, True
    # What is below the densest block, or below the article or main element around it, is text of its own.
    own, own_aside = (holder, in_core) if holder >= 0 else (first, in_body if first in frame else in_core)
    below = [False] * size
    for k in range(size):
        below[k] = k == own or (up[k] >= 0 and below[up[k]])
    apart: set[int] = set()
    if core not in frame and up[core] in frame and any(map(company, frame)):
        apart = {j for k in frame for j in kids.get(k, ()) if j != core and j not in frame and not joins(j)}
        core = 0

    left_out = {id(n) for k, n in enumerate(nodes) if k in apart or (own_aside[k] if below[k] else aside[k] or (
        k != core and linked(k) and dense[k] < threshold and n.tag not in HEADINGS))}
    return page_text(nodes[core], lambda n: id(n) in left_out)


def extract(html: str = "html") -> Column:
    """The main text of a page column."""

    @F.arrow_udf("string")
    def run(col: pa.Array) -> pa.Array:
        return pa.array([main_text(h or "") for h in col.to_pylist()], pa.string())

    return run(F.col(html).cast("string"))
