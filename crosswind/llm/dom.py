"""HTML as a tree of slots and the text blocks in them, and matching of two such trees."""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

# Elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template svg iframe object canvas xmp".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
BESIDE = set("aside button dialog footer form head menu nav select".split())
BESIDE_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split()
)
BESIDE_NAMES = set(
    "ad ads advert advertisement advertisements adverts breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr login menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup "
    "promo promoted promotion recommended related respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar widget widgets".split()
)
HEADER_NAMES = set("banner header masthead topbar".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# An element of the key ends where one of the values begins, but not beyond the boundary.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>|<[!?][^>]*+>""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
BEGINS = re.compile("<[A-Za-z/!?]")
# Elements nested deeper than this are counted to the slot above them.
DEEPEST = 100
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Block(NamedTuple):
    """Text of one block: its slot, the article it is in (0: none; below 0: one in an element beside), characters in links."""

    slot: int
    article: int
    links: int
    text: str


class Open(NamedTuple):
    tag: str
    slot: int
    article: int
    beside: int
    link: bool


@lru_cache(maxsize=50_000)
def role_of(tag: str, raw: str) -> int:
    """0: may be content; 1: beside it; 2: a header, of the page or of the article."""
    if tag in BESIDE:
        return 1
    if tag == "header":
        return 2
    if not raw or tag in ("html", "body", "main", "article"):
        return 0
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(raw)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return 1
    if found.get("role", "").lower() in BESIDE_ROLES:
        return 1
    names = [n.lower() for n in NAME.findall(f"{found.get('class', '')} {found.get('id', '')}")]
    # "has-sidebar" tells of something inside, it does not name this element.
    own = [n for before, n in zip(["", *names], names) if before not in ("has", "with", "no")]
    if BESIDE_NAMES & set(own):
        return 1
    return 2 if HEADER_NAMES & set(own) else 0


@lru_cache(maxsize=50_000)
def named_beside(raw: str) -> int:
    """1 if an article's attributes say that it is a comment, an advert or the like, otherwise 0."""
    if re.search(r"schema\.org/(?:User)?Comment|itemprop\s*=\s*[\"']?comment", raw, re.I):
        return 1
    return int(role_of("div", raw) == 1)


def parse(text: str) -> tuple[str, list[Block]]:
    """The tree of slots, written out, and the blocks that may be content.

    Slots are elements without their text; siblings of the same name share one,
    so a page with more paragraphs has the same tree. Elements that were
    left open end as browsers end them, and stray end tags are passed over.
    """
    tags, parents, slots = ["#"], [-1], {}
    stack = [Open("#", 0, 0, 0, False)]
    open_tags: Counter[str] = Counter()
    blocks: list[Block] = []
    parts: list[str] = []
    linked = articles = 0
    place = stack[0]

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                blocks.append(Block(place.slot, place.article, linked, joined))
            parts, linked = [], 0

    def add(piece: str) -> None:
        nonlocal linked
        if not top.beside and piece:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if top.link:
                linked += len(piece.strip())

    def close(depth: int) -> None:
        open_tags.subtract(o.tag for o in stack[depth:])
        del stack[depth:]

    def depth_of(tag: str) -> int:
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag) if open_tags[tag] > 0 else 0

    top, at, size = stack[0], 0, len(text)
    last_end = text.rfind(">")
    while at < size:
        # Behind the last ">" no tag is complete, and what begins as one is none.
        found = TAG.search(text, at) if at <= last_end else None
        if not found:
            cut = BEGINS.search(text, at)
            add(text[at : cut.start() if cut else size])
            break
        add(text[at : found.start()])
        at = found.end()
        if found.group(2) is None:
            continue
        tag, raw = found.group(2).lower(), found.group(3)
        if tag in BLOCKS or tag == "br":
            if tag == "br":
                add(" ")
            else:
                flush()
        if found.group(1):
            depth = depth_of(tag)
            if depth:
                if any(o.tag in BLOCKS for o in stack[depth:]):
                    flush()
                close(depth)
        else:
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(text, at)
                at = end.end() if end and not raw.endswith("/") else at if raw.endswith("/") else size
                continue
            if tag in VOID:
                continue
            if tag in BLOCKS:
                if tag not in ("html", "body"):
                    depth = depth_of("p")
                    if depth and not any(o.tag in ("td", "th", "button") for o in stack[depth:]):
                        close(depth)
                ended, bounds = ENDS.get(tag, ((), ()))
                for i in range(len(stack) - 1, 0, -1) if any(open_tags[e] > 0 for e in ended) else ():
                    if stack[i].tag in ended:
                        close(i)
                        break
                    if stack[i].tag in bounds:
                        break
            top = stack[-1]
            child = slots.get((top.slot, tag))
            if child is None:
                child = top.slot
                if len(stack) < DEEPEST:
                    child = slots[top.slot, tag] = len(tags)
                    tags.append(tag)
                    parents.append(top.slot)
            role = role_of(tag, raw.strip())
            beside, article = top.beside, top.article
            if tag == "article":
                if article:
                    # An article in an article is part of it, unless it names itself a comment or the like.
                    beside = beside or named_beside(raw.strip())
                elif beside != 1 or any(o.beside == 1 and o.tag in ("nav", "form", "div") for o in stack):
                    articles += 1
                    article, beside = articles if beside != 1 else -articles, 0
            elif role == 1:
                beside = 1
            elif role == 2 and not beside:
                beside = 2
            elif beside == 2 and article and tag in HEADINGS:
                beside = 0
            open_tags[tag] += 1
            stack.append(Open(tag, child, article, beside, top.link or tag == "a"))
        top = stack[-1]
        if tag in BLOCKS:
            place = top
    flush()
    return " ".join(f"{p}:{t}" for p, t in zip(parents[1:], tags[1:])), blocks


def children_of(tree: str) -> tuple[list[str], list[list[int]]]:
    """Tags and children of a tree that was written out; slot 0 is the root."""
    tags, children = ["#"], [[]]
    for slot, item in enumerate(tree.split(), 1):
        parent, tag = item.split(":", 1)
        tags.append(tag)
        children.append([])
        children[int(parent)].append(slot)
    return tags, children


def matching(tree: str, reference: str) -> dict[int, int]:
    """Slots of a tree and those of the reference they match, by simple tree matching.

    Two slots of the same tag match with as many pairs as the best order-keeping
    alignment of their children gives, plus themselves.
    """
    tags, children = children_of(tree)
    other_tags, other_children = children_of(reference)
    tables: dict[tuple[int, int], tuple[int, tuple | None]] = {}

    def score(a: int, b: int) -> int:
        if tags[a] != other_tags[b]:
            return 0
        if (a, b) in tables:
            return tables[a, b][0]
        # A slot's children differ in their tags, so each has one counterpart at most, and the best
        # alignment is the heaviest chain of counterparts in rising order: a tree of prefix maxima finds it.
        places = {other_tags[y]: (j, y) for j, y in enumerate(other_children[b], 1)}
        best: list[tuple[int, tuple | None]] = [(0, None)] * (len(other_children[b]) + 1)
        for x in children[a]:
            j, y = places.get(tags[x], (0, 0))
            if not j:
                continue
            gain, before, at = score(x, y), (0, None), j - 1
            while at:
                before = max(before, best[at], key=lambda chain: chain[0])
                at &= at - 1
            chain = before[0] + gain, (x, y, before[1])
            while j < len(best):
                if best[j][0] < chain[0]:
                    best[j] = chain
                j += j & -j
        whole, at = (0, None), len(best) - 1
        while at:
            whole = max(whole, best[at], key=lambda chain: chain[0])
            at &= at - 1
        tables[a, b] = whole[0] + 1, whole[1]
        return tables[a, b][0]

    score(0, 0)
    pairs, open_pairs = {0: 0}, [(0, 0)]
    while open_pairs:
        link = tables[open_pairs.pop()][1]
        while link:
            x, y, link = link
            pairs[x] = y
            open_pairs.append((x, y))
    return pairs
