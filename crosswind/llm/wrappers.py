"""Main text of pages by wrapper induction over the pages of a host.

Each page becomes a tree of slots with text blocks in them; menus, forms,
adverts, comments and the like, which name themselves, are left out at once. The
trees of a host are aligned with its most frequent one by simple tree matching,
so a block's slot means the same on all of its pages. A slot that holds the same
text on most of a host's different pages is template; one whose text varies is
content. The smallest element that holds all of the varying text of all pages,
of ``<main>`` where there is one, is the host's content slot, and what stands in
it on a page is the page's text. Lists that are mostly links are left out, single
paragraphs that are links are not.

Inside an ``<article>`` nothing is taken for template: a passage that many
articles of a host share is still part of each. Several articles follow one
another in the text; those that are mostly links are left out. A page that has
no slot for the host's content is judged by its own varying text.

Nulls: a null page is an empty one and has no text; pages without a host are a
host of their own. Rows that repeat give the same text each. An empty table
gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswind.llm.common import lookup, ship, slices
from crosswind.llm.dom import Block, children_of, matching, parse
from crosswind.session import settle

# A text is template if at least so many different pages of the host show it in its slot,
FEWEST_PAGES = 3
# and they are at least this share of those that have the slot.
MOST = 0.5
# Share of the characters of a block, a list or an article that may be links.
LINKS = 0.5

# Elements that only hold others, and those whose parts are a list.
HOLDERS = {"html", "body", "main", "article", "section", "div", "center", "table", "tbody", "tr", "td"}
LISTS = {"ul", "ol", "menu", "dir", "dl"}
# Elements whose text is meant to be read, be it a link or not.
READ = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "caption", "address"}

BLOCK = pa.struct([("slot", pa.int32()), ("article", pa.int32()), ("links", pa.int32()), ("text", pa.string())])
PARSED = "id long, url string, host string, tree string, body string, blocks array<struct<slot int, article int, links int, text string>>"
SLOTTED = "host string, slot string, text string, body string, size long"


def mark(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()[:24]


def parsed(pages: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """Every page as its tree and blocks, settled, so that it is parsed once."""
    ship(pages.sparkSession)
    url = F.col(url_column).cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = pages.select(F.col(id_column).cast("long").alias("id"), url.alias("url"), host.alias("host"), F.col(html_column).cast("string").alias("html"))

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            each = [parse(html or "") for html in batch.column(3).to_pylist()]
            blocks = [[b._asdict() for b in found] for _, found in each]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(3)],
                    pa.array([tree for tree, _ in each], pa.string()),
                    pa.array([mark("\n".join(b.text for b in found)) for _, found in each], pa.string()),
                    pa.array(blocks, pa.list_(BLOCK)),
                ],
                ["id", "url", "host", "tree", "body", "blocks"],
            )

    return settle(rows.mapInArrow(read, PARSED), "parsed")


@lru_cache(maxsize=5_000)
def slot_names(tree: str, reference: str) -> dict[int, str]:
    """Names of a tree's slots: the number in the reference, or the way from the last one that is in it."""
    pairs = matching(tree, reference)
    tags, children = children_of(tree)
    names, ahead = {0: "0"}, [0]
    while ahead:
        slot = ahead.pop()
        for child in children[slot]:
            names[child] = str(pairs[child]) if child in pairs else f"{names[slot]}/{tags[child]}"
            ahead.append(child)
    return names


def slotted(page: DataFrame) -> DataFrame:
    """``host, slot, text, body, size`` of all blocks; needs ``reference``.

    Blocks inside articles cannot be template, so only their size counts: it is
    summed up here, and their ``text`` is null. Blocks of links have no size.
    """

    def align(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(stream):
            out, inside = [], Counter()
            for row in batch.to_pylist():
                names = slot_names(row["tree"], row["reference"])
                for b in row["blocks"] or []:
                    size = 0 if b["links"] > LINKS * len(b["text"]) else len(b["text"])
                    if b["article"]:
                        inside[row["host"], names[b["slot"]]] += size
                    else:
                        out.append((row["host"], names[b["slot"]], mark(b["text"]), row["body"], size))
            out += [(host, slot, None, None, size) for (host, slot), size in inside.items()]
            if out:
                kinds = [*[pa.string()] * 4, pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in SLOTTED.split(", ")])

    return page.select("host", "tree", "reference", "body", "blocks").mapInArrow(align, SLOTTED)


def wrappers(blocks: DataFrame) -> DataFrame:
    """``host, template, sizes``: the constant nodes of a host, and the varying text of its slots.

    Pages count by what they say, so copies of one page do not make it a
    template. A slot has at most 1 / ``MOST`` constant texts.
    """
    shown = blocks.where("text IS NOT NULL").groupBy("host", "slot", "text", "body").agg(F.sum("size").alias("size"))
    texts = shown.groupBy("host", "slot", "text").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    slots = shown.select("host", "slot", "body").distinct().groupBy("host", "slot").agg(F.count(F.lit(1)).alias("pages"))
    constant = (F.col("n") >= FEWEST_PAGES) & (F.col("n") >= MOST * F.col("pages"))
    judged = texts.join(slots, ["host", "slot"]).select(
        "host",
        "slot",
        F.when(constant, F.concat_ws(":", "slot", "text")).alias("constant"),
        F.when(constant, 0).otherwise(F.col("size")).alias("size"),
    )
    within = blocks.where("text IS NULL").select("host", "slot", F.lit(None).cast("string").alias("constant"), "size")
    by_slot = judged.unionByName(within).groupBy("host", "slot").agg(
        F.collect_set("constant").alias("constant"), F.sum("size").alias("size")
    )
    return by_slot.groupBy("host").agg(
        F.flatten(F.collect_list("constant")).alias("template"),
        F.array_sort(F.collect_list(F.struct("slot", "size"))).alias("sizes"),
    )


def link_lists(tree: str, blocks: list[Block]) -> set[int]:
    """Numbers of the blocks that are links to other places: lists of links as a whole, and links by themselves.

    A list is a run of blocks within the same outermost list element.
    """
    tags, children = children_of(tree)
    outermost = [0] * len(tags)
    for slot in range(len(tags)):
        for child in children[slot]:
            outermost[child] = outermost[slot] or (child if tags[child] in LISTS else 0)
    out, i = set(), 0
    while i < len(blocks):
        here, j = outermost[blocks[i].slot], i + 1
        while here and j < len(blocks) and outermost[blocks[j].slot] == here:
            j += 1
        links, size = sum(b.links for b in blocks[i:j]), sum(len(b.text) for b in blocks[i:j])
        if links > LINKS * size and (here or tags[blocks[i].slot] not in READ):
            out.update(range(i, j))
        i = j
    return out


def content_slot(tree: str, held: list[int]) -> int:
    """The smallest holder with all of the text, given the text of each slot; no deeper than an article."""
    tags, children = children_of(tree)
    held = list(held)
    # Children have higher numbers than their parents.
    for slot, parent in sorted(((c, p) for p, cs in enumerate(children) for c in cs), reverse=True):
        held[parent] += held[slot]
    main = next((s for s, tag in enumerate(tags) if tag == "main" and held[s]), 0)
    while tags[main] != "article":
        inner = next(
            (c for c in children[main] if held[c] == held[main] and tags[c] in HOLDERS), None
        )
        if inner is None or not held[0]:
            break
        main = inner
    return main


@lru_cache(maxsize=5_000)
def host_slot(reference: str, sizes: tuple[tuple[str, int], ...]) -> str:
    """The content slot of a host, by name. Text of slots beyond the reference counts to the last one in it."""
    held = [0] * (len(reference.split()) + 1)
    for name, size in sizes:
        held[int(name.split("/")[0])] += size
    return str(content_slot(reference, held))


def inside(tree: str, root: int) -> set[int]:
    """A slot and all slots below it."""
    _, children = children_of(tree)
    found, ahead = set(), [root]
    while ahead:
        slot = ahead.pop()
        found.add(slot)
        ahead += children[slot]
    return found


def content(row: dict) -> str:
    """The main text of one page."""
    blocks = [Block(**b) for b in row["blocks"] or []]
    if not blocks:
        return ""
    names, template = slot_names(row["tree"], row["reference"]), set(row["template"] or [])
    listed = link_lists(row["tree"], blocks)
    varying = [
        b
        for i, b in enumerate(blocks)
        if b.article or (i not in listed and f"{names[b.slot]}:{mark(b.text)}" not in template)
    ]
    wanted = host_slot(row["reference"], tuple((s["slot"], s["size"]) for s in row["sizes"] or []))
    own = next((slot for slot, name in names.items() if name == wanted), None)
    chosen = [b for b in varying if b.slot in inside(row["tree"], own)] if own is not None else []
    marked = [b for b in varying if b.article]
    if not chosen or (marked and not any(b.article for b in chosen)):
        held = [0] * len(names)
        for b in marked or varying:
            held[b.slot] += len(b.text)
        within = inside(row["tree"], content_slot(row["tree"], held))
        chosen = [b for b in varying if b.slot in within]
    sizes, links = Counter(), Counter()
    for b in chosen:
        sizes[b.article] += len(b.text)
        links[b.article] += b.links
    articles = [a for a in sizes if a]
    if articles:
        # Articles inside elements beside the content count only if there are no others.
        first = [a for a in articles if a > 0] or articles
        told = [a for a in first if links[a] <= LINKS * sizes[a]] or [max(first, key=lambda a: (sizes[a], -abs(a)))]
        chosen = [b for b in chosen if b.article in told]
    return " ".join(b.text for b in chosen)


def main_texts(
    pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``id, url, text, n_chars`` of every page."""
    rows = parsed(pages, id_column, url_column, html_column)
    trees = rows.groupBy("host", "tree").agg(F.count(F.lit(1)).alias("n"))
    references = settle(
        trees.groupBy("host").agg(F.max_by("tree", F.struct("n", "tree")).alias("reference")), "references"
    )
    hosts = references.count()
    aligned = lookup(rows, references, ["host"], rows=hosts)
    induced = settle(wrappers(slotted(aligned)), "wrappers")
    known = lookup(aligned, induced, ["host"], rows=hosts)

    def extract(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(stream):
            texts = [content(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    chosen = known.select("id", "url", "tree", "reference", "template", "sizes", "blocks")
    return chosen.mapInArrow(extract, "id long, url string, text string, n_chars long")
