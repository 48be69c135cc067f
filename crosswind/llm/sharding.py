"""Shards of nearly equal size from atomic groups, by minimax contiguous partition.

Groups are rows of equal text. They stand in the order of a digest of that text
and are cut into runs; the largest run is made as small as it can be: the
smallest capacity that a greedy walk can keep to is found by halving, and the
walk's cuts are the shards. A group that alone outweighs a fair shard cannot be
cut, so it gets a shard of its own and the others share what is left.

The walk needs prefix sums of all groups, which no one machine can hold. It is
done on cells, the groups whose digests begin alike: a cell taken as divisible
gives a lower bound of the capacity, taken as one block an upper bound. Only
cells that a cut may fall into between both are opened, by one more digit, until
none of them holds two groups. The cells at any time are bounded by the number
of shards and digits, not by the data.

Nulls: a null text counts 0 bytes and all null texts are one group, apart from
the empty ones; null ids sort first. Rows that repeat stay together. Fewer
groups than shards leave shards empty, an empty table all of them.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswind.llm.common import numbered
from crosswind.session import settle

# Hexadecimal digits that name the first cells.
DIGITS = 4
KEY = "_key"


class Cell(NamedTuple):
    """Groups whose key begins with ``prefix``."""

    prefix: str
    size: int
    groups: int
    largest: int


def greedy(cells: list[Cell], sums: list[int], capacity: int, *, divisible: bool) -> list[int]:
    """Places in bytes where shards end if each takes all it can.

    An indivisible cell that alone exceeds the capacity ends the walk where it
    stands, so the total is then not among the places.
    """
    places, at = [], 0
    while at < sums[-1]:
        reach = at + capacity
        if reach >= sums[-1]:
            places.append(sums[-1])
            break
        cell = bisect_right(sums, reach) - 1
        fluid = divisible and cells[cell].groups > 1
        place = reach if fluid else sums[cell]
        if place <= at:
            break
        places.append(place)
        at = place
    return places


def smallest_capacity(
    cells: list[Cell], sums: list[int], shards: int, least: int, *, divisible: bool
) -> int:
    """The least capacity with which the walk ends within ``shards``."""
    low, high = least, max(least, sums[-1])
    while low < high:
        middle = (low + high) // 2
        places = greedy(cells, sums, middle, divisible=divisible)
        if places and places[-1] == sums[-1] and len(places) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def even_cuts(cells: list[Cell], sums: list[int], capacity: int, shards: int) -> list[int]:
    """Cells at which shards begin, none above the capacity.

    The greedy walk alone would fill the first shards to the brim and starve the
    last. So a shard ends nearest to its share of what is left, unless the rest
    would then not fit; the walk's own place always leaves a rest that fits.
    """
    cuts, at = [], 0
    for left in range(shards, 1, -1):
        done = sums[at]
        furthest = bisect_right(sums, done + capacity) - 1
        share = done + (sums[-1] - done) / left
        above = min(bisect_right(sums, share), furthest)
        near = above - 1 if above - 1 > at and share - sums[above - 1] < sums[above] - share else above
        rest = [x - sums[near] for x in sums[near:]]
        walk = greedy(cells[near:], rest, capacity, divisible=False) if rest[-1] else [0]
        at = near if walk and walk[-1] == rest[-1] and len(walk) < left else furthest
        if at >= len(cells):
            break
        cuts.append(at)
    return cuts


def contested(cells: list[Cell], sums: list[int], shards: int) -> set[str]:
    """Cells of several groups that a cut may fall into; none when the cuts are final."""
    largest = max(c.largest for c in cells)
    low = smallest_capacity(cells, sums, shards, largest, divisible=True)
    high = smallest_capacity(cells, sums, shards, largest, divisible=False)
    first = greedy(cells, sums, low, divisible=False)
    last = greedy(cells, sums, high, divisible=True)
    reopened = {c.prefix for c in cells if c.groups > 1 and c.size > low // shards}
    for shard in range(shards - 1):
        start = first[shard] if shard < len(first) else (first[-1] if first else 0)
        stop = last[shard] if shard < len(last) else sums[-1]
        # A walk that loses a whole cell at each cut bounds the place from below.
        between = range(bisect_right(sums, start) - 1, min(bisect_right(sums, stop), len(cells)))
        reopened |= {cells[i].prefix for i in between if cells[i].groups > 1}
    return reopened


def cells_of(groups: DataFrame, digits: int) -> list[Cell]:
    rows = (
        groups.groupBy(F.substring(KEY, 1, digits).alias("prefix"))
        .agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("groups"), F.max("_size").alias("largest"))
        .collect()
    )
    return [Cell(*row) for row in rows]


def cut_points(groups: DataFrame, shards: int) -> tuple[list[str], list[str]]:
    """Keys of the groups with shards of their own, and the keys at which the other shards begin.

    ``groups`` has ``_key`` and ``_size``, one row a group.
    """
    total, alone = groups.agg(F.sum("_size")).first()[0] or 0, []
    # A group above the fair share: fewer than there are shards, at every turn.
    while shards - len(alone) > 1:
        rest = groups.where(~F.col(KEY).isin(alone)) if alone else groups
        heavy = rest.where(F.col("_size") * (shards - len(alone)) > total)
        found = heavy.orderBy(F.desc("_size"), KEY).limit(shards - len(alone) - 1).collect()
        if not found:
            break
        alone += [row[KEY] for row in found]
        total -= sum(row["_size"] for row in found)
    rest = groups.where(~F.col(KEY).isin(alone)) if alone else groups
    left = shards - len(alone)
    cells = sorted(cells_of(rest, DIGITS))
    if not cells:
        return alone, []
    digits = DIGITS
    while True:
        sums = [0, *accumulate(c.size for c in cells)]
        reopened = contested(cells, sums, left)
        if not reopened:
            break
        # Those cells are as few as the cuts allow, so their names fit into a lookup.
        names = rest.sparkSession.createDataFrame([(p,) for p in reopened], "_prefix string")
        begins = [F.substring(KEY, 1, n) == F.col("_prefix") for n in {len(p) for p in reopened}]
        inside = [rest.join(F.broadcast(names), begin, "left_semi") for begin in begins]
        digits += 1
        opened = reduce(DataFrame.unionAll, inside)
        cells = sorted([c for c in cells if c.prefix not in reopened] + cells_of(opened, digits))
    capacity = smallest_capacity(cells, sums, left, max(c.largest for c in cells), divisible=False)
    places = even_cuts(cells, sums, capacity, left)
    return alone, [cells[i].prefix for i in places]


def shard_of(alone: list[str], starts: list[str]) -> Column:
    """Shard of a key: those of single groups come first."""
    run = F.lit(len(alone))
    for start in starts:
        run = run + (F.col(KEY) >= start).cast("int")
    for number, key in enumerate(alone):
        run = F.when(F.col(KEY) == key, number).otherwise(run)
    return run.cast("int")


def shard_documents(
    docs: DataFrame, shards: int = 40, *, id_column: str = "doc_id", text_column: str = "text", overhead: int = 16
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document; slots are gapless within a shard."""
    text = F.col(text_column).cast("string")
    digest = F.coalesce(F.substring(F.sha2(text, 256), 1, 32), F.lit("null"))
    rows = settle(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            digest.alias(KEY),
        ),
        "sized",
    )
    groups = settle(rows.groupBy(KEY).agg(F.sum("size").alias("_size")), "groups")
    placed = rows.withColumn("shard", shard_of(*cut_points(groups, shards)))
    ranked = numbered(placed, ["shard"], [KEY, "doc_id"])
    return ranked.select("doc_id", "size", "text_crc32", "shard", F.col("_before").cast("long").alias("slot"))
