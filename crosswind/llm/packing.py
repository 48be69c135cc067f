"""Best-fit packing of token sequences, by linear grouping of the large ones.

Only the number of pieces of each length matters for the plan, and a length is
at most the capacity. So the plan is made from that histogram, the same work
for a thousand pieces as for a trillion, and the pieces then find their places
by one lookup each.

1. Lengths above ``large`` are sorted and dealt into groups of equal number;
   within a group all count as its longest.
2. The few sizes left are put together into configurations: the largest size
   still open, filled up with those that come closest to the capacity, used as
   often as the numbers allow.
3. The actual pieces take the places of their group, longest first; what
   rounding reserved beyond their length becomes free again.
4. Small pieces, longest first, go where the least room is left that holds them,
   and only then into a new sequence.

Nulls: a null text is an empty one, a piece with the end id alone. Rows that
repeat are packed each for itself. An empty table gives no piece. Other columns
are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswind.llm.common import numbered, ship, slices, small_table, text_bytes
from crosswind.llm.tokens import default_tokenizer, task_ids
from crosswind.session import settle

CAPACITY = 4096
GROUPS = 40
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


class Run(NamedTuple):
    """Pieces of one length in the order of their rank: where each of them goes.

    Piece ``rank`` of the run goes to sequence ``first + (rank - start) // each``
    at ``offset + (rank - start) % each * length``.
    """

    length: int
    start: int
    count: int
    first: int
    each: int
    offset: int


class Room(NamedTuple):
    """Neighbouring sequences that are filled alike."""

    free: int
    first: int
    count: int


def configuration(sizes: list[int], counts: list[int], capacity: int) -> list[int]:
    """How many of each size go together, the first open size among them.

    Sums that can be reached are the set bits of one number per size; walking
    them back gives the fullest choice.
    """
    top = next(i for i, n in enumerate(counts) if n)
    room = capacity - sizes[top]
    mask = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for i, size in enumerate(sizes):
        most = min(counts[i] - (i == top), room // size)
        before = reached
        for _ in range(most):
            reached |= (reached << size) & mask
        steps.append((i, size, most, before))
    total = reached.bit_length() - 1
    chosen = [0] * len(sizes)
    chosen[top] = 1
    for i, size, most, before in reversed(steps):
        used = next(k for k in range(most + 1) if total >= k * size and before >> (total - k * size) & 1)
        chosen[i] += used
        total -= used * size
    return chosen


def grouped(large: list[tuple[int, int]], groups: int) -> list[list[list[int]]]:
    """Runs ``[length, first rank, count]`` of lengths, longest first, in groups of equal number."""
    total = sum(n for _, n in large)
    share = -(-total // groups)
    dealt, room = [[]], share
    for length, n in large:
        rank = 0
        while rank < n:
            if not room:
                dealt.append([])
                room = share
            take = min(room, n - rank)
            dealt[-1].append([length, rank, take])
            rank, room = rank + take, room - take
    return [runs for runs in dealt if runs]


def take(runs: list[list[int]], count: int) -> list[tuple[int, int, int]]:
    """The next ``count`` pieces of a group, or as many as it still has."""
    taken = []
    while count and runs:
        length, rank, n = runs[0]
        used = min(n, count)
        taken.append((length, rank, used))
        runs[0] = [length, rank + used, n - used]
        count -= used
        if used == n:
            runs.pop(0)
    return taken


def place_large(
    large: list[tuple[int, int]], capacity: int, groups: int
) -> tuple[list[Run], list[Room], int]:
    """Large pieces by configurations of rounded sizes; the room their true lengths leave."""
    open_runs = grouped(large, groups) if large else []
    sizes = [runs[0][0] for runs in open_runs]
    counts = [sum(n for *_, n in runs) for runs in open_runs]
    plan, rooms, sequences = [], [], 0
    while any(counts):
        chosen = configuration(sizes, counts, capacity)
        times = min(n // k for n, k in zip(counts, chosen) if k)
        slots = [take(open_runs[i], times) for i, k in enumerate(chosen) for _ in range(k)]
        counts = [n - k * times for n, k in zip(counts, chosen)]
        edges = {0, times}
        for slot in slots:
            at = 0
            for *_, n in slot:
                at += n
                edges.add(at)
        edges = sorted(edges)
        for low, high in zip(edges, edges[1:]):
            used = 0
            for slot in slots:
                at = 0
                for length, rank, n in slot:
                    if at <= low < at + n:
                        start = rank + low - at
                        plan.append(Run(length, start, high - low, sequences + low, 1, used))
                        used += length
                        break
                    at += n
            rooms.append(Room(capacity - used, sequences + low, high - low))
        sequences += times
    return plan, rooms, sequences


def pack(
    histogram: dict[int, int], capacity: int = CAPACITY, *, groups: int = GROUPS, large: int | None = None
) -> list[Run]:
    """Places for all pieces, given how many there are of each length."""
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError("a piece must be longer than 0 and no longer than the capacity")
    bound = capacity // 8 if large is None else large
    lengths = sorted((x for x in histogram.items() if x[1]), reverse=True)
    plan, rooms, sequences = place_large([x for x in lengths if x[0] > bound], capacity, groups)
    # Full sequences play no further part; the others by room, smallest first.
    by_room = sorted(room for room in rooms if room.free)
    for length, count in (x for x in lengths if x[0] <= bound):
        rank = 0
        while rank < count:
            at = bisect_left(by_room, (length,))
            if at < len(by_room):
                free, first, n = by_room.pop(at)
            else:
                each = capacity // length
                free, first, n = capacity, sequences, -(-(count - rank) // each)
                sequences += n
            each = free // length
            full = min(n, (count - rank) // each)
            rest = min(each, count - rank - full * each) if full < n else 0
            offset = capacity - free
            for start, many, per, size in ((0, full, each, full * each), (full, int(rest > 0), rest, rest)):
                if many:
                    plan.append(Run(length, rank, size, first + start, per, offset))
                    rank += size
                    if free - per * length:
                        insort(by_room, Room(free - per * length, first + start, many))
            used = full + int(rest > 0)
            if used < n:
                insort(by_room, Room(free, first + used, n - used))
    return plan


def token_pieces(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece of a document's ids; ``row`` tells apart rows that share an id."""
    ship(docs.sparkSession)
    vocabulary = tokenizer or default_tokenizer()
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_ids(vocabulary) as words:
            for batch in slices(stream):
                out = []
                for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                    ids = words.ids(text, end_id)
                    row = zlib.crc32(text)
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out.append((doc_id, row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                    arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in PIECES.split(", ")])

    return rows.mapInArrow(cut, PIECES)


def pack_pieces(
    pieces: DataFrame, *, capacity: int = CAPACITY, groups: int = GROUPS, settled: bool = False
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; sequences are gapless and within capacity.

    ``pieces`` has ``doc_id, row, piece, length``. The histogram has at most
    ``capacity`` rows and the plan follows from it alone, so both may pass
    through the driver and be broadcast.
    """
    spark = pieces.sparkSession
    pieces = pieces if settled else settle(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length = defaultdict(list)
    for run in pack(histogram, capacity, groups=groups):
        by_length[run.length].append(run)
    rows = [run for runs in by_length.values() for run in runs]
    plan = small_table(
        spark, rows, "_length long, _from long, _count long, _first long, _each long, _offset long"
    )
    ranked = numbered(pieces, ["length"], ["doc_id", "row", "piece", "ids_crc32"])
    step = F.col("_before") - F.col("_from")
    here = (
        (F.col("length") == F.col("_length"))
        & (F.col("_before") >= F.col("_from"))
        & (F.col("_before") < F.col("_from") + F.col("_count"))
    )
    return ranked.join(F.broadcast(plan), here).select(
        *pieces.columns,
        (F.col("_first") + F.floor(step / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + step % F.col("_each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, *, capacity: int = CAPACITY, **options) -> DataFrame:
    """Every document, cut where it is longer than a sequence, with its pieces' places."""
    return pack_pieces(token_pieces(docs, capacity=capacity, **options), capacity=capacity)
