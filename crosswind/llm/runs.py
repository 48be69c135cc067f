"""Runs of repeated words: the maximal stretches in which words return after a fixed period.

Both Lyndon arrays of a text, by an order of its words and by the reverse, come
straight from the first phase of a grouping suffix sorter: groups are taken from
the largest down, and a suffix that stands right before members of a group
takes their common prefix into its own, once for each of them. When all groups
are done, the prefix that a group shares is the longest Lyndon word at its
places. Every run holds such a word of one of the two orders as long as its
period, so each is extended to both sides, as far as words a period apart
agree, and is a run if that makes two periods.

Sorting is left to those stretches of a text that can hold a run: of a run of
``least`` words or more, every word lies in half as many that occur once more in
the same text, so everything outside such stretches is left out, and nothing
that lies within.

Nulls: a null text has no words; ids may be null. Rows that repeat are each
treated by themselves. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from crosswind.llm.common import byte_slices, ship, text_bytes

# Words that a run has at least.
LEAST = 12
# Bytes of text that a worker takes at a time.
BATCH_BYTES = 4 << 20
WORD = 4
PRIME = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


class Codes(dict):
    """Numbers for words, in the order in which they are first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def lyndon_lengths(text: list[int]) -> list[int]:
    """Length of the longest Lyndon word at every place.

    A group is known by its first place in ``order``, where its members stand
    side by side, so groups compare as numbers. ``back`` holds, for places whose
    group is done, the last place before them in a smaller group.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    first = 0
    for at, i in enumerate(order):
        if text[i] != text[order[first]]:
            first = at
        place[i], group[i] = at, first
        size[first] += 1
    length, back = [1] * n, [-1] * n
    end = n
    while end:
        here = group[order[end - 1]]
        met: dict[int, int] = {}
        for i in sorted(order[here:end]):
            j = i - 1
            while j >= 0 and group[j] >= here:
                j = back[j]
            back[i] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        step = length[order[here]]
        by_times = defaultdict(list)
        for j, times in met.items():
            by_times[times].append(j)
        for times in sorted(by_times, reverse=True):
            moved = by_times[times]
            for j in moved:
                old = group[j]
                size[old] -= 1
                last, at = old + size[old], place[j]
                other = order[last]
                order[last], order[at] = j, other
                place[j], place[other] = last, at
                length[j] += times * step
            # Those of one old group become the group right behind it.
            new = [group[j] + size[group[j]] for j in moved]
            for j, start in zip(moved, new):
                group[j] = start
                size[start] += 1
        end = here
    return length


def ahead(data: bytes, i: int, j: int) -> int:
    """How many words agree from the places ``i`` and ``j`` on, ``i`` before ``j``."""
    left, same, step = len(data) // WORD - j, 0, 8
    while step <= left - same and _alike(data, i + same, j + same, step):
        same += step
        step *= 2
    while step:
        if step <= left - same and _alike(data, i + same, j + same, step):
            same += step
        step //= 2
    return same


def behind(data: bytes, i: int, j: int) -> int:
    """How many words agree up to before the places ``i`` and ``j``, ``i`` before ``j``."""
    same, step = 0, 8
    while step <= i - same and _alike(data, i - same - step, j - same - step, step):
        same += step
        step *= 2
    while step:
        if step <= i - same and _alike(data, i - same - step, j - same - step, step):
            same += step
        step //= 2
    return same


def _alike(data: bytes, i: int, j: int, words: int) -> bool:
    return data[i * WORD : (i + words) * WORD] == data[j * WORD : (j + words) * WORD]


def runs_of(words: np.ndarray, least: int = LEAST) -> list[Run]:
    """Start, length and period of all runs of a text given as numbers, of ``least`` words or more."""
    words = words.astype("<i4")
    n, data = len(words), words.tobytes()
    found: set[Run] = set()
    for ordered in (words, -words):
        periods = np.array(lyndon_lengths(ordered.tolist()), "i8")
        at = np.arange(n)
        after = words[at] == words[np.minimum(at + periods, n - 1)]
        after &= at + periods < n
        before = words[np.maximum(at - 1, 0)] == words[at + periods - 1]
        before &= at > 0
        known: dict[int, tuple[int, int]] = {}
        for i in np.flatnonzero(after | before).tolist():
            p = int(periods[i])
            start, end = known.get(p, (n, 0))
            if start <= i and i + p <= end:
                continue
            left, right = behind(data, i, i + p), ahead(data, i, i + p)
            if left + right >= p:
                known[p] = i - left, i + p + right
                found.add((i - left, left + p + right, p))
    return sorted((r for r in found if r[1] >= least), key=lambda r: (r[0], r[2]))


def repeating_stretches(words: np.ndarray, starts: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Stretches, each within one text, that hold all runs of ``least`` words or more.

    ``words`` are those of several texts, which start at ``starts``. Hashes may
    agree by chance; that makes a stretch longer, never shorter.
    """
    width = -(-least // 2)
    n = len(words)
    if n < least:
        return
    text_of = np.zeros(n, "i8")
    np.add.at(text_of, starts[(starts > 0) & (starts < n)], 1)
    text_of = text_of.cumsum()
    grams = n - width + 1
    hashes = text_of[:grams].astype("u8")
    for k in range(width):
        hashes = (hashes ^ words[k : k + grams].astype("u8")) * PRIME
        hashes ^= hashes >> np.uint64(29)
    inside = np.flatnonzero(text_of[:grams] == text_of[width - 1 :])
    _, which, times = np.unique(hashes[inside], return_inverse=True, return_counts=True)
    again = inside[times[which] > 1]
    edges = np.zeros(n + 1, "i8")
    np.add.at(edges, again, 1)
    np.add.at(edges, again + width, -1)
    covered = edges.cumsum()[:-1] > 0
    breaks = np.zeros(n + 1, bool)
    breaks[starts[starts < n]] = True
    breaks[[0, n]] = True
    breaks[1:n] |= covered[1:] != covered[:-1]
    cuts = np.flatnonzero(breaks)
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if covered[start] and end - start >= least:
            yield start, end


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words) + 1, "i8")
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return [word for word, held in zip(words, dropped.cumsum().tolist()) if not held]


def runs_of_texts(texts: list[bytes], least: int) -> tuple[list[list[bytes]], list[list[Run]]]:
    """Words and runs of each of several texts."""
    codes = Codes()
    worded = [text.split() for text in texts]
    numbers = [codes[word] for words in worded for word in words]
    words = np.array(numbers, "i4")
    starts = np.array([0, *map(len, worded)], "i8").cumsum()
    runs: list[list[Run]] = [[] for _ in texts]
    for start, end in repeating_stretches(words, starts[:-1], least):
        text = int(np.searchsorted(starts, start, "right")) - 1
        for at, length, period in runs_of(words[start:end], least):
            runs[text].append((start - int(starts[text]) + at, length, period))
    return worded, runs


def periodic_runs(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST
) -> DataFrame:
    """``id``, ``n_words``, all ``runs`` of a text by start and period, and ``text`` without repeats.

    A run is a stretch of ``least`` words or more and two periods or more, which
    no neighbouring word extends; of each only the first period stays in ``text``.
    """
    ship(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    parts = ("start", "length", "period")
    run = StructType([StructField(part, LongType()) for part in parts])
    schema = StructType(
        [
            chosen.schema["id"],
            StructField("n_words", LongType()),
            StructField("runs", ArrayType(run)),
            StructField("text", StringType()),
        ]
    )

    def find(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(stream, BATCH_BYTES):
            worded, runs = runs_of_texts(text_bytes(batch.column(1)), least)
            flat = np.array([run for held in runs for run in held], "i8").reshape(-1, len(parts))
            ends = np.array([0, *map(len, runs)], "i4").cumsum()
            items = pa.StructArray.from_arrays([pa.array(c) for c in flat.T.copy()], list(parts))
            texts = [b" ".join(kept_words(words, held)) for words, held in zip(worded, runs)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(words) for words in worded], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "runs", "text"],
            )

    return chosen.mapInArrow(find, schema)
