"""Phrases whose words stand together more often than their parts would make them.

Words are counted first. They are the leading words by which suffixes are then
routed: a suffix is the place of a word with up to three words after it, cut
before a word that is too rare to be in any phrase wanted. A suffix goes to the
task of its leading word; where that word leads more suffixes than a task
should get, to that of its two leading words; where the pair still leads too
many, to that of all its words. Equal suffixes of a batch travel as one with their
count, so whatever key is hot, no task gets more than its share.

There, three-way quicksort by words splits the suffixes, at depth after depth, into
those before, at and behind a pivot. The sizes of the equal parts are the
counts of phrases. Parts too small for a phrase wanted are left at once. Where a key
was cut deeper than a phrase is long, the counts of its pieces are added up.

Which words are rare, which words and pairs are hot is told to tasks as bits of
fixed number, set by a hash. Two words that share a bit let more through or cut
a key deeper than needed; counts do not change.

Nulls: a null text is empty; a null language is the language ``und``. Repeated
rows count each time. An empty table gives no phrase. Columns other than
language and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswind.llm.common import byte_slices, ship, text_bytes
from crosswind.llm.runs import Codes
from crosswind.operators.joins import BROADCAST_BYTES, lookup_join
from crosswind.session import settle

LONGEST = 4
LEAST = 30
SHARE_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
# Parts in which the phrases of a language are ranked before they are ranked as a whole.
SHARES = 16
UNKNOWN = "und"
# Suffixes that a task's key should lead at most, and that a route has on average.
ROUTE = 1 << 17
# Bits that tell rare and hot words, and counters that tell hot pairs.
WORD_BITS = 1 << 24
PAIRS = 1 << 16
BATCH_BYTES = 4 << 20

# Ends a piece of text; the byte is in no UTF-8 text.
END = b"\xff"
# Capital letters of ASCII to small ones, tabs to blanks, marks and line ends to ends of pieces.
LETTERS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b".,;:!?\n\x0b\x0c\r"
PREPARED = bytes.maketrans(LETTERS + b"\t" + MARKS, LETTERS.lower() + b" " + b"\n" * len(MARKS))

COUNTED = "lang string, word string, pair int, n long"
ROUTED = "lang string, route int, whole int, suffixes binary, counts binary"
FOUND = "lang string, phrase string, words int, n long"


def coded(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Different words and the number of each word in turn; 0 stands at the end of a piece."""
    codes = Codes({END: 0})
    marked = b"\n".join(texts).translate(PREPARED).replace(b"\n", b" \xff ")
    numbers = np.array([0, *[codes[word] for word in marked.split()], *[0] * LONGEST], "i4")
    return list(codes), numbers


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of a batch, those of a language together."""
    languages = batch.column(0).to_pylist()
    texts: dict[str, list[bytes]] = {}
    for language, text in zip(languages, text_bytes(batch.column(1))):
        texts.setdefault(language, []).append(text)
    yield from texts.items()


def word_hashes(language: str, words: list[bytes]) -> np.ndarray:
    start = zlib.crc32(language.encode() + b"\0")
    return np.array([zlib.crc32(word, start) for word in words], "u8")


def hash_of_word(language: Column, word: Column) -> Column:
    """The same hash in Spark."""
    return F.crc32(F.concat(language, F.lit("\0"), word).cast("binary"))


def mixed(*hashes: np.ndarray) -> np.ndarray:
    """One hash for several words in their order."""
    total = np.zeros(len(hashes[0]), "u8")
    for part in hashes:
        total = (total ^ part) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
    return total


def pair_numbers(hashes: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (mixed(hashes[first], hashes[second]) % np.uint64(PAIRS)).astype("i8")


def count_words(texts: DataFrame) -> DataFrame:
    """Occurrences of every word of a language, and of all pairs of words that share a counter."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(PAIRS, "i8")
        for batch in byte_slices(stream, BATCH_BYTES):
            for language, held in by_language(batch):
                words, codes = coded(held)
                hashes = word_hashes(language, words)
                both = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
                pairs += np.bincount(pair_numbers(hashes, codes[both], codes[both + 1]), minlength=PAIRS)
                counts = np.bincount(codes, minlength=len(words))[1:]
                yield counted(pa.array([language] * len(counts), pa.string()), as_text(words[1:]), None, counts)
        used = np.flatnonzero(pairs)
        yield counted(None, None, used, pairs[used])

    def counted(language, words, pair, counts: np.ndarray) -> pa.RecordBatch:
        empty = pa.nulls(len(counts), pa.string())
        numbers = pa.nulls(len(counts), pa.int32()) if pair is None else pa.array(pair, pa.int32())
        columns = [empty if language is None else language, empty if words is None else words, numbers]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], ["lang", "word", "pair", "n"])

    return texts.mapInArrow(count, COUNTED).groupBy("lang", "word", "pair").agg(F.sum("n").alias("n"))


def as_text(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).view(pa.string())


def word_bits(words: DataFrame, condition: Column) -> np.ndarray:
    """Bits of the words that meet a condition, of a size that does not depend on the words."""
    slot = (hash_of_word(F.col("lang"), F.col("word")) % WORD_BITS).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot % 64)
    chosen = words.where(condition).select(F.shiftright(slot, 6).alias("at"), bit.alias("bit"))
    held = chosen.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(WORD_BITS // 64, "i8")
    bits[held["at"].to_numpy()] = held["bits"].to_numpy()
    return bits


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = (hashes % np.uint64(WORD_BITS)).astype("i8")
    return (bits[slots >> 6] >> (slots & 63)) & 1 > 0


@dataclass
class Routes:
    """What tasks must know to route a suffix; all of it of fixed size, but one number a language."""

    frequent: np.ndarray
    hot_words: np.ndarray
    hot_pairs: np.ndarray
    count: int

    def of(self, hashes: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Route of each suffix, and from how many words on all that are equal meet there."""
        led = [hashes[column] for column in columns]
        hot = has_bit(self.hot_words, hashes)[columns[0]]
        hot_pair = hot & self.hot_pairs[pair_numbers(hashes, columns[0], columns[1])]
        whole = np.where(hot_pair, LONGEST, np.where(hot, 2, 1))
        key = np.where(hot_pair, mixed(*led), np.where(hot, mixed(*led[:2]), mixed(led[0])))
        return (key % np.uint64(self.count)).astype("i8"), whole


def suffixes(codes: np.ndarray) -> list[np.ndarray]:
    """Up to four words from every place on, at least two; 0 where a suffix has ended, as the codes say."""
    good = codes > 0
    runs, n = [good], len(codes)
    for k in range(1, LONGEST):
        runs.append(runs[-1] & np.append(good[k:], np.zeros(min(k, n), bool))[:n])
    at = np.flatnonzero(runs[1])
    return [np.where(runs[k][at], codes[np.minimum(at + k, n - 1)], 0) for k in range(LONGEST)]


def together(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Different suffixes and how often each occurs."""
    bound = int(max(column.max(initial=0) for column in columns)) + 1
    if bound < 1 << 16:
        key = sum(column.astype("i8") << (16 * k) for k, column in enumerate(columns))
    else:
        halves = [a.astype("i8") * bound + b for a, b in zip(columns[::2], columns[1::2])]
        first, second = (np.unique(half, return_inverse=True)[1] for half in halves)
        key = first * (int(second.max(initial=0)) + 1) + second
    _, at, counts = np.unique(key, return_index=True, return_counts=True)
    return [column[at] for column in columns], counts


def route_suffixes(texts: DataFrame, routes: dict[str, int], frequent, hot_words, hot_pairs) -> DataFrame:
    """Suffixes of all texts, those of a batch and route in one row: words by blanks, each in a line."""
    shared = texts.sparkSession.sparkContext.broadcast((routes, frequent, hot_words, hot_pairs))

    def route(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes, *bits = shared.value
        for batch in byte_slices(stream, BATCH_BYTES):
            for language, held in by_language(batch):
                rows = routed(language, held, Routes(*bits, routes.get(language, 1)))
                if rows is not None:
                    yield rows

    return texts.mapInArrow(route, ROUTED)


def routed(language: str, texts: list[bytes], routes: Routes) -> pa.RecordBatch | None:
    words, codes = coded(texts)
    hashes = word_hashes(language, words)
    frequent = has_bit(routes.frequent, hashes)
    frequent[0] = False
    # Frequent words are numbered anew from 1, so that the numbers are small.
    numbers = np.where(frequent, frequent.cumsum(), 0)
    kept = np.flatnonzero(numbers)
    words = [b"", *[words[i] for i in kept]]
    hashes = np.append(np.zeros(1, "u8"), hashes[kept])
    codes = numbers[codes]
    columns, counts = together(suffixes(codes))
    if not len(counts):
        return None
    route, whole = routes.of(hashes, columns)
    key = route * (LONGEST + 1) + whole
    order = np.argsort(key, kind="stable")
    key, counts = key[order], counts[order].astype("<i4")
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    lines = as_lines(words, [column[order] for column in columns])
    bounds = np.append(starts, len(key))
    places = np.frombuffer(lines.buffers()[1], "i4")[lines.offset :][bounds]
    keys = key[starts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([language] * len(starts), pa.string()),
            pa.array(keys // (LONGEST + 1), pa.int32()),
            pa.array(keys % (LONGEST + 1), pa.int32()),
            pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places.copy()), lines.buffers()[2]]),
            pa.Array.from_buffers(
                pa.binary(), len(starts), [None, pa.py_buffer((4 * bounds).astype("i4")), pa.py_buffer(counts)]
            ),
        ],
        ["lang", "route", "whole", "suffixes", "counts"],
    )


def as_lines(words: list[bytes], columns: list[np.ndarray]) -> pa.Array:
    """Every suffix as its words with blanks between and a line feed behind."""
    known = pa.array(words, pa.binary())
    parts = [known.take(pa.array(column, mask=column == 0)) for column in columns]
    joined = pc.binary_join_element_wise(*parts, b" ", null_handling="skip")
    return pc.binary_join_element_wise(joined, b"", b"\n")


def phrases_by_sorting(
    columns: list[np.ndarray], counts: np.ndarray, whole: int, least: int
) -> Iterator[tuple[int, list[int], int]]:
    """Length, words and count of phrases of two words or more, by three-way quicksort to full depth.

    A part is left where all its suffixes are too few, unless more of a phrase
    are elsewhere, as there may be of phrases shorter than ``whole`` words.
    """
    stack = [(np.arange(len(counts)), 0)]
    while stack:
        part, depth = stack.pop()
        while len(part):
            needed = least if depth + 1 >= whole else 1
            if counts[part].sum() < needed:
                break
            words = columns[depth][part]
            pivot = sorted((words[0], words[len(words) // 2], words[-1]))[1]
            equal = part[words == pivot]
            if pivot:
                total = int(counts[equal].sum())
                if total >= needed:
                    if depth:
                        yield depth + 1, [int(column[equal[0]]) for column in columns[: depth + 1]], total
                    if depth + 1 < LONGEST:
                        stack.append((equal, depth + 1))
            stack.append((part[words < pivot], depth))
            part = part[words > pivot]


def sorted_route(least: int):
    """Counts of the phrases of one route, from its rows."""

    def count(rows: pa.Table) -> pa.Table:
        found = []
        whole = rows["whole"][0].as_py()
        language = rows["lang"][0].as_py()
        codes = Codes({END: 0})
        text = b"".join(rows["suffixes"].to_pylist()).replace(b"\n", b" \xff ")
        numbers = np.array([codes[word] for word in text.split()], "i4")
        ends = np.flatnonzero(numbers == 0)
        starts = np.append(0, ends[:-1] + 1)
        columns = [np.where(starts + k < ends, numbers[np.minimum(starts + k, ends)], 0) for k in range(LONGEST)]
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), "<i4").astype("i8")
        words = list(codes)
        for length, phrase, n in phrases_by_sorting(columns, counts, whole, least):
            found.append((language, b" ".join(words[i] for i in phrase), length, n))
        names, phrases, lengths, totals = zip(*found) if found else [[]] * 4
        return pa.table(
            {
                "lang": pa.array(names, pa.string()),
                "phrase": pa.array(phrases, pa.binary()).view(pa.string()),
                "words": pa.array(lengths, pa.int32()),
                "n": pa.array(totals, pa.int64()),
            }
        )

    return count


def phrase_counts(
    docs: DataFrame,
    *,
    lang_column: str = "lang",
    text_column: str = "text",
    least: int = LEAST,
    route: int = ROUTE,
) -> tuple[DataFrame, DataFrame]:
    """Words ``(lang, word, n)``, all of them, and phrases ``(lang, phrase, words, n)`` found ``least`` times."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text_column).cast("string").alias("text"),
    )
    counted = settle(count_words(texts), "words")
    words = counted.where("word IS NOT NULL").select("lang", "word", "n")
    totals = {row["lang"]: row["n"] for row in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    hot_pairs = np.zeros(PAIRS, bool)
    hot_pairs[[row["pair"] for row in counted.where((F.col("pair") >= 0) & (F.col("n") > route)).collect()]] = True
    bits = word_bits(words, F.col("n") >= least), word_bits(words, F.col("n") > route)
    routes = {language: -(-n // route) for language, n in totals.items()}
    parts = route_suffixes(texts, routes, *bits, hot_pairs)
    found = parts.groupBy("lang", "route", "whole").applyInArrow(sorted_route(least), FOUND)
    added = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return words, settle(added, "phrases")


def collocations(
    docs: DataFrame,
    *,
    lang_column: str = "lang",
    text_column: str = "text",
    least: int = LEAST,
    share_percent: int = SHARE_PERCENT,
    top: int = TOP,
    route: int = ROUTE,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is scored by the cut that tells most against it, ``a`` being its
    count, ``l`` and ``r`` those of its parts. Phrases inside a longer one that
    makes up ``share_percent`` of their occurrences are left out.
    """
    words, phrases = phrase_counts(
        docs, lang_column=lang_column, text_column=text_column, least=least, route=route
    )
    kept = lookup_join(phrases, covered(phrases), {"lang": "lang", "phrase": "part"}, limit=limit)
    big = F.col("n").cast("decimal(38,0)")
    hidden = F.col("longest").cast("decimal(38,0)") * 100 >= big * share_percent
    candidates = kept.where(~F.coalesce(hidden, F.lit(False))).drop("longest")
    scored = lowest_cut(candidates, words.where(F.col("n") >= least), phrases, limit)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First by shares of a language, so that the last ranking meets a bounded number of rows.
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    near = F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = scored.withColumn("near", near).where(F.col("near") <= top).withColumn("rank", rank).where(F.col("rank") <= top)
    totals = words.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("n"))
    placed = lookup_join(ranked, totals, {"lang": "_lang"}, limit=limit)
    return placed.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def covered(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more inside longer ones, with the count of the most frequent of these."""
    split = F.split("phrase", " ")
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    parts = phrases.where("words > 2").select(
        "lang", "n", "words", split.alias("word"), F.explode(lengths).alias("length")
    )
    starts = F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1))
    placed = parts.select("lang", "n", "word", "length", starts.alias("start"))
    part = F.array_join(F.slice("word", F.col("start"), F.col("length")), " ")
    return placed.groupBy("lang", part.alias("part")).agg(F.max("n").alias("longest"))


def lowest_cut(candidates: DataFrame, words: DataFrame, phrases: DataFrame, limit: int) -> DataFrame:
    """Candidates ``(lang, phrase, a)`` with ``l``, ``r`` and ``score`` of the cut with the lowest score."""
    known = phrases.where(F.col("words") < LONGEST).select("lang", "phrase", "n")
    known = known.unionByName(words.select("lang", F.col("word").alias("phrase"), "n"))
    split = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), "words", split.alias("word"), cut)
    parts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("word", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("word", F.col("cut") + 1, F.col("words")), " ").alias("rest"),
    )
    for side, name in (("first", "l"), ("rest", "r")):
        counts = known.select("lang", F.col("phrase").alias("part"), F.col("n").alias(name))
        parts = lookup_join(parts, counts, {"lang": "lang", side: "part"}, "inner", limit=limit).drop(side)
    wide = "CAST({} AS DECIMAL(38, 0))".format
    score = F.expr(f"({wide('a')} * {SCALE}) div ({wide('l')} + {wide('r')})")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return parts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
