"""Quality rules whose thresholds follow from the data, by language and source.

Each text is measured once: its words, the characters in them, its symbols, its
lines that repeat an earlier one, its words in passages that repeat. Two fixed
rules hold everywhere (``base_failed``). The other rules have no fixed cutoff:
quantile sketches of each measure are built per language and source and merged
per language and over all. The quantiles of a group are drawn towards those of
its language, the more the fewer texts it has, and those of a language towards
those of all, so no number of texts switches from one judge to another. Only the
length of words, which is a language's own, is never judged by other languages.
A text is rejected when it lies far outside of what its group shows, and for
symbols and repeated lines of what the lower part of it shows, so that a source
full of junk does not set its own limit.

Nulls: a null text has no words, so it fails the fixed rules; null languages and
sources are groups like others. Rows that repeat are judged alike. A text
without words takes no part in the sketches. An empty table gives an empty one.
Other columns are passed on untouched, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from crosswind.llm.common import lookup, ship, text_bytes
from crosswind.session import settle

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
FEWEST_WORDS = 10
MOST_REPEATED = 20

# Points of a sketch that hold its size and error, whatever the group's size.
SKETCH_SIZE = 800
# Texts for which the wider sketch stands: with as many of its own, a group's quantiles weigh half.
BORROWED_TEXTS = 300

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
MEASURES = StructType([StructField(name, LongType()) for name in COUNTS])

# The least spread that a group is granted in each rate.
SPREADS = {"symbol_rate": 0.01, "dup_line_rate": 0.05, "word_length": 0.5}
# Its least share of the median, where that is more: words of scripts without blanks are as long as their phrases.
RELATIVE_SPREADS = {"word_length": 0.1}
# Rates that differ between languages for no fault of the text.
OF_LANGUAGE = ["word_length"]
# How many spreads above the median, or below it, a text may lie.
REACH = 8.0
# Rates that junk only raises. Their limit is also held against the lower part of
# the texts, which junk reaches only beyond three quarters of a group: so many
# times the way from the tenth to the lower quartile, which is about REACH for a
# bell-shaped rate, above the lower quartile.
RAISED, LOWER_REACH = ["symbol_rate", "dup_line_rate"], 10.0


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = hashes[:n].copy()
    for i in range(1, width):
        windows *= np.uint64(0x9E3779B97F4A7C15)
        windows += hashes[i : i + n]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # Equal hashes only propose windows; their words decide.
    at = np.flatnonzero(np.isin(windows, twice)).tolist()
    found = Counter(tuple(words[i : i + width]) for i in at)
    edges = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if found[tuple(words[i : i + width])] > 1:
            edges[i] += 1
            edges[i + width] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def measure(text: bytes) -> tuple[int, ...]:
    """The counts of one text. Blanks, tabs and line breaks of ASCII part words."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    inside = b"".join(words)
    return (
        len(words),
        len(inside.decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@F.arrow_udf(MEASURES)
def measures(text: pa.Array) -> pa.Array:
    rows = [measure(value) for value in text_bytes(text)]
    columns = list(zip(*rows)) or [[]] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=COUNTS)


# A filter on the counts would be moved below them with a call of its own: each text
# measured twice in a row, by two workers for a task.
measures = measures.asNondeterministic()


def measured(docs: DataFrame) -> DataFrame:
    """``_doc`` with the document's own columns, ``lang``, ``source``, ``_m`` with the counts."""
    ship(docs.sparkSession)
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        measures(F.col("text").cast("string")).alias("_m"),
    )


def rates() -> dict[str, Column]:
    """What is judged: null for a text without words."""
    count = {name: F.col(f"_m.{name}") for name in COUNTS}
    return {
        "symbol_rate": F.try_divide(count["n_symbols"], count["word_chars"]),
        "dup_line_rate": F.try_divide(count["n_dup_lines"], count["n_lines"]),
        "word_length": F.try_divide(count["word_chars"], count["n_words"]),
    }


def base_failed() -> Column:
    words, repeated = F.col("_m.n_words"), F.col("_m.n_repeat_words")
    return (words < FEWEST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def quantiles(name: str, q: float) -> tuple[Column, Column]:
    """A quantile of the language and of the group, each drawn towards the next wider sketch by its count."""

    def drawn(own: str, n: str, wider: Column) -> Column:
        count = F.coalesce(F.col(n), F.lit(0))
        value = F.kll_sketch_get_quantile_double(F.when(count > 0, F.col(own)), F.lit(q))
        mixed = (value * count + wider * BORROWED_TEXTS) / (count + BORROWED_TEXTS)
        return F.coalesce(mixed, value, wider)

    everywhere = F.lit(None).cast("double")
    if name not in OF_LANGUAGE:
        everywhere = F.kll_sketch_get_quantile_double(F.when(F.col("_all_n") > 0, F.col(f"_all_{name}")), F.lit(q))
    lang = drawn(f"_lang_{name}", "_lang_n", everywhere)
    return lang, drawn(name, "n", lang)


def thresholds(texts: DataFrame) -> DataFrame:
    """Of ``measured`` texts, limits ``(lang, source, n, <rate>_low, <rate>_high)`` of every group.

    Sketches are made where the rows are and merged, so a source that holds a
    third of all rows costs no more than its tasks. Limits are rounded, so that
    a sketch's own chance does not move them.
    """
    judged = rates()
    keys = texts.select("lang", "source", *[rate.alias(name) for name, rate in judged.items()])
    sketches = settle(
        keys.groupBy("lang", "source").agg(
            F.count("word_length").alias("n"),
            *[F.kll_sketch_agg_double(name, SKETCH_SIZE).alias(name) for name in judged],
        ),
        "sketches",
    )
    merged = [F.kll_merge_agg_double(name, SKETCH_SIZE).alias(name) for name in judged]
    count = F.sum("n").alias("n")
    whole = sketches.where("n > 0")
    by_lang = whole.groupBy("lang").agg(count, *merged)
    overall = whole.groupBy().agg(count, *merged)
    wide = {name: f"_lang_{name}" for name in ["n", *judged]}
    widest = {name: f"_all_{name}" for name in ["n", *judged]}
    groups = sketches.count()
    joined = lookup(sketches, by_lang.withColumnsRenamed(wide), ["lang"], rows=groups)
    joined = joined.join(F.broadcast(overall.withColumnsRenamed(widest)), how="left")
    limits = []
    for name in judged:
        of_lang, of_group = (lambda q, name=name: quantiles(name, q)[0]), (lambda q, name=name: quantiles(name, q)[1])
        low, middle, high = map(of_group, (0.25, 0.5, 0.75))
        spread = F.greatest(F.lit(SPREADS[name]), middle * RELATIVE_SPREADS.get(name, 0.0))
        above = middle + REACH * F.greatest(high - middle, spread)
        if name in RAISED:
            # The group's lower part or its language's, whichever allows more.
            lower = []
            for each in (of_group, of_lang):
                tenth, quarter = each(0.1), each(0.25)
                lower.append(quarter + LOWER_REACH * F.greatest(quarter - tenth, spread))
            above = F.least(above, F.greatest(*lower))
        below = middle - REACH * F.greatest(middle - low, spread)
        limits += [F.round(above, 3).alias(f"{name}_high"), F.round(below, 3).alias(f"{name}_low")]
    return joined.select("lang", "source", "n", *limits)


def judged(docs: DataFrame) -> DataFrame:
    """``_doc``, ``_m``, ``_base_failed`` and ``_kept`` of every document.

    Texts are measured twice, once for the limits and once for the verdict;
    carrying the measures over would mean writing all texts or joining them.
    """
    texts = measured(docs)
    limits = settle(thresholds(texts), "thresholds")
    joined = lookup(texts, limits.drop("n"), ["lang", "source"], rows=limits.count())
    inside = F.lit(True)
    for name, rate in rates().items():
        within = rate.between(F.col(f"{name}_low"), F.col(f"{name}_high"))
        inside = inside & F.coalesce(within, F.lit(False))
    return joined.select(
        "_doc",
        "_m",
        base_failed().alias("_base_failed"),
        (~base_failed() & inside).alias("_kept"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judged(docs).where("_kept").select("_doc.*")
