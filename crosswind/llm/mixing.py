"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected in the mix as often as the source's
target stands to its size. These expected copies are summed up in order, one
random offset is added, and a document is emitted once for every whole number
that the sum crosses at it. In order of length, so that long and short ones
are met evenly, the words taken stay within about one document of the target.

Sums are kept in whole 2^20ths of a copy, so they are exact, reruns agree, and
no document is taken more than ``most`` times.

Nulls: a null text has size 0; null is a source like others, after them all;
null ids are kept. Rows that repeat are documents each for themselves. A source
without words gets the target 0. An empty table gives an empty mix.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from crosswind.llm.common import lookup, numbered, row_key, ship, text_bytes
from crosswind.session import settle

WEIGHTS = (1, 2, 3)
MOST = 3
UNIT = 1 << 20
# Sizes that differ by less than a sixteenth of an octave share a band.
BANDS = 16


@F.arrow_udf(LongType())
def word_count(text: pa.Array) -> pa.Array:
    """Words between blanks, tabs and line breaks of ASCII."""
    return pa.array([len(value.split()) for value in text_bytes(text)], pa.int64())


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` of each source, from ``source, source_size``.

    The total is shared by weight. A source's target ends at ``most`` times its
    size; what lies above goes to the others by weight, until none is above.
    Sources are as many as their names: one row each, ranked in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    ranked = settle(
        sources.select(
            "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn).alias("_weight")
        ),
        "sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * most
    # The level only rises and only caps more sources, so this ends. All sums are whole numbers.
    level, capped = 0.0, None
    while True:
        above = F.col("_weight") * level > cap
        held = ranked.agg(
            F.sum(F.when(above, cap).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("_weight"))),
            F.count_if(above),
        ).first()
        if held[2] == capped or not held[1]:
            break
        capped, level = held[2], (total - held[0]) / held[1]
    target = F.least(F.col("_weight") * level, cap.cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def measured(docs: DataFrame, *, size: Column | None = None) -> DataFrame:
    """``doc_id, source, size, row`` of each document; ``row`` is a digest of all three and the text."""
    ship(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        (word_count(text) if size is None else size).alias("size"),
        row_key("doc_id", "source", "text").alias("row"),
    )


def mix_plan(
    sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 42
) -> DataFrame:
    """``doc_id, source, size, row, source_size, target, copies`` of settled documents."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = settle(targets(sources, weights, most), "targets")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    expected = F.least(F.floor(ratio * UNIT), F.lit(most * UNIT)).cast("long")
    rows = (
        lookup(sized, shares, ["source"], rows=shares.count())
        .withColumn("_expected", expected)
        .withColumn("_band", F.floor(F.log2(F.col("size") + 1.0) * BANDS).cast("int"))
    )
    summed = numbered(rows, ["source"], ["size", "row"], bands=["_band"], value="_expected")
    offset = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit(""))), F.lit(UNIT))
    start = F.col("_before") + offset
    crossed = F.shiftright(start + F.col("_expected"), 20) - F.shiftright(start, 20)
    return summed.select(*sized.columns, "source_size", "target", crossed.cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns.

    Only here do texts move, once, to meet their number of copies. Rows that are
    equal are told apart by their number, on the same partitions.
    """
    same = Window.partitionBy("_row").orderBy(F.lit(0))
    plan = mix_plan(settle(measured(docs), "sizes"), **options).where("copies > 0")
    plan = plan.select(F.col("row").alias("_row"), "copies").withColumn("_n", F.row_number().over(same))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    rows = docs.select(whole, row_key("doc_id", "source", "text").alias("_row"))
    taken = rows.withColumn("_n", F.row_number().over(same)).join(plan, ["_row", "_n"])
    return taken.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")
