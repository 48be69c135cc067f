"""Spans of patterns in whole texts, with their places, in DataFrame functions alone.

Places are in code points, the end excluded. A pattern's matches and the pieces
between them come from two built-in functions; the running sum of their lengths
gives the places. It is taken over rows, one per match, not inside an array, so
a text with very many matches takes no more than its share of time.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswind.llm.common import row_key
from crosswind.session import settle

BEFORE, AFTER = 48, 24
ROW = "_row"


class Pattern(NamedTuple):
    """``name`` is unique; spans are reported under ``kind``; a text without ``hint`` has none."""

    name: str
    kind: str
    regex: str
    hint: str
    group: int = 0


def matched(docs: DataFrame, patterns: Sequence[Pattern], *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, _row, _found`` of every row, settled; ``_found`` holds what the patterns match.

    Rows that agree in id and text share ``_row`` and everything found in them.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    rows = rows.select("id", "text", row_key("id", "text").alias(ROW))
    found = rows.select(
        "id",
        ROW,
        "text",
        *[
            F.when(
                F.col("text").rlike(p.hint), F.regexp_extract_all("text", F.lit(p.regex), F.lit(0))
            ).alias(f"m_{p.name}")
            for p in patterns
        ],
    )
    has = {p.name: F.size(f"m_{p.name}") > 0 for p in patterns}
    cut = found.select(
        "id",
        ROW,
        *[f"m_{p.name}" for p in patterns],
        *[F.when(has[p.name], F.split("text", p.regex, -1)).alias(f"s_{p.name}") for p in patterns],
        *[
            F.when(has[p.name], F.regexp_extract_all("text", F.lit(p.regex), F.lit(p.group))).alias(f"g_{p.name}")
            for p in patterns
            if p.group
        ],
    )
    return settle(cut.select("id", ROW, F.flatten(F.array_compact(F.array(*map(_listed, patterns)))).alias("_found")), "matched")


def _listed(p: Pattern) -> Column:
    """The matches of one pattern as structs; null if there are none."""
    found, pieces = F.col(f"m_{p.name}"), F.col(f"s_{p.name}")
    inner = F.col(f"g_{p.name}") if p.group else found
    zipped = F.arrays_zip(
        found.alias("m"),
        F.slice(pieces, 1, F.size(found)).alias("b"),
        F.slice(pieces, 2, F.size(found)).alias("a"),
        inner.alias("g"),
    )
    return F.when(
        F.size(found) > 0,
        F.transform(
            zipped,
            lambda z, i: F.struct(
                F.lit(p.name).alias("name"),
                F.lit(p.kind).alias("kind"),
                i.alias("i"),
                F.length(z["b"]).alias("gap"),
                F.length(z["m"]).alias("len"),
                z["m"].alias("match"),
                z["g"].alias("inner"),
                F.right(z["b"], F.lit(BEFORE)).alias("before"),
                F.left(z["a"], F.lit(AFTER)).alias("after"),
            ),
        ),
    )


def placed(found: DataFrame) -> DataFrame:
    """One row per distinct text and match: ``_row, name, kind, start, stop, match, inner, before, after``."""
    each = (
        found.where(F.size("_found") > 0)
        .select(ROW, "_found")
        .dropDuplicates([ROW])
        .select(ROW, F.inline("_found"))
    )
    so_far = Window.partitionBy(ROW, "name").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    return each.select(
        ROW, "name", "kind", (end - F.col("len")).alias("start"), end.alias("stop"), "match", "inner", "before", "after"
    )


def not_overlapping(extra: DataFrame, base: DataFrame, on: list[str], reach: int = 512) -> DataFrame:
    """``extra`` spans that touch no ``base`` span with the same ``on``: an interval join by cells.

    A span is entered in every cell it reaches into, so one equality and one
    comparison find all overlaps.
    """
    cells = F.sequence(F.floor(F.col("start") / reach), F.floor((F.col("stop") - 1) / reach))
    left = extra.withColumn("_id", F.struct(*on, "start", "stop")).withColumn("_cell", F.explode(cells))
    right = base.select(*[F.col(c).alias(f"_b_{c}") for c in on], F.col("start").alias("_b_start"), F.col("stop").alias("_b_stop"), F.explode(cells).alias("_b_cell"))
    same = (F.col("_cell") == F.col("_b_cell")) & (F.col("start") < F.col("_b_stop")) & (F.col("_b_start") < F.col("stop"))
    for name in on:
        same = same & (F.col(name) == F.col(f"_b_{name}"))
    hit = left.join(right, same, "left_semi").select("_id").distinct()
    return extra.withColumn("_id", F.struct(*on, "start", "stop")).join(hit, "_id", "left_anti").drop("_id")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted structs, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def report(found: DataFrame, base: DataFrame, extra: DataFrame, kinds: list[str], *, by_start: bool) -> DataFrame:
    """``id, _row, n_<kind>…, base_sha256, spans, _spans`` of every row.

    Spans stand by kind as listed, then start, or by start first; kinds not
    listed come last, by name.
    """
    names = F.array(*map(F.lit, kinds))
    both = base.select(ROW, "kind", "start", "stop", F.lit(True).alias("base")).unionByName(
        extra.select(ROW, "kind", "start", "stop", F.lit(False).alias("base"))
    )
    place = F.array_position(names, F.col("kind"))
    place = F.when(place > 0, place).otherwise(len(kinds) + 1)
    order = ["start", "place", "kind", "stop"] if by_start else ["place", "kind", "start", "stop"]
    ordered = both.withColumn("place", place)
    listed = ordered.groupBy(ROW).agg(
        F.array_sort(F.collect_set(F.struct(*order, "base"))).alias("_spans"),
        *[F.count_if(F.col("base") & (F.col("kind") == kind)).alias(f"n_{kind}") for kind in kinds],
    )
    result = found.select("id", ROW).join(listed, ROW, "left")
    spans = F.col("_spans")
    only_base = F.filter(spans, lambda s: s["base"])
    return result.select(
        "id",
        ROW,
        *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in kinds],
        F.sha2(F.coalesce(joined(only_base), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(spans), F.lit("")).alias("spans"),
        "_spans",
    )
