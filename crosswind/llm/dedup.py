"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. Runs of five words are counted over all documents in a sketch of fixed size:
   a first pass adds up counters, which give each shingle's rarity.
2. A second pass draws consistent weighted samples of every text's shingles,
   weighted by how often they occur in it and how rare they are, and puts them
   together into bands.
3. Equal texts are one from here on. Texts that share a band are compared, not
   each with each: the one in the midst of a band with all others, then those
   whose classes are still apart with further ones, in small bands all of them.
   What is then still apart in a larger band is compared in full, all of it in
   cells of bounded size. A pair counts if its weighted Jaccard similarity, over all
   shingles, is at least 0.8; a pair just below it only for its weights, that
   is at 0.8 with every distinct shingle counted once, counts too.
4. Connected texts form a class.

So the classes are those of all similar pairs that share a band. Copies are
never expanded into pairs. A band's members meet in one task only as rows of
ids, which a sort-merge join passes on as a stream.

Nulls: a null text is an empty one. Texts that are equal, empty ones too, are in
one class; a text without words is otherwise alone. Fewer than five words make
one shingle. Null ids are kept and come last in a class. Rows that repeat are
members each for themselves. An empty table gives an empty one. Other columns
are not looked at by ``classes`` and pass untouched through ``first_of_each``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crosswind.llm import shingles
from crosswind.llm.common import LOOKUP_ROWS, ship, slices, text_bytes
from crosswind.session import settle

SIMILAR = 0.8
# The counters travel in slices, so that adding them up is shared among tasks.
SLICE = 1 << 14
# Bands with at most this many texts still apart have all of them compared.
FEW = 6
# Texts on either side of a cell, in which all of one side meet all of the other.
SIDE = 256


def counted(texts: DataFrame) -> np.ndarray:
    """How many documents hold a shingle of each counter; all documents count."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shingles.COUNTERS, np.int64)
        for batch in slices(stream):
            found = (shingles.distinct(shingles.fingerprints(shingles.shingle_hashes(t)))[0] for t in text_bytes(batch.column(0)))
            for some in shingles.chunks(list(found), len):
                at, n = np.unique(shingles.counters(np.concatenate(some)), return_counts=True)
                sums[at] += n
        if sums.any():
            parts = sums.reshape(-1, SLICE)
            packed = [zlib.compress(part.astype("<i8").tobytes(), 1) for part in parts]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(packed, pa.binary())], ["slice", "counts"])

    def add(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in stream:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(packed), "<i8")
                sums[number] = sums[number] + counts if number in sums else counts
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for c in sums.values()], pa.binary())], ["slice", "counts"]
            )

    schema = "slice int, counts binary"
    parts = shingles.COUNTERS // SLICE
    partial = texts.mapInArrow(count, schema).repartition(parts, "slice").mapInArrow(add, schema)
    total = np.zeros((parts, SLICE), np.int64)
    # A table of fixed size: the sketch itself.
    for row in partial.toLocalIterator():
        total[row["slice"]] += np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    return total.ravel()


def features(texts: DataFrame, idf) -> DataFrame:
    """``digest, bands, prints`` of every row next to its id, settled, with ``rid`` to name the row."""

    def sample(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(idf.value, "<f4")
        for batch in slices(stream):
            rows = zip(batch.column(1).to_pylist(), text_bytes(batch.column(0)))
            each = [(i, shingles.digest(t), shingles.fingerprints(shingles.shingle_hashes(t))) for i, t in rows]
            for some in shingles.chunks(each, lambda row: 1 + len(row[2])):
                pairs = [shingles.distinct(prints) for *_, prints in some if len(prints)]
                bands = iter(shingles.band_keys(shingles.samples(*map(list, zip(*pairs)), table)) if pairs else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, *_ in some], pa.int64()),
                        pa.array([d for _, d, _ in some], pa.string()),
                        pa.array([next(bands) if len(p) else [] for *_, p in some], pa.list_(pa.int64())),
                        pa.array([p.astype("<u4").tobytes() for *_, p in some], pa.binary()),
                    ],
                    ["id", "digest", "bands", "prints"],
                )

    rows = texts.mapInArrow(sample, "id long, digest string, bands array<long>, prints binary")
    return settle(rows.withColumn("rid", F.monotonically_increasing_id()), "features")


def compared(pairs: DataFrame, table: DataFrame, idf, least: float) -> DataFrame:
    """The pairs ``a, b`` whose texts are similar; each text's shingles travel once to its pairs."""

    def similar(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(idf.value, "<f4")
        for batch in slices(stream):
            ab = [batch.column(i).to_pylist() for i in (2, 3)]
            keep = [max(shingles.jaccards(x, y, weights)) >= least for x, y in zip(*ab)]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("rid"))
    met = ends.hint("merge").join(table, "rid")
    both = met.groupBy("a", "b").agg(
        F.max(F.when(F.col("rid") == F.col("a"), F.col("prints"))).alias("x"),
        F.max(F.when(F.col("rid") == F.col("b"), F.col("prints"))).alias("y"),
    )
    return both.mapInArrow(similar, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge: large-star and small-star in turn until nothing moves.

    Each turn is a minimum per node and a join, so a node with very many edges
    is no burden to one task.
    """
    stars = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    seen = None
    while True:
        sign = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if sign == seen:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = sign
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = settle(least.select("a", F.col("m").alias("b")).unionAll(moved).where("a != b").distinct(), "stars")


def with_heads(bands: DataFrame) -> DataFrame:
    """Texts that share a band, ``rid, band, n, head``: the band's texts, and the one in the midst of them.

    That is the one whose bands, all together, hold the most texts: in a family of
    copies, the text most like what they were copied from. Compared with it most
    of a family is linked at once, where copies of each other's edges would not be.
    """
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = settle(bands.join(sizes, "band"), "bands")
    weights = met.groupBy("rid").agg(F.sum("n").alias("weight"))
    central = F.max_by("rid", F.struct("weight", -F.col("rid"))).alias("head")
    heads = met.join(weights, "rid").groupBy("band").agg(central)
    return met.join(heads, "band")


def further_pairs(shared: DataFrame, roots: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs within a band whose classes are still apart and that were not compared yet.

    Few members: all pairs. More: each with several others, two picked among the
    members and two among the classes, so small classes are picked as well;
    ``apart_pairs`` sees to the rest.
    """
    members = shared.join(roots, shared.rid == roots.node, "left").select(
        "band", "rid", F.coalesce("root", "rid").alias("root")
    )
    one = F.struct("rid", "root")
    picks = [F.min_by(one, F.xxhash64(F.lit(turn), by)) for turn, by in enumerate(("rid", "rid", "root", "root"))]
    spread = members.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"),
        (F.min("root") != F.max("root")).alias("apart"),
        F.array_distinct(F.array(*picks)).alias("picked"),
    )
    members = members.join(spread.where("apart").drop("apart"), "band")
    small = members.where(F.col("n") <= FEW)
    other = small.select("band", F.col("rid").alias("b"), F.col("root").alias("b_root"))
    every = small.select("band", F.col("rid").alias("a"), "root").join(other, "band").where("a < b AND root != b_root")
    star = members.where(F.col("n") > FEW).select("rid", "root", F.explode("picked").alias("other")).where("root != other.root")
    both = every.select("a", "b").unionAll(
        star.select(F.least("other.rid", "rid").alias("a"), F.greatest("other.rid", "rid").alias("b"))
    )
    return both.distinct().join(tried, ["a", "b"], "left_anti")


def apart_pairs(crowded: DataFrame, roots: DataFrame, prints: DataFrame, idf, least: float) -> DataFrame | None:
    """All similar pairs ``a, b`` within ``crowded`` bands whose classes are still apart, one for each text and class.

    Of two classes one is not the band's largest, so only texts outside the
    largest are put against all members. Both sides are cut into pieces, and a
    cell holds one piece of each: no task gets a whole band, and a text's
    shingles travel once to a cell, not once to a pair.
    """
    members = crowded.join(roots, crowded.rid == roots.node, "left").select("band", "rid", F.coalesce("root", "rid").alias("root"))
    by_class = members.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    spread = by_class.groupBy("band").agg(
        F.max_by("root", F.struct("n", "root")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("n")
    ).where("most < n")
    cuts = spread.select("band", "major", F.ceil((F.col("n") - F.col("most")) / SIDE).alias("rows"), F.ceil(F.col("n") / SIDE).alias("columns"))
    met = members.join(cuts, "band")
    place = F.xxhash64("rid", "band")
    left = met.where("root != major").select(
        "band", F.pmod(place, "rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(True).alias("left"), "rid", "root"
    )
    right = met.select(
        "band", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(place, "columns").alias("j"), F.lit(False).alias("left"), "rid", "root"
    )
    cells = settle(left.unionAll(right), "cells")
    wanted = settle(cells.select("rid").distinct(), "wanted")
    count = wanted.count()
    if not count:
        return None
    few = F.broadcast(wanted) if count <= LOOKUP_ROWS else wanted.hint("merge")
    rows = cells.hint("merge").join(prints.join(few, "rid", "left_semi"), "rid")

    def compare(cell: pa.Table) -> pa.Table:
        sides: dict[bool, list] = {True: [], False: []}
        for side, *text in zip(*(cell.column(c).to_pylist() for c in ("left", "rid", "root", "prints"))):
            sides[side].append(text)
        found = shingles.linked(sides[True], sides[False], np.frombuffer(idf.value, "<f4"), least) if sides[True] and sides[False] else []
        return pa.table([pa.array([ab[i] for ab in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.groupBy("band", "i", "j").applyInArrow(compare, "a long, b long")


def classes(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", least: float = SIMILAR
) -> DataFrame:
    """``id, digest, class_id, class_size, first`` of every row.

    ``class_id`` is the smallest id in the class, or a negative number where
    there is none or another class has it too; ``class_size`` is its rows.
    ``first`` marks one row of each class, or several that are equal in id and
    text.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(text_column).cast("string").alias("text"), F.col(id_column).cast("long").alias("id"))
    counts = counted(texts.select("text"))
    weights = shingles.rarity(counts, texts.count())
    idf = spark.sparkContext.broadcast(weights.astype("<f4").tobytes())
    table = features(texts, idf)
    # One row stands for all of equal text; it is the first of them in the table.
    by_digest = table.groupBy("digest").agg(
        F.min("rid").alias("rid"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    heads = settle(by_digest, "heads")
    bands = settle(
        table.join(heads.select("rid"), "rid", "left_semi").select("rid", F.explode("bands").alias("band")), "bands"
    )
    shared = settle(with_heads(bands), "shared-bands")
    # From here on only shingles of texts that share a band travel. One way at any size.
    wanted = shared.select("rid").distinct().hint("merge")
    prints = settle(table.select("rid", "prints").join(wanted, "rid", "left_semi"), "prints")
    first_pairs = shared.where("rid != head").select(F.least("head", "rid").alias("a"), F.greatest("head", "rid").alias("b"))
    tried = settle(first_pairs.distinct(), "pairs")
    edges = settle(compared(tried, prints, idf, least), "similar")
    roots = connected(edges)
    for last in (False, True):
        if last:
            fresh = apart_pairs(shared.where(F.col("n") > FEW).select("band", "rid"), roots, prints, idf, least)
            if fresh is None:
                break
        else:
            fresh = compared(further_pairs(shared.drop("n"), roots, tried), prints, idf, least)
        fresh = settle(fresh, "similar")
        if not fresh.isEmpty():
            # Classes found so far stay together; only their roots are joined anew.
            roots = connected(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(fresh))
    rooted = heads.join(roots, heads.rid == roots.node, "left").select(
        "digest", "least_id", "copies", F.coalesce("root", "rid").alias("root")
    )
    named = rooted.groupBy("root").agg(
        F.coalesce(F.min("least_id"), -1 - F.col("root")).alias("name"),
        F.sum("copies").alias("class_size"),
        # Of several texts with the smallest id, one.
        F.min_by("digest", F.struct(F.coalesce("least_id", F.lit((1 << 63) - 1)), "digest")).alias("head"),
    )
    # Where ids repeat, two classes may have the same smallest one.
    same = Window.partitionBy("name").orderBy("head")
    named = named.withColumn(
        "class_id", F.when(F.row_number().over(same) == 1, F.col("name")).otherwise(-1 - F.col("root"))
    )
    by_text = settle(
        rooted.join(named, "root").select("digest", "class_id", "class_size", (F.col("digest") == F.col("head")).alias("_head"), "least_id"),
        "classes",
    )
    return table.select("id", "digest").join(by_text, "digest").select(
        "id", "digest", "class_id", "class_size", (F.col("_head") & F.col("id").eqNullSafe(F.col("least_id"))).alias("first")
    )


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, with its own columns."""
    kept = classes(docs, **options).where("first").select("id", "digest").distinct()
    kept = kept.select(F.col("id").alias("_kept_id"), F.col("digest").alias("_kept_digest"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(whole, F.col("doc_id").cast("long").alias("_id"), F.substring(F.sha2(text, 256), 1, 32).alias("_digest"))
    same = (F.col("_digest") == F.col("_kept_digest")) & F.col("_id").eqNullSafe(F.col("_kept_id"))
    met = keyed.join(kept, same, "left_semi")
    # Rows that repeat: the first of them.
    order = Window.partitionBy("_digest", "_id").orderBy(F.lit(0))
    return met.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("_doc.*")

