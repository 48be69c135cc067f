"""Helpers that several of the operators share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from crosswind.operators.joins import BROADCAST_BYTES

PACKAGE = Path(__file__).resolve().parent.parent
# A group is cut so that the pieces of all groups number about this many.
PIECES = 2048
# What a lookup table may hold before it is no longer broadcast.
LOOKUP_ROWS = 200_000

# Kinds of columns whose values take different numbers of bytes.
VARIABLE = (pa.types.is_string, pa.types.is_large_string, pa.types.is_binary, pa.types.is_large_binary)

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Functions that run in Python workers are found there by their module's name.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="crosswind-code-")) / "crosswind.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(PACKAGE.rglob("*.py")):
            archive.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few rows from the driver, by Arrow: rows sent as Python objects would need workers to unpack them."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) or [()] * len(kinds)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds))


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def row_key(*columns: str) -> Column:
    """A text that two rows share only if they agree in all the columns, nulls included."""
    parts = []
    for name in columns:
        value = F.col(name).cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(size, F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def lookup(df: DataFrame, table: DataFrame, on: list[str], *, rows: int) -> DataFrame:
    """Left join, nulls equal, with a table of ``rows`` rows, broadcast only while few.

    Beyond that the join shuffles, and AQE splits the partitions that a heavy
    key makes too large.
    """
    names = {key: f"_on_{i}" for i, key in enumerate(on)}
    right = table.withColumnsRenamed(names)
    if rows <= LOOKUP_ROWS:
        right = F.broadcast(right)
    condition = F.lit(True)
    for key, name in names.items():
        condition = condition & F.col(key).eqNullSafe(F.col(name))
    return df.join(right, condition, "left").drop(*names.values())


def numbered(
    df: DataFrame,
    group: list[str],
    ties: list[str],
    *,
    bands: list[str] | None = None,
    value: str | None = None,
    pieces: int = PIECES,
) -> DataFrame:
    """Rows with ``_before``: the rows, or their ``value``, that stand before a row in its group.

    Order within a group: ``bands`` ascending, then pieces by hash, then
    ``ties``, which together must tell rows apart wherever it matters. A group
    and band that holds a share of the rows is cut into as many pieces as that
    share of ``pieces``, so no task sorts a whole hot group; totals of the
    pieces give each its start. The number of bands of a group must be small.

    ``df`` is read three times: give it a settled table.
    """
    bands = bands or []
    cell = [*group, *bands]
    amount = F.col(value) if value else F.lit(1)
    counts = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 1
    cells = counts.count()
    cuts = counts.select(*cell, F.ceil(F.col("_n") * pieces / F.lit(total)).cast("int").alias("_cuts"))
    salted = lookup(df, cuts, cell, rows=cells).withColumn(
        "_piece", F.pmod(F.xxhash64(*ties), F.col("_cuts")).cast("int")
    ).drop("_cuts")
    sums = salted.groupBy(*cell, "_piece").agg(F.sum(amount).alias("_sum"))
    order = Window.partitionBy(*group).orderBy(*bands, "_piece")
    starts = sums.select(
        *cell,
        "_piece",
        F.coalesce(
            F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_start"),
    )
    inside = Window.partitionBy(*cell, "_piece").orderBy(*ties)
    here = F.coalesce(
        F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    ranked = salted.withColumn("_here", here)
    return (
        lookup(ranked, starts, [*cell, "_piece"], rows=cells + pieces)
        .withColumn("_before", F.col("_start") + F.col("_here"))
        .drop("_start", "_here", "_piece")
    )


def give_back() -> None:
    """Return freed memory to the system: an idle worker should not keep what it no longer needs."""
    pa.default_memory_pool().release_unused()
    # Only glibc has this call; elsewhere freed memory stays with the worker.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_slices(
    stream: Iterator[pa.RecordBatch], limit: int = 8 << 20, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of about ``limit`` bytes of text and at most ``rows`` rows, a longer text by itself."""
    for batch in stream:
        held = [c for c in batch.columns if any(is_kind(c.type) for is_kind in VARIABLE)]
        sizes = sum((np.asarray(pc.binary_length(c).fill_null(0)).astype("i8") for c in held), np.zeros(batch.num_rows, "i8"))
        ends, start = sizes.cumsum(), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            stop = min(stop, start + rows) if rows else stop
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def slices(stream: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in smaller pieces, so that few texts are held in Python at a time, however long they are."""
    return byte_slices(stream, 4 << 20, rows)


__all__ = ["BROADCAST_BYTES", "byte_slices", "give_back", "lookup", "numbered", "row_key", "ship", "slices", "small_table", "text_bytes"]
