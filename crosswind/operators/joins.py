"""Joins of facts with lookup tables, for any table size and any key skew.

A lookup table is broadcast only when its measured size is under a limit. Over
the limit the join shuffles, and keys that would overload one task are cut into
pieces first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DecimalType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

BROADCAST_BYTES = 64 * 1024 * 1024
# What a row takes besides its values.
ROW_BYTES = 16


def table_bytes(df: DataFrame) -> int:
    """Size of a table's values, nested ones included, from one aggregate over the whole table."""
    row = sum((value_bytes(df[f"`{f.name}`"], f.dataType) for f in df.schema.fields), F.lit(ROW_BYTES))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def value_bytes(value: Column, kind: DataType) -> Column:
    """Bytes a value takes in a row: its slot, and what the slot points to."""
    if isinstance(kind, (StringType, BinaryType)):
        held = F.octet_length(value)
    elif isinstance(kind, StructType):
        held = sum((value_bytes(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    elif isinstance(kind, ArrayType):
        held = F.lit(16) + _elements_bytes(value, kind.elementType)
    elif isinstance(kind, MapType):
        keys = _elements_bytes(F.map_keys(value), kind.keyType)
        held = F.lit(40) + keys + _elements_bytes(F.map_values(value), kind.valueType)
    elif isinstance(kind, VariantType):
        held = F.octet_length(F.to_json(value))
    else:
        return F.lit(16 if isinstance(kind, DecimalType) else 8)
    return F.lit(8) + F.coalesce(held, F.lit(0))


def _elements_bytes(values: Column, kind: DataType) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, v: total + value_bytes(v, kind).cast("int"))


def hashable(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns in a form that can be hashed: what holds a map or variant goes as its JSON text."""

    def bare(kind: DataType) -> bool:
        if isinstance(kind, StructType):
            return all(bare(f.dataType) for f in kind.fields)
        if isinstance(kind, ArrayType):
            return bare(kind.elementType)
        return not isinstance(kind, (MapType, VariantType))

    return [
        F.col(f"`{c}`") if bare(df.schema[c].dataType) else F.to_json(F.struct(F.col(f"`{c}`")))
        for c in columns
    ]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a table is measured to be small enough for every executor to hold."""
    return limit > 0 and table_bytes(df) <= limit


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "left",
    *,
    limit: int = BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Facts with the lookup's other columns; ``on`` maps fact to lookup columns.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. Null keys match
    nothing. ``small`` gives the outcome of a measurement already made.
    """
    if how in ("left_semi", "left_anti"):
        lookup = lookup.select(*on.values()).distinct()
    if fits_broadcast(lookup, limit) if small is None else small:
        return keyed_join(facts, F.broadcast(lookup), on, how)
    return spread_join(facts, lookup, on, how)


def keyed_join(facts: DataFrame, lookup: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    """Plain equi-join that keeps the fact columns and drops the lookup's key."""
    keys = {right: f"_key_{i}" for i, right in enumerate(on.values())}
    renamed = lookup.withColumnsRenamed(keys)
    condition = reduce(
        Column.__and__, (F.col(left) == F.col(keys[right]) for left, right in on.items())
    )
    return facts.join(renamed, condition, how).drop(*keys.values())


def heavy_keys(facts: DataFrame, key_sets: list[list[str]]) -> DataFrame:
    """Keys that outweigh a fair shuffle partition: ``key_0…, pieces``.

    With P partitions a fair one holds total/P rows, and a key with n rows is
    cut into ceil(n * P / total) pieces. Keys with one piece are left out, so
    at most P keys remain whatever the data, and their pieces number at most 2P:
    the list is small by counting. Several key
    sets that meet the same lookup table are counted together in one pass, each
    adding as much to the bounds.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"key_{i}" for i in range(len(key_sets[0]))]
    roles = [
        F.struct(*[F.col(column).alias(name) for column, name in zip(columns, names)])
        for columns in key_sets
    ]
    if len(roles) == 1:
        keys = facts.select(roles[0].alias("key")).select("key.*")
    else:
        keys = facts.select(F.inline(F.array(*roles)))
    counts = keys.dropna("any").groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    pieces = F.ceil(F.col("n") * (partitions * len(roles)) / total).cast("int")
    return counts.select(*names, pieces.alias("pieces")).where("pieces > 1")


def key_grid(facts: DataFrame, key_sets: list[list[str]], lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Keys too heavy for a task on either side: ``key_0…, pieces, parts``.

    The facts of a key are cut into ``pieces`` and its lookup rows into
    ``parts``, each by its share of its own side. Every piece meets every part,
    so the facts of a key are copied once for each part and its lookup rows once
    for each piece, both less often than they occur in the result.
    """
    one = F.lit(1)
    heavy = heavy_keys(facts, key_sets).withColumn("parts", one)
    crowded = heavy_keys(lookup, [keys]).select(*[f"key_{i}" for i in range(len(keys))], one, F.col("pieces"))
    both = heavy.union(crowded).groupBy(*[f"key_{i}" for i in range(len(keys))])
    return both.agg(F.max("pieces").alias("pieces"), F.max("parts").alias("parts"))


def _placed(df: DataFrame, keys: list[str], grid: DataFrame, copies: str, by: list[str]) -> DataFrame:
    """Rows once for each of the ``copies`` of their key, with ``_pieces``, ``_parts``, ``_copy`` and ``_hash``.

    The small table has a row for each copy, so the join that finds a heavy key copies too.
    """
    names = {f"key_{i}": f"_heavy_{i}" for i in range(len(keys))}
    numbers = F.sequence(F.lit(0), F.col(copies) - 1)
    listed = grid.select(
        *[F.col(key).alias(name) for key, name in names.items()],
        F.col("pieces").alias("_pieces"),
        F.col("parts").alias("_parts"),
        F.explode(numbers).alias("_copy"),
    )
    condition = reduce(
        Column.__and__, (F.col(key) == F.col(name) for key, name in zip(keys, names.values()))
    )
    placed = df.withColumn("_hash", F.xxhash64(*hashable(df, by))).join(F.broadcast(listed), condition, "left")
    return placed.drop(*names.values()).na.fill(1, ["_pieces", "_parts"]).na.fill(0, ["_copy"])


def spread_facts(
    facts: DataFrame, keys: list[str], grid: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """Facts with ``_piece`` and ``_part``: once for each part of their key's lookup rows.

    The piece follows from the row's own values in the columns ``by``, else in
    all columns, so a task that runs again after a lost executor sends its rows
    to the same place. Rows with a null key match nothing and are spread over
    all partitions. ``_alone`` tells that a row was not copied.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    any_null = reduce(Column.__or__, (F.col(key).isNull() for key in keys))
    pieces = F.when(any_null, partitions).otherwise(F.col("_pieces"))
    return (
        _placed(facts, keys, grid, "parts", by or facts.columns)
        .withColumn("_piece", F.pmod("_hash", pieces).cast("int"))
        .withColumn("_alone", F.col("_parts") == 1)
        .withColumnRenamed("_copy", "_part")
        .drop("_hash", "_pieces", "_parts")
    )


def copy_lookup(lookup: DataFrame, keys: list[str], grid: DataFrame) -> DataFrame:
    """Lookup rows with ``_part`` and ``_piece``: once for each piece of their key's facts."""
    return (
        _placed(lookup, keys, grid, "pieces", lookup.columns)
        .withColumn("_part", F.pmod("_hash", F.col("_parts")).cast("int"))
        .withColumnRenamed("_copy", "_piece")
        .drop("_hash", "_pieces", "_parts")
    )


def grid_join(facts: DataFrame, lookup: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    """Join of spread facts and copied lookup rows; the cells' numbers are dropped.

    A fact that was copied finds its match in one part or another, so copies
    that find none in theirs are left out.
    """
    cells = on | {"_piece": "_piece", "_part": "_part"}
    if how in ("left_semi", "left_anti", "inner"):
        return keyed_join(facts, lookup, cells, how).drop("_piece", "_part", "_alone")
    found = keyed_join(facts, lookup.withColumn("_met", F.lit(True)), cells, how)
    return found.where(F.col("_alone") | F.col("_met").isNotNull()).drop("_piece", "_part", "_alone", "_met")


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "left",
    *,
    grid: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join in which keys that are heavy on either side are cut into a grid of pieces.

    Exact copies of a row share a piece; should such copies pile up, AQE still
    splits the partition they land in. Semi and anti joins take a lookup of
    different keys, so there only facts are cut.
    """
    keys = list(on)
    if grid is None:
        grid = key_grid(facts, [keys], lookup, list(on.values()))
    left = spread_facts(facts, keys, grid)
    # Beyond the limit Spark's own estimate must not bring the broadcast back.
    right = copy_lookup(lookup, list(on.values()), grid).hint("merge")
    return grid_join(left, right, on, how)
