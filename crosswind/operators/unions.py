"""Row unions and key lists."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosswind.functions.text import folder_value, unescaped
from crosswind.session import qualified_path

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/*"


def union_files(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_tagged(frames: dict[str, DataFrame], tag: str = "airport") -> DataFrame:
    """All rows of all frames, each with the name of its frame."""
    return union_files([df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def scan_tagged(
    spark: SparkSession,
    paths: dict[str, str],
    tag: str = "airport",
    *,
    columns: list[str] | None = None,
    folders: tuple[str, ...] = (),
) -> DataFrame:
    """All rows of several Parquet datasets, each row with the name of its dataset, from one scan.

    Datasets in folders ``name=value`` are read whole if ``folders`` tells these
    names, which are then columns of text, null in datasets that lack them.

    The name follows from the file a row is in: of the given paths the longest
    that the file is at or below. One lookup for each depth at which paths end
    finds it, however many paths there are. A file below none is an error.
    """
    ends = {tidy_path(qualified_path(spark, path)): name for name, path in paths.items()}
    rows = spark.read.parquet(*paths.values(), recursiveFileLookup=bool(folders))
    path = F.col("_metadata.file_path")
    chosen = [F.col(f"`{c}`") for c in columns or rows.columns]
    chosen += [folder_value(path, name).alias(name) for name in folders]
    names = F.create_map(*[F.lit(x) for pair in ends.items() for x in pair])
    file = F.regexp_replace(unescaped(path), SCHEME, "/")
    depths = sorted({end.count("/") for end in ends}, reverse=True)
    found = [F.try_element_at(names, F.substring_index(file, "/", depth + 1)) for depth in depths]
    lost = F.raise_error(F.concat(F.lit("no tag for "), file)).cast("string")
    return rows.select(*chosen, F.coalesce(*found, lost).alias(tag))


def tidy_path(path: str) -> str:
    """A path without its scheme, as it appears behind the scheme of a file's path."""
    return "/" + re.sub(SCHEME, "/", path).strip("/")


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def preview(df: DataFrame, order_by: list[str], rows: int = 10) -> DataFrame:
    """First rows in a stated order; a top-k, not a full sort."""
    return df.orderBy(*order_by).limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
