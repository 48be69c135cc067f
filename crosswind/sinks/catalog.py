"""Catalog tables and views."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosswind.session import children, delete_path, listed_files, path_exists

# What the names of folders with the versions of a table begin with.
VERSION = "version-"
# The column, and partition, that tells which load a row of a table came by.
LOAD = "load_id"
# The folder in a table's own, hidden from its readers, that lists the files of each load.
LEDGER = "_loads"


def table_from_parquet(
    spark: SparkSession, table: str, path: str, *, location: str | None = None
) -> None:
    """Create or replace an empty table with the columns of a Parquet file."""
    replace_table_as(spark.read.parquet(path).limit(0), table, location=location)


def load_by_name(df: DataFrame, table: str) -> None:
    """Append rows, columns matched by name whatever their case or order.

    Columns the rows lack are null; a column the table lacks is an error.
    """
    df.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=df)


def loaded_table(df: DataFrame, table: str, location: str) -> None:
    """Create an empty table with the columns of a query, to be filled by ``load_files``.

    ``load_id`` is added as its last column and partition.
    """
    if LOAD in (name.lower() for name in df.columns):
        raise ValueError(f"{LOAD} tells the loads apart and cannot be a column of the rows")
    empty = df.limit(0).withColumn(LOAD, F.lit(""))
    empty.write.partitionBy(LOAD).option("path", location).format("parquet").saveAsTable(table)


def load_files(
    spark: SparkSession,
    table: str,
    source: str,
    *,
    read: Callable[[list[str]], DataFrame] | None = None,
    force: bool = False,
) -> int:
    """Append the rows of files that the table has not loaded yet; the number of these files.

    The files at or below ``source`` are told from others by path, size and time,
    so one that was written anew is loaded again, beside its old rows. ``force``
    loads all of them, whether loaded before or not. ``read`` makes rows of
    paths, Parquet of any columns by default; columns go by name, as in
    ``load_by_name``.

    All rows of a load are one partition, and the catalog takes it in by one
    change after they are written: readers see all of them or none. A file counts
    as loaded only if the catalog has its load, so a load that died, wherever it
    was, is done again when it is next asked for, over what it left behind. Loads
    of one table must not run at the same time.
    """
    facts = _described(spark, table)
    if LOAD not in spark.table(table).columns or "# Partition Information" not in facts:
        raise ValueError(f"{table} was not made by loaded_table")
    ledger = f"{facts['Location'].rstrip('/')}/{LEDGER}"
    found = listed_files(spark, source)
    if not force:
        found = found.join(loaded_files(spark, table), ["path", "length", "modified"], "left_anti")
    found = found.orderBy("path").collect()
    if not found:
        return 0
    # The same files make the same load, so a repeated one replaces what a dead one left.
    load = hashlib.sha256(repr([tuple(row) for row in found]).encode()).hexdigest()
    load += f"-{uuid.uuid4().hex}" if force else ""
    listed = spark.createDataFrame(found, "path string, length long, modified timestamp")
    listed.write.mode("overwrite").parquet(f"{ledger}/{LOAD}={load}")
    paths = [row["path"] for row in found]
    rows = read(paths) if read else spark.read.option("mergeSchema", "true").parquet(*paths)
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({LOAD} = '{load}') BY NAME SELECT * FROM {{rows}}", rows=rows)
    return len(found)


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """Files that a table of ``loaded_table`` has loaded: ``path, length, modified``, and ``load_id``."""
    ledger = f"{_described(spark, table)['Location'].rstrip('/')}/{LEDGER}"
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], f"path string, length long, modified timestamp, {LOAD} string")
    noted = spark.read.schema(f"path string, length long, modified timestamp, {LOAD} string").parquet(ledger)
    taken = spark.sql(f"SHOW PARTITIONS {table}").select(F.substring_index("partition", "=", -1).alias(LOAD))
    return noted.join(taken, LOAD, "left_semi").select("path", "length", "modified", LOAD)


def replace_table_as(
    df: DataFrame,
    table: str,
    *,
    location: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Create or replace a table from a query's rows, without a moment at which it holds part of them.

    The rows are written whole to a new folder below ``location``, beside those
    that the table has; only then the table is pointed to it. A write that dies
    leaves the old rows, and the query may read the table that it replaces. The
    folder that the table had stays for readers that have begun with it; older
    complete ones are deleted. The folder of a write that died is left.
    """
    spark = df.sparkSession
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    base = location or f"{warehouse}/{table.split('.')[-1]}-versions"
    version = f"{base.rstrip('/')}/{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(version)
    before = _described(spark, table).get("Location", "") if spark.catalog.tableExists(table) else ""
    point_table(spark, table, version, partitioned=bool(partition_by))
    _drop_versions(spark, base, {version.rsplit("/", 1)[-1], before.rstrip("/").rsplit("/", 1)[-1]})


def point_table(spark: SparkSession, table: str, path: str, *, partitioned: bool = False) -> None:
    """Let a table be the Parquet files of a folder, whatever it was before.

    Where the columns stay the same, this is one change of the catalog, so readers
    find the old rows or the new ones. Where they change, or rows are in folders
    by value, the name is made anew, and missing for as long as that takes; no rows
    are moved or deleted by it.
    """
    if spark.catalog.tableExists(table):
        if not partitioned and _same_columns(spark, table, path):
            escaped = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{escaped}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(table)


def _same_columns(spark: SparkSession, table: str, path: str) -> bool:
    """Whether an unpartitioned table of Parquet files has the columns that a folder's files have."""
    facts = _described(spark, table)
    if "# Partition Information" in facts or facts.get("Type") == "VIEW" or facts.get("Provider", "").lower() != "parquet":
        return False
    now, then = spark.table(table).schema, spark.read.parquet(path).schema
    return [(f.name, f.dataType) for f in now] == [(f.name, f.dataType) for f in then]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {row["col_name"]: row["data_type"] for row in described}


def _drop_versions(spark: SparkSession, base: str, kept: set[str]) -> None:
    """Delete the complete versions older than the newest of those kept; unfinished ones may still be written."""
    for path in children(spark, base):
        name = path.rsplit("/", 1)[-1]
        if name.startswith(VERSION) and name < max(kept) and name not in kept and path_exists(spark, f"{path}/_SUCCESS"):
            delete_path(spark, path)


def replace_view(df: DataFrame, view: str) -> None:
    """Create or replace a view of this session; its query runs when it is read."""
    df.createOrReplaceTempView(view)


def replace_sql_view(spark: SparkSession, view: str, query: str, *, temporary: bool = True) -> None:
    """Create or replace a view from a SQL query, in the catalog if not temporary."""
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}VIEW {view} AS {query}")


def lasting_catalog(spark: SparkSession) -> bool:
    """Whether tables and views outlive the session."""
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "in-memory"


def publish_view(spark: SparkSession, view: str, path: str) -> None:
    """Create or replace a view of a Parquet dataset, one that lasts where the catalog does."""
    if not lasting_catalog(spark):
        replace_view(spark.read.parquet(path), view)
        return
    escaped = path.replace("`", "``")
    replace_sql_view(spark, view, f"SELECT * FROM parquet.`{escaped}`", temporary=False)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """The one column spelled exactly ``old`` renamed; other spellings stay."""
    return df.toDF(*[new if name == old else name for name in df.columns])
