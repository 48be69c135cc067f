"""Readers of flight, weather and dimension files."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from crosswind.functions.text import folder_value
from crosswind.operators.joins import lookup_join
from crosswind.schemas import AIRPORTS, CARRIERS, FLIGHTS, RAW_FLIGHTS, WEATHER, WHITELIST
from crosswind.session import children, file_scheme, scratch_path

POSITION = "_position"
# Stands for null while reading, so that an empty text in quotes stays one.
NO_VALUE = "\0"
# Files up to this size are read whole to find their headers.
SMALL_FILE = 4 * 1024 * 1024
# File systems on which tasks open files by themselves.
OPENED_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def typed(name: str, data_type) -> Column:
    """A text column as its declared type, null where the text does not fit.

    Whole numbers also come written with a fraction of zero, since tools that
    keep nulls in number columns write them so.
    """
    text = F.col(f"`{name}`")
    if isinstance(data_type, StringType):
        return text.alias(name)
    if isinstance(data_type, (IntegerType, LongType)):
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number).try_cast(data_type)
        return F.coalesce(text.try_cast(data_type), whole).alias(name)
    return text.try_cast(data_type).alias(name)


def file_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file`` and ``header``, its first line, of every text file at or below the paths; empty files have none.

    Two jobs, however many files there are. Small files are read by Spark, which
    keeps their first lines. Of larger ones tasks read the first bytes only, each
    task those of many files. Where workers cannot open a file, as its file system
    or its compression is one that only Spark knows, Spark reads that too.
    """
    path, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    opened = F.lit(False)
    if all(file_scheme(spark, p) in OPENED_SCHEMES for p in paths):
        opened = (size > SMALL_FILE) & ~path.rlike(r"\.(?:deflate|lz4|snappy)$")
    text = spark.read.text(paths, recursiveFileLookup=True)
    placed = text.where(~opened).select(path.alias("file"), F.col("value").alias("header"), _place().alias("place"))
    firsts = placed.groupBy("file").agg(F.min_by("header", "place").alias("header"))
    # No content is read by this, so a task may get as many files as there are for a core.
    names = spark.newSession()
    names.conf.set("spark.sql.files.maxPartitionBytes", 1 << 45)
    listed = names.read.format("binaryFile").load(paths, recursiveFileLookup=True)
    heads = listed.where(opened).select(path.alias("file")).mapInArrow(first_lines(), "file string, header string")
    found = scratch_path(spark, "headers")
    firsts.write.parquet(f"{found}/by=spark")
    heads.write.parquet(f"{found}/by=task")
    return spark.read.parquet(found).select("file", "header")


def first_lines() -> Callable:
    """The first line of every file named in Arrow batches, for use in tasks."""

    def lines(stream):
        from urllib.parse import unquote

        import pyarrow as pa
        from pyarrow import fs

        def first(file: str) -> str:
            if file.startswith("file:"):
                system, path = fs.LocalFileSystem(), "/" + unquote(file[5:]).lstrip("/")
            else:
                system, path = fs.FileSystem.from_uri(file.replace("s3a:", "s3:", 1))
            head = b""
            with system.open_input_stream(path, compression="detect") as opened:
                while b"\n" not in head and b"\r" not in head:
                    more = opened.read(1 << 16)
                    if not more:
                        break
                    head += more
            return head.replace(b"\r", b"\n").split(b"\n", 1)[0].decode("utf-8", "replace")

        for batch in stream:
            headers = pa.array([first(file) for file in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), headers], ["file", "header"])

    return lines


def column_names(header: str) -> list[str]:
    """Names of a header line: blank ones and those that occur twice told apart by their place."""
    cells = next(csv.reader([header]), [])
    seen = Counter(cell.lower() for cell in cells)
    return [
        f"_c{i}" if not cell else f"{cell}{i}" if seen[cell.lower()] > 1 else cell for i, cell in enumerate(cells)
    ]


def read_text_columns(
    spark: SparkSession, paths: str | list[str], *, multiline: bool = False, position: bool = False
) -> DataFrame:
    """CSV with header, every column as text, each file under its own header.

    All files at or below the paths are read by one scan, whatever their number
    and that of their headers. Where headers differ, a row finds the number of
    its file's header in a small table that leaves out the files of the most
    frequent one; a column that a header lacks is null in its files. Texts come
    back as they were written: blanks at their ends, and empty texts apart from
    nulls. A part ``name=value`` of all paths is a column too, if no header has
    it. ``multiline`` allows line breaks inside quotes, at the price that a file
    is not split among tasks. ``position`` adds ``_position``, see ``read_table``.
    """
    paths = [paths] if isinstance(paths, str) else paths
    files = file_headers(spark, paths)
    counted = files.groupBy("header").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file"))
    # As many rows as there are different headers.
    headers = sorted(counted.collect(), key=lambda row: row["file"])
    layouts = [column_names(row["header"]) for row in headers]
    width = max(map(len, layouts), default=0)
    cells = [f"_{i}" for i in range(width)]
    raw = spark.read.csv(
        paths,
        schema=StructType([StructField(cell, StringType()) for cell in cells]),
        header=True,
        recursiveFileLookup=True,
        escape='"',
        multiLine=multiline,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        nullValue=NO_VALUE,
        emptyValue="",
    )
    file = F.col("_metadata.file_path")
    extra = {name: folder_value(file, name) for name in folder_names(row["file"] for row in headers)}
    if position:
        extra[POSITION] = _place()
    known = {name.lower() for layout in layouts for name in layout}
    extra = {name: value for name, value in extra.items() if name.lower() not in known}
    rows = raw.select("*", *[value.alias(name) for name, value in extra.items()], F.xxhash64(file).alias("_file"))
    if len(headers) > 1:
        main = max(range(len(headers)), key=lambda i: headers[i]["n"])
        numbers = _header_numbers(files, [row["header"] for row in headers], main)
        rows = lookup_join(rows, numbers, {"_file": "hash"})
        number = F.coalesce("header_no", F.lit(main))
    else:
        number = F.lit(0)
    return rows.select(*[c.alias(name) for name, c in _by_name(layouts, number).items()], *extra)


def _header_numbers(files: DataFrame, headers: list[str], main: int) -> DataFrame:
    """``hash`` of each file that does not have the main header, and the number of the header it has."""
    known = files.sparkSession.createDataFrame(list(enumerate(headers)), "header_no int, text string")
    numbered = lookup_join(files, known, {"header": "text"}, "inner")
    number = F.max("header_no")
    clash = F.raise_error(F.lit("two files of different headers share a hash: read them by themselves")).cast("int")
    checked = F.when(F.min("header_no") == number, number).otherwise(clash)
    by_hash = numbered.groupBy(F.xxhash64("file").alias("hash")).agg(checked.alias("header_no"))
    return by_hash.where(F.col("header_no") != main)


def _by_name(layouts: list[list[str]], number: Column) -> dict[str, Column]:
    """Every column of any header, from the place where a row's header has it."""
    named: dict[str, tuple[str, dict[int, list[int]]]] = {}
    for i, layout in enumerate(layouts):
        for place, name in enumerate(layout):
            named.setdefault(name.lower(), (name, {}))[1].setdefault(place, []).append(i)
    columns = {}
    for name, places in named.values():
        if [*places.values()] == [list(range(len(layouts)))]:
            columns[name] = F.col(f"_{next(iter(places))}")
            continue
        value = F.lit(None).cast("string")
        for place, which in places.items():
            value = F.when(number.isin(which), F.col(f"_{place}")).otherwise(value)
        columns[name] = value
    return columns


def folder_names(files: Iterable[str]) -> list[str]:
    """Names of the parts ``name=value`` that the paths of all files have."""
    found = [dict.fromkeys(re.findall("(?<=/)([^/=]+)=[^/]*/", file)) for file in files]
    return [name for name in (found[0] if found else []) if all(name in names for names in found)]


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    position: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """The declared columns of a file, picked by name, whatever its column order.

    ``path`` holds CSV, or Parquet when the name says so. ``position`` adds
    ``_position``, which orders the rows as they stand in the files.
    """
    if path.rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(path)
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
        if position:
            columns.append(_place().alias(POSITION))
    else:
        raw = read_text_columns(spark, path, multiline=multiline, position=position)
        columns = [typed(f.name, f.dataType) for f in schema.fields]
        if position:
            columns.append(F.col(POSITION))
    return raw.select(*columns)


def _place() -> Column:
    """Where a row stands: its file, its part of the file, and its number there."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def scan_flights(spark: SparkSession, path: str) -> DataFrame:
    """The enriched flight file, 29 columns."""
    return read_table(spark, path, FLIGHTS)


def scan_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather, 7 columns, under their delivered names."""
    return read_table(spark, path, WEATHER)


def scan_whitelist(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, WHITELIST, multiline=True)


def scan_carriers(spark: SparkSession, path: str) -> DataFrame:
    """Carrier codes in file order, since the last entry of a code counts."""
    return read_table(spark, path, CARRIERS, position=True, multiline=True)


def scan_airports(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, AIRPORTS, multiline=True)


def year_paths(spark: SparkSession, directory: str, start_year: int) -> dict[int, list[str]]:
    """Files or folders named ``<year>.<anything>`` or ``year=<year>``, by year, from a year on."""
    kept = {}
    for path in children(spark, directory):
        stem = path.rstrip("/").rsplit("/", 1)[-1].split(".")[0].removeprefix("year=")
        if stem.isdecimal() and int(stem) >= start_year:
            kept.setdefault(int(stem), []).append(path)
    if not kept:
        raise ValueError(f"no file from {start_year} on in {directory}")
    return kept


def scan_years(
    spark: SparkSession,
    directory: str,
    start_year: int = 2018,
    schema: StructType = RAW_FLIGHTS,
) -> DataFrame:
    """Rows of all yearly files from ``start_year`` on.

    Earlier files are never opened. Each file is read under its own header, so
    column order may differ by year; a column a year lacks is null there.
    """
    years = year_paths(spark, directory, start_year)
    return scan_paths(spark, [path for paths in years.values() for path in paths], schema)


def scan_paths(spark: SparkSession, paths: list[str], schema: StructType = RAW_FLIGHTS) -> DataFrame:
    """Rows of CSV files and folders, each file under its own header."""
    raw = read_text_columns(spark, paths)
    return raw.select([typed(f.name, f.dataType) for f in schema.fields])
