"""File writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from crosswind.session import children, delete_path, path_exists, read_note, write_note


def write_csv(
    df: DataFrame,
    path: str,
    *,
    partition_by: tuple[str, ...] = (),
    multiline: bool = False,
    mode: str = "overwrite",
) -> None:
    """CSV with header that reads back as it was: blanks, quotes, empty texts and nulls.

    Line breaks inside a text need a reader with ``multiline``; without it here
    they are an error, not rows cut in two.
    """
    if not multiline:
        df = df.withColumns(
            {f.name: _one_line(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)}
        )
    writer = _gathered(df, partition_by).write.partitionBy(*partition_by)
    writer.csv(
        path,
        header=True,
        mode=mode,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def _one_line(name: str) -> Column:
    text = F.col(f"`{name}`")
    broken = F.raise_error(F.lit(f"a line break in {name}: write with multiline"))
    return F.when(text.rlike(r"[\r\n]"), broken.cast("string")).otherwise(text)


def write_parquet(
    df: DataFrame, path: str, *, files: int | None = None, partition_by: tuple[str, ...] = ()
) -> None:
    """Parquet, one file per task, or exactly ``files`` files, or folders by value.

    A set number costs a shuffle but leaves the work before it in parallel; one
    single file is meant for small results only.
    """
    df = df.repartition(files) if files else _gathered(df, partition_by)
    df.write.partitionBy(*partition_by).mode("overwrite").parquet(path)


def _gathered(df: DataFrame, folders: tuple[str, ...]) -> DataFrame:
    """Rows of a folder brought together, in even pieces however large it gets."""
    return df.hint("rebalance", *map(F.col, folders)) if folders else df


def write_counted(df: DataFrame, path: str, *, files: int | None = None) -> int:
    """Parquet, in ``files`` files if given, and the number of rows written, from the same run."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("n")), path, files=files)
    return seen.get["n"]


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """Distinct values of a column as text, one per line."""
    lines = df.select(F.col(column).cast("string").alias("value")).dropna().distinct()
    lines.write.mode("overwrite").text(path)


def failure_lines(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order, each but the last followed by a comma.

    The lines together read as one comma-separated list, yet no task ever holds
    more than its own share of them.
    """
    values = df.select(F.col(column).cast("string").alias("value")).dropna().distinct()
    last = values.agg(F.max("value").alias("last")).scalar()
    comma = F.when(F.col("value") == last, "").otherwise(",")
    return values.orderBy("value").select(F.concat("value", comma).alias("value"))


def write_failure_list(df: DataFrame, column: str, path: str) -> None:
    failure_lines(df, column).write.mode("overwrite").text(path)


def load_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], *, recipe: str = ""
) -> DataFrame:
    """The dataset at a path, built and written first if it is not there.

    A finished write leaves a ``_SUCCESS`` file; without it the data is built
    again, so a job that died half way does not pass for done. ``recipe`` says
    what the data is made of; it is kept beside the data, which is built anew
    when the recipe is another.
    """
    note = f"{path}/_recipe"
    done = path_exists(spark, f"{path}/_SUCCESS")
    if not done or (recipe and read_note(spark, note) != recipe):
        write_parquet(build(), path)
        write_note(spark, note, recipe)
    return spark.read.parquet(path)


def load_or_build_parts(
    spark: SparkSession,
    path: str,
    parts: dict[str, tuple[str, Callable[[], DataFrame]]],
    *,
    name: str = "part",
) -> DataFrame:
    """The rows of all parts, each a folder ``name=part`` that is built only if it is not there.

    ``parts`` has a recipe and a way to build for each. A part is kept as
    ``load_or_build`` keeps a dataset, so one that is new or made of something
    else is written, and the others are left as they are. Whatever else is at the
    path is deleted, as an overwrite would do. Parts are built one after the
    other, so they should be few and large, such as years; all must have the
    same columns, and ``name`` is not one of them.
    """
    if not parts:
        raise ValueError("there must be a part to say what the columns are")
    folders = {f"{name}={part}": how for part, how in parts.items()}
    for folder, (recipe, build) in folders.items():
        load_or_build(spark, f"{path}/{folder}", build, recipe=recipe)
    for found in children(spark, path):
        if found.rstrip("/").rsplit("/", 1)[-1] not in folders:
            delete_path(spark, found)
    return spark.read.parquet(*[f"{path}/{folder}" for folder in folders])
