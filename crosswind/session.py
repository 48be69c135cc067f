"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# AQE picks join sides and partition counts at run time and splits partitions
# that stay too large; the shuffle partition count is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(app: str = "crosswind", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str = "data") -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a temporary folder of this machine;
    on a cluster the executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="crosswind-")
    return f"{base.rstrip('/')}/crosswind-{uuid.uuid4().hex}/{name}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """The same rows read back from a table written to the shared scratch folder.

    Cuts the lineage of iterative work; an executor lost later costs no more
    than reading the files again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def file_scheme(spark: SparkSession, path: str) -> str:
    """The kind of file system a path is on, the session's own where the path does not say."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()


def qualified_path(spark: SparkSession, path: str) -> str:
    """A path with its file system, as files below it are named."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def children(spark: SparkSession, directory: str) -> list[str]:
    """Paths directly inside a folder, hidden ones left out, in name order."""
    target = spark._jvm.org.apache.hadoop.fs.Path(directory)
    statuses = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    paths = [status.getPath().toString() for status in statuses]
    return sorted(p for p in paths if p.rsplit("/", 1)[-1][0] not in "._")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """The data files at or below a path: ``path, length, modified``; no file is opened."""
    listed = spark.read.format("binaryFile").load(path, recursiveFileLookup=True)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def files_mark(spark: SparkSession, path: str) -> str:
    """What tells the data files at or below a path from others: number, bytes, and a digest of names, sizes and times.

    One aggregate over Spark's listing, whatever the number of files; no file is opened.
    """
    digest = F.xxhash64("path", "length", "modified")
    row = listed_files(spark, path).agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.bit_xor(digest), F.sum(digest.cast("decimal(38,0)"))
    ).first()
    return " ".join(map(str, (path, *row)))


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, null if there is none."""
    if not path_exists(spark, path):
        return None
    reader = _reader(spark, path)
    lines = list(iter(reader.readLine, None))
    reader.close()
    return "\n".join(lines)


def _reader(spark: SparkSession, path: str):
    java, hadoop = spark._jvm.java, spark._jvm.org.apache.hadoop
    target, conf = hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    stream = target.getFileSystem(conf).open(target)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    stream = codec.createInputStream(stream) if codec else stream
    return java.io.BufferedReader(java.io.InputStreamReader(stream, "UTF-8"))
