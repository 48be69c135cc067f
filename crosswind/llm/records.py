"""Token ids in length-delimited binary records, with an offset index beside them.

A record is one frame followed by a line feed, all numbers little-endian::

    length of the body, 8 bytes | masked checksum of those 8 bytes, 4 bytes
    body | masked checksum of the body, 4 bytes

The body is one byte of flags (1: the document has an id; 2: ids take four
bytes, else two), the document's id in 8 bytes, then the token ids. Checksums
are CRC-32, turned by 15 bits and shifted by a constant, so that a checksum
stored inside checked data does not cancel out. Frames stand in ascending order
of document id, over as many files as the text needs.

Nulls: a null text is an empty one, so its record holds the end id alone; null
document ids come first and stay null. Rows that repeat each get a record. An
empty table gives no record. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosswind.llm.common import lookup, ship, slices, text_bytes
from crosswind.llm.tokens import default_tokenizer, task_ids

HEAD = 12
TAIL = 4
BODY = 9
HAS_ID, WIDE = 1, 2
# Text bytes that go into one file, about.
FILE_BYTES = 16 * 1024 * 1024

INDEX = "file int, record long, offset long, length long, doc_id long, first long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    return ((((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF).to_bytes(4, "little")


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """One record from ids given as unsigned 32-bit numbers."""
    numbers = np.frombuffer(ids, "<u4")
    wide = bool(len(numbers)) and int(numbers.max()) > 0xFFFF
    flags = HAS_ID * (doc_id is not None) | WIDE * wide
    body = (
        bytes([flags])
        + (doc_id or 0).to_bytes(8, "little", signed=True)
        + (ids if wide else numbers.astype("<u2").tobytes())
    )
    length = len(body).to_bytes(8, "little")
    return length + masked(length) + body + masked(body)


def unframe(data, offset: int) -> tuple[int | None, np.ndarray, int]:
    """Document id, token ids and end of the record at an offset; raises if it is damaged."""
    view = memoryview(data).cast("B")
    length = bytes(view[offset : offset + 8])
    if len(length) < 8 or masked(length) != view[offset + 8 : offset + HEAD]:
        raise ValueError(f"damaged length at offset {offset}")
    start = offset + HEAD
    stop = start + int.from_bytes(length, "little")
    body = view[start:stop]
    if len(view) < stop + TAIL or masked(body) != view[stop : stop + TAIL]:
        raise ValueError(f"damaged record at offset {offset}")
    doc_id = int.from_bytes(body[1:BODY], "little", signed=True) if body[0] & HAS_ID else None
    ids = np.frombuffer(body[BODY:], "<u4" if body[0] & WIDE else "<u2").astype("<u4")
    return doc_id, ids, stop + TAIL + 1


def write_records(
    docs: DataFrame,
    path: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Tokenize every text and write the frames in ascending order of id.

    Documents are dealt to files by ranges of their id, equal ids by a hash of
    the text, so one id that many rows share fills several files.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = tokenizer or default_tokenizer()
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").alias("h"), F.length("text")]
    ordered = rows.repartitionByRange(1 + size // file_bytes, *order).sortWithinPartitions(*order)

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_ids(vocabulary) as words:
            for batch in slices(stream):
                doc_ids = batch.column(0).to_pylist()
                texts = text_bytes(batch.column(1))
                frames = [frame(d, words.ids(t, end_id)) for d, t in zip(doc_ids, texts)]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])

    # Bytes pass through the text writer as they are.
    framed = ordered.mapInArrow(encode, "value binary")
    framed.select(F.col("value").cast("string").alias("value")).write.text(path)


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files with their number, which gives their order."""
    files = spark.read.format("binaryFile").load(path)
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    return files.select(number.alias("file"), "content")


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record read back and checked: place, id, tokens before it in its file, digest."""
    ship(spark)

    def scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), *[pa.int64()] * 7]
        names = re.findall(r"(\w+) (?:int|long)", INDEX)
        for batch in stream:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                rows, offset, first = [], 0, 0
                while offset < data.size:
                    doc_id, ids, end = unframe(data, offset)
                    place = (number, len(rows), offset, end - offset)
                    rows.append((*place, doc_id, first, len(ids), zlib.crc32(ids.tobytes())))
                    offset, first = end, first + len(ids)
                columns = list(zip(*rows)) or [[]] * len(names)
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return stored_files(spark, path).mapInArrow(scan, INDEX)


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """The offset index of written records, as a table of its own, and read back."""
    scan_records(spark, path).write.parquet(index_path)
    return spark.read.parquet(index_path)


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """Records with ``start``: the token ids of all documents before them.

    One row a file goes through the running sum, not one a document.
    """
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("_n"), F.count(F.lit(1)).alias("_r"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = lookup(records, starts, ["file"], rows=totals.count())
    return joined.withColumn("start", F.col("_start") + F.col("first")).drop("_start")


def read_shuffled(
    spark: SparkSession, path: str, index: DataFrame, *, seed: int, part: int = 0, parts: int = 1
) -> DataFrame:
    """One part of all records in a seeded random order: ``place, doc_id, ids``.

    The part's offsets are taken from the index, so each file is opened once and
    only the wanted records in it are decoded.
    """
    ship(spark)
    place = F.xxhash64(F.lit(seed), "file", "record")
    wanted = index.select("file", "offset", place.alias("place")).where(
        F.pmod("place", F.lit(parts)) == part
    )
    by_file = wanted.groupBy("file").agg(F.collect_list(F.struct("offset", "place")).alias("wanted"))
    files = stored_files(spark, path).join(by_file, "file").select("content", "wanted")

    def pick(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for content, wanted in zip(batch.column(0), batch.column(1)):
                data, rows = content.as_buffer(), []
                for item in wanted.as_py():
                    doc_id, ids, _ = unframe(data, item["offset"])
                    rows.append((item["place"], doc_id, ids.astype("i8")))
                places, doc_ids, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(places, pa.int64()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(ids, pa.list_(pa.int64())),
                    ],
                    ["place", "doc_id", "ids"],
                )

    return files.mapInArrow(pick, "place long, doc_id long, ids array<long>").orderBy("place")
