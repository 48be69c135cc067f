"""Pages in web archives packed as ZIP, and their records read back by ranges.

Every task writes one package: ``archive/data.warc.gz`` (one gzip member a
record), ``indexes/index.cdxj`` (one line a record with its offset and length),
``pages/pages.jsonl`` and ``datapackage.json``, all stored as they are. A reader
goes from the end of a package over its ZIP and ZIP64 directories to the index
and reads the ranges of records it wants; no member is extracted.

Of records with equal payloads of at least ``least`` bytes the one with the
largest id is a response (of equal ids any one), the others revisit it: they
hold the headers alone, with the length and digest of the whole payload.

Nulls: a null payload is an empty one, a null address an empty one; null ids
are smallest and stay null. Rows that repeat each get a record. An empty table
gives no package. Columns other than id, address and payload are not looked at.
In addresses, characters that a header cannot hold are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosswind.llm import zips
from crosswind.llm.common import byte_slices, ship, text_bytes
from crosswind.operators.joins import BROADCAST_BYTES, lookup_join
from crosswind.session import settle

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PAGES, MANIFEST = "pages/pages.jsonl", "datapackage.json"
DATE = "2024-01-01T00:00:00Z"
# Fixed value: names the kind of revisit.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes that a row for the text writer holds, and that a reader asks for at once.
CHUNK = 1 << 20
# Bytes of a package that one reading task takes.
SLICE = 32 << 20

RECORDS = (
    "package string, offset long, length long, id string, url string, kind string, "
    "payload_bytes long, payload_digest string, refers_to string, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    fields = {"WARC-Type": kind} | headers | {"Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, names in lower case, and block of a record."""
    plain = gzip.decompress(data)
    version, fields, rest = headers_of(plain)
    block = rest[: int(fields["content-length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("damaged record")
    return fields, block


def headers_of(data: bytes) -> tuple[str, dict[str, str], bytes]:
    """First line, headers and what follows them."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return first, {name.lower(): value.strip() for name, _, value in pairs}, rest


def urn(page: str | None, row: int) -> str:
    """Name of a record: its page's id and its row, which tells repeated pages apart."""
    return f"<urn:page:{'-' if page is None else quote(page, safe='').replace('-', '%2D')}:{row}>"


def page_of(name: str) -> str | None:
    page = name.split(":")[2]
    return None if page == "-" else unquote(page)


def header_safe(url: str) -> str:
    return quote(url, safe="".join(map(chr, range(33, 127))))


def sort_key(url: str) -> str:
    """The address in the order of an index: host parts reversed, then path and query."""
    try:
        parts = urlsplit(url.lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def page_record(page: str | None, row: int, url: str, payload: bytes, digest: str, target: str | None, date: str) -> bytes:
    """The response of a page, or its revisit of the record ``target``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = {
        "WARC-Record-ID": urn(page, row),
        "WARC-Date": date,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response",
    }
    if target is None:
        return record("response", headers, http.encode() + payload)
    revisit = {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": target}
    return record("revisit", headers | revisit, http.encode())


class PagePackage:
    """The bytes of one package, and the index lines that its records give."""

    def __init__(self, date: str) -> None:
        self.package, self.date = zips.Package(), date
        self.index: list[str] = []
        self.pages = [json.dumps({"format": "json-pages-1.0", "id": "pages", "title": "Pages"})]
        self.hash = hashlib.sha256()

    def open(self) -> bytes:
        info = b"software: crosswind\r\nformat: WARC File Format 1.1\r\n"
        headers = {"WARC-Record-ID": "<urn:package:info>", "WARC-Date": self.date, "Content-Type": "application/warc-fields"}
        return self.package.open_member(DATA) + self._record(record("warcinfo", headers, info))

    def _record(self, data: bytes) -> bytes:
        self.hash.update(data)
        return self.package.data(data)

    def add(self, page, row: int, url: str, payload: bytes, digest: str, target: str | None) -> bytes:
        offset, url = self.package.size, header_safe(url)
        data = page_record(page, row, url, payload, digest, target, self.date)
        entry = {
            "url": url,
            "mime": "warc/revisit" if target else "text/html",
            "status": "200",
            "digest": f"sha1:{digest}",
            "length": str(len(data)),
            "offset": str(offset),
            "filename": DATA.rsplit("/", 1)[-1],
        }
        stamp = re.sub("[^0-9]", "", self.date)
        self.index.append(f"{header_safe(sort_key(url))} {stamp} {json.dumps(entry)}")
        self.pages.append(json.dumps({"id": urn(page, row), "url": url, "ts": self.date}))
        return self._record(data)

    def close(self) -> Iterator[bytes]:
        yield self.package.close_member()
        resources = [{"name": "data.warc.gz", "path": DATA, "hash": f"sha256:{self.hash.hexdigest()}", "bytes": self.package.size}]
        for path, lines in ((INDEX, sorted(self.index)), (PAGES, self.pages)):
            data = "".join(f"{line}\n" for line in lines).encode()
            resources.append({"name": path.rsplit("/", 1)[-1], "path": path, "hash": f"sha256:{hashlib.sha256(data).hexdigest()}", "bytes": len(data)})
            yield self.package.open_member(path) + self.package.data(data) + self.package.close_member()
        manifest = {"profile": "data-package", "wacz_version": "1.1.1", "created": self.date, "resources": resources}
        data = json.dumps(manifest, indent=1).encode()
        yield self.package.open_member(MANIFEST) + self.package.data(data) + self.package.close_member()
        # The last byte is a line feed, as the text writer ends every row with one.
        yield self.package.end(b"\n")


def rows_of(stream: Iterator[bytes], size: int = CHUNK) -> Iterator[bytes]:
    """A stream of bytes that ends in a line feed, cut at line feeds, which the text writer puts back."""
    held, count = [], 0
    for data in stream:
        cut = data.rfind(b"\n") if count + len(data) >= size else -1
        if cut < 0:
            held.append(data)
            count += len(data)
            continue
        yield b"".join([*held, data[:cut]])
        held, count = [data[cut + 1 :]], len(data) - cut - 1
    rest = b"".join(held)
    if rest:
        yield rest[:-1]


def with_digests(pages: DataFrame, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    """Rows ``id``, ``url``, ``payload`` and ``digest``, whatever else the table holds."""
    chosen = pages.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(url_column).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
    )
    digest = F.base64(F.unhex(F.sha1(F.encode("payload", "UTF-8"))))
    return chosen.withColumn("digest", digest)


def decided(pages: DataFrame, least: int, limit: int) -> DataFrame:
    """Settled rows with ``target``, the row and id of the response they revisit.

    Only payloads that occur more than once are looked up; a payload that very
    many pages share counts map-side, and its pages are split should the lookup
    need a shuffle.
    """
    big = F.octet_length("payload") >= least
    response = F.max(F.struct("id", "row")).alias("target")
    counted = pages.where(big).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), response)
    firsts = settle(counted.where("n > 1").select(F.col("digest").alias("same"), "target"), "responses")
    found = lookup_join(pages.withColumn("key", F.when(big, F.col("digest"))), firsts, {"key": "same"}, limit=limit)
    return found.withColumn("target", F.when(F.col("target.row") != F.col("row"), F.col("target")))


def write_packages(
    pages: DataFrame,
    path: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    least: int = 0,
    date: str = DATE,
    limit: int = BROADCAST_BYTES,
) -> None:
    """Write every page's record, in one package a task."""
    ship(pages.sparkSession)
    rows = with_digests(pages, id_column, url_column, payload_column)
    # The row's number tells repeated pages apart; once written it does not change.
    numbered = settle(rows.withColumn("row", F.monotonically_increasing_id()), "pages")
    records = decided(numbered, least, limit).select(
        F.col("id").cast("string").alias("id"),
        "row",
        "url",
        "digest",
        F.col("target.id").cast("string").alias("target_id"),
        F.col("target.row").alias("target_row"),
        "payload",
    )

    def packed(stream: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        package = None
        for batch in byte_slices(stream):
            columns = [column.to_pylist() for column in batch.columns[:-1]]
            for id_, row, url, digest, target, target_row, payload in zip(*columns, text_bytes(batch.columns[-1])):
                if package is None:
                    package = PagePackage(date)
                    yield package.open()
                digest = base64.b32encode(base64.b64decode(digest)).decode()
                yield package.add(id_, row, url, payload, digest, None if target_row is None else urn(target, target_row))
        if package is not None:
            yield from package.close()

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in rows_of(packed(stream)):
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

    # Bytes pass through the text writer as they are.
    lines = records.mapInArrow(write, "value binary")
    lines.select(F.col("value").cast("string").alias("value")).write.text(path)


def index_of(source) -> list[tuple[int, int]]:
    """Offset and length, within the package, of every record that its indexes list, by offset."""
    found = zips.members(source)
    starts, places = {}, []
    for name, member in found.items():
        if not re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", name):
            continue
        data = zips.whole_member(source, member)
        data = gzip.decompress(data) if name.endswith(".gz") else data
        for line in data.decode().splitlines():
            entry = json.loads(line.split(" ", 2)[2])
            archive = f"archive/{entry['filename']}"
            if archive not in starts:
                starts[archive] = zips.stored_at(source, found[archive]), found[archive].size
            start, size = starts[archive]
            offset, length = int(entry["offset"]), int(entry["length"])
            if offset + length > size:
                raise ValueError(f"the index points behind the end of {archive}")
            places.append((start + offset, length))
    return sorted(places)


def ranges(source, places: list[tuple[int, int]], size: int = CHUNK) -> Iterator[bytes]:
    """The bytes of records in order, records that lie side by side read together."""
    at = 0
    while at < len(places):
        first, stop = places[at][0], at + 1
        end = sum(places[at])
        while stop < len(places) and places[stop][0] == end and sum(places[stop]) - first <= size:
            end = sum(places[stop])
            stop += 1
        block = source.read(first, end - first)
        for offset, length in places[at:stop]:
            yield block[offset - first : offset - first + length]
        at = stop


def read_record(data: bytes, payloads: bool) -> tuple:
    """Fields of ``RECORDS`` from ``id`` on; the payload's digest is checked where there is one."""
    fields, block = parse_record(data)
    kind = fields["warc-type"]
    _, http, payload = headers_of(block)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(http["content-length"])
    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"damaged payload of {fields['warc-record-id']}")
    target = fields.get("warc-refers-to")
    return (
        page_of(fields["warc-record-id"]),
        fields["warc-target-uri"],
        kind,
        length,
        digest,
        target and page_of(target),
        payload if payloads and kind == "response" else None,
    )


def scan_packages(
    spark: SparkSession,
    path: str,
    *,
    payloads: bool = False,
    slice_bytes: int = SLICE,
    ranged: bool | None = None,
) -> DataFrame:
    """Every record that the indexes of the packages list, see ``RECORDS``.

    A large package is read by several tasks, each the records that start in
    its slice. Where workers cannot read by range (``ranged`` false, the default
    for file systems that only Spark knows), Spark reads whole packages, one a
    row, and the same directories are followed within them.
    """
    ship(spark)
    if ranged is None:
        ranged = zips.scheme(path) in zips.REACHED
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    if ranged:
        slices = F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / slice_bytes).cast("int")))
        parts = files.select("path", slices.alias("slice"), F.lit(None).cast("binary").alias("content"))
        parts = parts.repartition(max(1, parts.count()), "path", "slice")
    else:
        parts = files.select("path", F.lit(0).alias("slice"), "content")

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            packages, numbers, contents = batch.columns
            for package, number, content in zip(packages.to_pylist(), numbers.to_pylist(), contents):
                if content.is_valid:
                    source = zips.HeldBytes(content.as_buffer())
                    places = index_of(source)
                else:
                    source = zips.RangedFile(package)
                    places = [p for p in index_of(source) if p[0] // slice_bytes == number]
                yield from batches(package, places, ranges(source, places))
                source.close()

    def batches(package: str, places: list, records: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for place, data in zip(places, records):
            row = read_record(data, payloads)
            rows.append((package, *place, *row))
            held += 256 + len(row[-1] or b"")
            if held >= CHUNK:
                yield as_batch(rows)
                rows, held = [], 0
        if rows:
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        names, types = zip(*[field.split() for field in RECORDS.split(", ")])
        arrays = [pa.array(column, kinds[t]) for column, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, list(names))

    return parts.mapInArrow(read, RECORDS)
