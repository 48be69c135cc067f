"""Packed web archives: ZIP directories against the standard library, records against a plain version."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import random
import zipfile
from collections import Counter, defaultdict

import pytest

from crosswind.llm import queries, warc, zips
from crosswind.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, row string, target int, payload string"


def bag(items) -> Counter:
    return Counter(tuple(x) for x in items)


def plain(rows) -> Counter:
    """Contract rows by page, one response for each payload."""
    by_payload = defaultdict(list)
    for page, html in rows:
        by_payload[(html or "").encode()].append(page)
    found = []
    for payload, pages in by_payload.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first, *others = sorted(pages, key=lambda p: (p is not None, p or 0), reverse=True)
        found.append((first, len(payload), digest, "response", None))
        found += [(p, len(payload), digest, "revisit", first) for p in others]
    return bag(found)


def awkward(spark):
    long = "<p>" + "wörd " * 60_000
    texts = ["", None, "a\r\n\r\nb\n", "same", "same", "same", long, long, "é😀\n\n", "\r\n"]
    rows = [(i, f"http://h.org/{i}", t, "d", "r", 7, "p") for i, t in enumerate(texts)]
    rows += [rows[3], rows[5], rows[5], (None, None, "same", None, None, None, None)]
    rows += [(None, "not an address\r\n: {x} é", None, None, None, None, None)] * 2
    rows += [(50, "http://[bad", "one", None, None, None, None), (-3, "", "one", None, None, None, None)]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def scanned(df) -> Counter:
    rows = df.collect()
    return bag(
        (r["id"] and int(r["id"]), r["payload_bytes"], r["payload_digest"], r["kind"], r["refers_to"] and int(r["refers_to"]))
        for r in rows
    )


@pytest.mark.parametrize("limit", [1 << 26, 0])
@pytest.mark.parametrize("ranged", [True, False])
def test_pages_round_trip(spark, limit, ranged):
    pages = awkward(spark)
    path = scratch_path(spark, "packages")
    warc.write_packages(pages, path, limit=limit)
    back = warc.scan_packages(spark, path, payloads=True, slice_bytes=700, ranged=ranged)
    rows = pages.collect()
    assert scanned(back) == plain((r["page_id"], r["html"]) for r in rows)
    kept = {r["payload"] for r in back.where("kind = 'response'").collect()}
    assert {bytes(p) for p in kept} == {(r["html"] or "").encode() for r in rows}


def test_small_payloads_are_all_responses(spark):
    pages, path = awkward(spark), scratch_path(spark, "packages")
    warc.write_packages(pages, path, least=5)
    kinds = warc.scan_packages(spark, path).groupBy("kind").agg({"payload_bytes": "min"}).collect()
    assert dict(map(tuple, kinds)) == {"response": 0, "revisit": len(("<p>" + "wörd " * 60_000).encode())}


def test_no_pages(spark):
    path = scratch_path(spark, "packages")
    warc.write_packages(spark.createDataFrame([], PAGES), path)
    assert warc.scan_packages(spark, path).collect() == []
    assert warc.scan_packages(spark, path, ranged=False).collect() == []


def test_packages_are_zip_files_that_others_read(spark, tmp_path):
    warc.write_packages(awkward(spark), str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len([f for f in files if f.stat().st_size]) > 1
    for file in files:
        if not file.stat().st_size:
            continue
        with zipfile.ZipFile(file) as archive:
            assert archive.testzip() is None
            assert {i.compress_type for i in archive.infolist()} == {zipfile.ZIP_STORED}
            data = archive.read(warc.DATA)
            manifest = json.loads(archive.read(warc.MANIFEST))
            for part in manifest["resources"]:
                held = archive.read(part["path"])
                assert (len(held), f"sha256:{hashlib.sha256(held).hexdigest()}") == (part["bytes"], part["hash"])
            lines = archive.read(warc.INDEX).decode().splitlines()
            assert lines == sorted(lines)
            # Every record ends where the next begins, and the index lists all but the first.
            assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(lines) + 1


def zipped(entries, **kind) -> bytes:
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", allowZip64=True) as archive:
        for name, data, method in entries:
            with archive.open(zipfile.ZipInfo(name), "w", **kind) if method is None else _deflated(archive, name) as out:
                out.write(data)
        archive.comment = b"PK\x05\x06 a comment that looks like an end record"
    return held.getvalue()


def _deflated(archive, name):
    info = zipfile.ZipInfo(name)
    info.compress_type = zipfile.ZIP_DEFLATED
    return archive.open(info, "w")


@pytest.mark.parametrize("wide", [True, False])
def test_directories_of_other_writers(wide):
    """Archives with and without ZIP64 fields, a deflated index, and a comment with a false signature."""
    row = warc.page_record("7", 0, "http://h.org/", b"text", warc.payload_digest(b"text"), None, warc.DATE)
    line = 'org,h)/ 20240101000000 {"offset": "0", "length": "%d", "filename": "x.warc.gz"}\n' % len(row)
    entries = [("archive/x.warc.gz", row, None), ("indexes/é.cdx", line.encode(), zipfile.ZIP_DEFLATED)]
    source = zips.HeldBytes(zipped(entries, force_zip64=wide))
    assert set(zips.members(source)) == {"archive/x.warc.gz", "indexes/é.cdx"}
    (place,) = warc.index_of(source)
    assert warc.read_record(source.read(*place), True)[:5] == ("7", "http://h.org/", "response", 4, warc.payload_digest(b"text"))


def test_sizes_beyond_32_bits():
    """Directories of a package of many GiB, whose bytes are only pretended."""

    class Sparse:
        def __init__(self, parts):
            self.parts, self.size = parts, max(o + len(d) for o, d in parts)

        def read(self, offset, length):
            held = bytearray(min(length, self.size - offset))
            for at, data in self.parts:
                low, high = max(at, offset), min(at + len(data), offset + len(held))
                if low < high:
                    held[low - offset : high - offset] = data[low - at : high - at]
            return bytes(held)

    package, parts = zips.Package(), []
    parts.append((0, package.open_member("archive/a")))
    package.size = package.offset = 5 << 32
    package.close_member()
    parts.append((package.offset, package.open_member("archive/b") + package.data(b"xyz") + package.close_member() + package.end(b"\n")))
    source = Sparse(parts)
    found = zips.members(source)
    assert found["archive/a"].size == 5 << 32 and found["archive/b"].header > 5 << 32
    assert source.read(zips.stored_at(source, found["archive/b"]), 3) == b"xyz"


def test_damage_is_noticed():
    package = zips.Package()
    data = package.open_member("a") + package.data(b"text") + package.close_member() + package.end()
    member = zips.members(zips.HeldBytes(data))["a"]
    changed = data.replace(b"text", b"tent")
    with pytest.raises(ValueError, match="damaged member"):
        zips.whole_member(zips.HeldBytes(changed), member)
    with pytest.raises(ValueError, match="no end record"):
        zips.members(zips.HeldBytes(data[:-1]))
    with pytest.raises(ValueError, match="damaged payload"):
        warc.read_record(warc.page_record("1", 0, "u", b"a", warc.payload_digest(b"b"), None, warc.DATE), False)


@pytest.mark.parametrize("seed", range(5))
def test_rows_are_cut_at_line_feeds_only(seed):
    draw = random.Random(seed)
    stream = [bytes(draw.choices(b"\nab", k=draw.randrange(40))) for _ in range(50)] + [b"\n"]
    assert b"".join(row + b"\n" for row in warc.rows_of(iter(stream), 64)) == b"".join(stream)


def test_given_pages_agree_with_sql(spark):
    import duckdb

    given = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{given}/pages.parquet'")
    name = "op11_packed_archives"
    found = queries.QUERIES[name](spark, given)
    wanted = con.sql(queries.ORACLES[name])
    assert found.columns == wanted.columns
    assert bag(found.collect()) == bag(wanted.fetchall())
