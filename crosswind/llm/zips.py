"""ZIP packages with stored members, written as a stream and read by ranges.

A package is read from its end: end record, the ZIP64 end record if there is
one, central directory, and then only those bytes of a member that are wanted.
Nothing is extracted. Sources give bytes by offset and length; they are files on
any file system that pyarrow reaches, or bytes already at hand.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

# Signatures and marks of the ZIP format.
LOCAL, DESCRIPTOR, CENTRAL = b"PK\x03\x04", b"PK\x07\x08", b"PK\x01\x02"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
STORED, DEFLATED = 0, 8
ENCRYPTED, SIZES_FOLLOW, UTF8 = 1, 1 << 3, 1 << 11
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
VERSION64 = 45
NEW_YEAR_1980 = 0x21

END_BYTES, LOCATOR_BYTES, LOCAL_BYTES = 22, 20, 30
LONGEST_COMMENT = 0xFFFF
# Schemes of paths whose bytes Python workers read by range.
REACHED = ("", "file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


class HeldBytes:
    """A source over bytes at hand."""

    def __init__(self, data) -> None:
        self.data = memoryview(data)
        self.size = len(self.data)

    def read(self, offset: int, length: int) -> bytes:
        return bytes(self.data[offset : offset + length])

    def close(self) -> None:
        self.data.release()


class RangedFile:
    """A source over a file, local or remote, of which only the ranges asked for are read."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        if scheme(path) in ("", "file"):
            system, inner = fs.LocalFileSystem(), "/" + re.sub("^file:", "", path).lstrip("/")
        else:
            system, inner = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))
        self.file = system.open_input_file(inner)
        self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def close(self) -> None:
        self.file.close()


def scheme(path: str) -> str:
    found = re.match("([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else ""


@dataclass
class Member:
    """An entry of the central directory."""

    name: str
    method: int
    flags: int
    crc32: int
    packed: int
    size: int
    header: int


def members(source) -> dict[str, Member]:
    """The members of a package by name, from its directories alone."""
    reach = min(source.size, END_BYTES + LOCATOR_BYTES + LONGEST_COMMENT)
    tail = source.read(source.size - reach, reach)
    at = tail.rfind(END)
    while at >= 0 and not _ends_here(tail, at):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP package: no end record")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (size, start):
        count, size, start = _end64(source, tail[max(0, at - LOCATOR_BYTES) : at], (count, size, start))
    return {m.name: m for m in _central(source.read(start, size), count)}


def _ends_here(tail: bytes, at: int) -> bool:
    """Whether the signature starts an end record: its comment must reach the end of the file."""
    return at + END_BYTES <= len(tail) == at + END_BYTES + struct.unpack_from("<H", tail, at + 20)[0]


def _end64(source, locator: bytes, given: tuple[int, int, int]) -> tuple[int, int, int]:
    """Count, size and place of the central directory, by the ZIP64 end record if there is one."""
    if locator[:4] != LOCATOR64:
        return given
    place = struct.unpack_from("<Q", locator, 8)[0]
    record = source.read(place, 56)
    if record[:4] != END64:
        raise ValueError("damaged ZIP64 end record")
    return struct.unpack_from("<QQQ", record, 32)


def _central(data: bytes, count: int) -> Iterator[Member]:
    at = 0
    for _ in range(count):
        if data[at : at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc32, packed, size, names, extras, comments = struct.unpack_from("<IIIHHH", data, at + 16)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name_end = at + 46 + names
        name = data[at + 46 : name_end].decode("utf-8" if flags & UTF8 else "cp437")
        size, packed, header = _wide(data[name_end : name_end + extras], [size, packed, header])
        yield Member(name, method, flags, crc32, packed, size, header)
        at = name_end + extras + comments


def _wide(extra: bytes, numbers: list[int]) -> list[int]:
    """Sizes and place, those that do not fit 32 bits taken from the ZIP64 field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            full = [i for i, n in enumerate(numbers) if n == FULL32]
            values = struct.unpack_from(f"<{len(full)}Q", extra, at + 4)
            for i, value in zip(full, values):
                numbers[i] = value
        at += 4 + length
    return numbers


def stored_at(source, member: Member) -> int:
    """Offset of a stored member's first byte, whose ranges can then be read as they lie."""
    if member.method != STORED or member.flags & ENCRYPTED:
        raise ValueError(f"{member.name} is not stored as it is")
    return _data_at(source, member)


def _data_at(source, member: Member) -> int:
    head = source.read(member.header, LOCAL_BYTES)
    if head[:4] != LOCAL:
        raise ValueError(f"damaged header of {member.name}")
    names, extras = struct.unpack_from("<HH", head, 26)
    return member.header + LOCAL_BYTES + names + extras


def whole_member(source, member: Member) -> bytes:
    """A small member such as an index, stored or deflated, checked."""
    if member.method not in (STORED, DEFLATED) or member.flags & ENCRYPTED:
        raise ValueError(f"{member.name} is packed in a way that is not read here")
    data = source.read(_data_at(source, member), member.packed)
    if member.method == DEFLATED:
        data = zlib.decompress(data, -15)
    if len(data) != member.size or zlib.crc32(data) != member.crc32:
        raise ValueError(f"damaged member {member.name}")
    return data


class Package:
    """A package written as a stream: every method gives the bytes that come next.

    All sizes and places are in their ZIP64 form, so members and package may
    pass 4 GiB and sizes need not be known before a member's bytes.
    """

    def __init__(self) -> None:
        self.offset = 0
        self.central = b""
        self.count = 0

    def _next(self, data: bytes) -> bytes:
        self.offset += len(data)
        return data

    def open_member(self, name: str) -> bytes:
        self.name, self.header = name.encode(), self.offset
        self.crc32 = self.size = 0
        fields = (VERSION64, SIZES_FOLLOW | UTF8, STORED, 0, NEW_YEAR_1980, 0, FULL32, FULL32)
        head = LOCAL + struct.pack("<HHHHHIIIHH", *fields, len(self.name), 20)
        return self._next(head + self.name + struct.pack("<HHQQ", 1, 16, 0, 0))

    def data(self, data: bytes) -> bytes:
        self.crc32 = zlib.crc32(data, self.crc32)
        self.size += len(data)
        return self._next(data)

    def close_member(self) -> bytes:
        fields = (VERSION64, VERSION64, SIZES_FOLLOW | UTF8, STORED, 0, NEW_YEAR_1980, self.crc32)
        entry = struct.pack("<HHHHHHI", *fields) + struct.pack("<II", FULL32, FULL32)
        entry += struct.pack("<HHHHHII", len(self.name), 28, 0, 0, 0, 0, FULL32)
        extra = struct.pack("<HHQQQ", 1, 24, self.size, self.size, self.header)
        self.central += CENTRAL + entry + self.name + extra
        self.count += 1
        return self._next(DESCRIPTOR + struct.pack("<IQQ", self.crc32, self.size, self.size))

    def end(self, comment: bytes = b"") -> bytes:
        start, size = self.offset, len(self.central)
        end64 = END64 + struct.pack("<QHHII", 44, VERSION64, VERSION64, 0, 0)
        end64 += struct.pack("<QQQQ", self.count, self.count, size, start)
        locator = LOCATOR64 + struct.pack("<IQI", 0, start + size, 1)
        end = END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, len(comment))
        return self._next(self.central + end64 + locator + end + comment)
