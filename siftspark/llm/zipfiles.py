"""ZIP packages of stored members, read by range through their central directory.

Only what range reads need: the end record and its ZIP64 form, the central directory with
ZIP64 extra fields, and local headers to find where a stored member's bytes begin. Written
packages stream: sizes follow the data in descriptors, and the directory is always ZIP64.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

# Fixed values of the ZIP format: signatures, record layouts and flags.
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64, DESCRIPTOR = b"PK\x06\x06", b"PK\x06\x07", b"PK\x07\x08"
LOCAL_FORM = struct.Struct("<4sHHHHHIIIHH")
CENTRAL_FORM = struct.Struct("<4sHHHHHHIIIHHHHHII")
END_FORM = struct.Struct("<4sHHHHIIH")
END64_FORM = struct.Struct("<4sQHHIIQQQQ")
LOCATOR_FORM = struct.Struct("<4sIQI")
ZIP64_EXTRA, STREAMED, UTF8, FULL = 1, 1 << 3, 1 << 11, 0xFFFFFFFF
DAY_ONE = 0x21  # 1980-01-01
MAX_COMMENT = 0xFFFF


@dataclass
class Member:
    name: str
    method: int
    size: int
    stored: int
    header_at: int
    crc: int


class Writer:
    """Writes stored members to a stream that can't seek."""

    def __init__(self, stream):
        self.stream, self.at, self.members = stream, 0, []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append(Member(name, 0, 0, 0, self.at, 0))
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)
        head = LOCAL_FORM.pack(
            LOCAL, 45, STREAMED | UTF8, 0, 0, DAY_ONE, 0, FULL, FULL, len(raw), len(extra)
        )
        self._put(head + raw + extra)

    def write(self, data: bytes) -> int:
        """Append to the open member; the offset of the data within it."""
        member = self.members[-1]
        offset = member.size
        member.size += len(data)
        member.crc = zlib.crc32(data, member.crc)
        self._put(data)
        return offset

    def end(self) -> None:
        m = self.members[-1]
        m.stored = m.size
        self._put(DESCRIPTOR + struct.pack("<IQQ", m.crc, m.size, m.size))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            raw = m.name.encode()
            extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, m.size, m.size, m.header_at)
            head = CENTRAL_FORM.pack(
                CENTRAL, 45, 45, STREAMED | UTF8, 0, 0, DAY_ONE, m.crc, FULL, FULL,
                len(raw), len(extra), 0, 0, 0, 0, FULL,
            )
            self._put(head + raw + extra)
        size, n, end64 = self.at - start, len(self.members), self.at
        self._put(END64_FORM.pack(END64, END64_FORM.size - 12, 45, 45, 0, 0, n, n, size, start))
        self._put(LOCATOR_FORM.pack(LOCATOR64, 0, end64, 1))
        self._put(END_FORM.pack(END, 0, 0, 0xFFFF, 0xFFFF, FULL, FULL, 0))


def read_range(file, offset: int, length: int) -> bytes:
    data = file.read_at(length, offset)
    data = bytes(data)
    if len(data) < length:
        raise ValueError(f"package ends at {offset + len(data)}, {length} bytes wanted at {offset}")
    return data


def _directory(file, size: int) -> tuple[int, int]:
    """Where the central directory begins, and its length."""
    tail_at = max(0, size - END_FORM.size - MAX_COMMENT)
    tail = read_range(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0:
        fields = END_FORM.unpack_from(tail, at) if at + END_FORM.size <= len(tail) else None
        if fields and at + END_FORM.size + fields[7] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    else:
        raise ValueError("no end record: not a ZIP package")
    length, start = fields[5], fields[6]
    locator_at = tail_at + at - LOCATOR_FORM.size
    if locator_at >= 0:
        mark, _, end64, _ = LOCATOR_FORM.unpack(read_range(file, locator_at, LOCATOR_FORM.size))
        if mark == LOCATOR64:
            found = END64_FORM.unpack(read_range(file, end64, END64_FORM.size))
            if found[0] != END64:
                raise ValueError("ZIP64 end record expected")
            length, start = found[8], found[9]
    return start, length


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset, those that are all ones taken from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if v == FULL else v for v in values]
        at += 4 + length
    return values


def members(file, size: int) -> Iterator[Member]:
    start, length = _directory(file, size)
    data, at = read_range(file, start, length), 0
    while at < length:
        head = CENTRAL_FORM.unpack_from(data, at)
        if head[0] != CENTRAL:
            raise ValueError(f"directory entry expected at {start + at}")
        n_name, n_extra, n_comment = head[10:13]
        at += CENTRAL_FORM.size
        name, extra = data[at : at + n_name], data[at + n_name : at + n_name + n_extra]
        stored, whole, header_at = _wide_fields(extra, head)
        at += n_name + n_extra + n_comment
        yield Member(name.decode("utf-8", "replace"), head[4], whole, stored, header_at, head[7])


def _wide_fields(extra: bytes, head: tuple) -> tuple[int, int, int]:
    # In the extra field the whole size comes first, then the stored size, then the offset.
    whole, stored, header_at = _wide(extra, [head[9], head[8], head[16]])
    return stored, whole, header_at


def data_offset(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed: it can't be read by range")
    head = LOCAL_FORM.unpack(read_range(file, member.header_at, LOCAL_FORM.size))
    if head[0] != LOCAL:
        raise ValueError(f"local header of {member.name} expected at {member.header_at}")
    return member.header_at + LOCAL_FORM.size + head[9] + head[10]
