"""WARC records in ZIP archives of stored members: writer, directory parser and range reader.

An archive holds two members, both stored without ZIP compression: ``archive/data.warc.gz``, where every
record is a gzip member of its own, and ``indexes/index.cdx``, one line per record with its place in the
first. Sizes and offsets beyond 32 bits go to ZIP64 fields. A reader needs the tail of the file, the central
directory and the index, and then reads single records by byte range; nothing is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sha1: str) -> bytes:
    """A response record, or a revisit record without its payload, as one gzip member."""
    kind = "response" if refers_to is None else "revisit"
    name = "none" if page_id is None else str(page_id)
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{sha1}"), ("Payload-Length", str(len(payload))),
        ("Content-Type", "text/html"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    block = payload if refers_to is None else b""
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 5, mtime=0)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one gzip member."""
    head, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(fields["Content-Length"])
    if len(rest) != n + 4:
        raise ValueError("a WARC record is cut short")
    return fields, rest[:n]


class Writer:
    """Streams records into one archive on a forward-only file; the index is held, a line per record."""

    def __init__(self, out: BinaryIO, zip64_from: int = _MAX32):
        self.out, self.limit, self.at, self.members = out, zip64_from, 0, []
        self.index: list[bytes] = []
        self._begin(DATA)

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def _begin(self, name: str) -> None:
        # sizes follow in the central directory, the local header leaves them to a data descriptor
        self.members.append([name, self.at, 0, 0])
        raw = name.encode()
        self._write(_LOCAL + struct.pack("<5H3I2H", 45, 0x0808, 0, 0, 0x21, 0, _MAX32, _MAX32, len(raw), 20) + raw + struct.pack("<2H2Q", 1, 16, 0, 0))

    def _part(self, raw: bytes) -> None:
        self.members[-1][2] = zlib.crc32(raw, self.members[-1][2])
        self.members[-1][3] += len(raw)
        self._write(raw)

    def _end(self) -> None:
        _, _, crc, size = self.members[-1]
        self._write(b"PK\x07\x08" + struct.pack("<I2Q", crc, size, size))

    def add(self, raw: bytes) -> None:
        self.index.append(b"%d %d\n" % (self.members[-1][3], len(raw)))
        self._part(raw)

    def close(self) -> int:
        """Writes index and directory; the size of the archive."""
        self._end()
        self._begin(INDEX)
        self._part(b"".join(self.index))
        self._end()
        start = self.at
        for name, offset, crc, size in self.members:
            big = [x for x in (size, size, offset) if x >= self.limit]
            extra = struct.pack(f"<2H{len(big)}Q", 1, 8 * len(big), *big) if big else b""
            small = [_MAX32 if x >= self.limit else x for x in (size, size, offset)]
            raw = name.encode()
            self._write(_CENTRAL + struct.pack("<6H3I5H2I", 45, 45, 0x0808, 0, 0, 0x21, crc, small[0], small[1], len(raw), len(extra), 0, 0, 0, 0, small[2]) + raw + extra)
        length, n = self.at - start, len(self.members)
        if max(start, length) >= self.limit:
            end64 = self.at
            self._write(_END64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, n, n, length, start))
            self._write(_LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        self._write(_END + struct.pack("<4H2IH", 0, 0, n, n, min(length, _MAX32) if length < self.limit else _MAX32, start if start < self.limit else _MAX32, 0))
        return self.at


def _range(file: BinaryIO, at: int, n: int) -> bytes:
    file.seek(at)
    raw = file.read(n)
    if len(raw) != n:
        raise ValueError("the archive is cut short")
    return raw


def members(file: BinaryIO, size: int) -> dict[str, tuple[int, int]]:
    """Offset of the data and size of each stored member, from the central directory."""
    tail_at = max(0, size - 22 - _MAX16)
    tail = _range(file, tail_at, size - tail_at)
    end = tail.rfind(_END)
    if end < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    locator = tail_at + end - 20
    if (n == _MAX16 or length == _MAX32 or start == _MAX32) and locator >= 0:
        raw = _range(file, locator, 20)
        if raw[:4] == _LOCATOR64:
            (at,) = struct.unpack("<Q", raw[8:16])
            end64 = _range(file, at, 56)
            if end64[:4] != _END64:
                raise ValueError("no ZIP64 end of central directory")
            n, length, start = struct.unpack("<3Q", end64[32:56])
    directory, at, found = _range(file, start, length), 0, {}
    for _ in range(n):
        if directory[at : at + 4] != _CENTRAL:
            raise ValueError("the central directory is broken")
        method, = struct.unpack("<H", directory[at + 10 : at + 12])
        packed, plain, name_n, extra_n, note_n = struct.unpack("<2I3H", directory[at + 20 : at + 34])
        (offset,) = struct.unpack("<I", directory[at + 42 : at + 46])
        name = directory[at + 46 : at + 46 + name_n].decode()
        extra = directory[at + 46 + name_n : at + 46 + name_n + extra_n]
        values, spot = [plain, packed, offset], 0
        while spot + 4 <= len(extra):
            tag, k = struct.unpack("<2H", extra[spot : spot + 4])
            if tag == 1:
                wide = iter(struct.unpack(f"<{k // 8}Q", extra[spot + 4 : spot + 4 + k // 8 * 8]))
                values = [next(wide) if v == _MAX32 else v for v in values]
            spot += 4 + k
        if method == 0:
            local = _range(file, values[2], 30)
            found[name] = (values[2] + 30 + sum(struct.unpack("<2H", local[26:30])), values[1])
        at += 46 + name_n + extra_n + note_n
    return found


def index_lines(file: BinaryIO, size: int) -> Iterator[tuple[int, int]]:
    """Place in the file and length of every record, from the archive's index."""
    found = members(file, size)
    base, (at, n) = found[DATA][0], found[INDEX]
    for line in _range(file, at, n).splitlines():
        offset, length = line.split()
        yield base + int(offset), int(length)


def read_at(file: BinaryIO, at: int, n: int) -> tuple[dict[str, str], bytes]:
    return parse_record(_range(file, at, n))
