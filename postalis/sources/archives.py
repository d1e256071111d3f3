"""ZIP archives by range: the driver walks over an archive's directory, tasks read the members of their part of it.

A partition is a range of the directory's bytes, so neither an archive's content nor its directory is held anywhere as
a whole, and archives may be larger than a binary value (ZIP64 too). Unsafe members fail the reading.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from postalis.operators.gates import GateError, require_empty
from postalis.sources.store import CHUNK, opened, paths

# Signatures and sizes of the format's records; the ratio of a bomb.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
MOST_RATIO = 100
#: Most bytes of a member, which is a value of a row.
MOST_MEMBER = 1 << 30
#: Bytes of neighbouring members read at once.
SPAN = 8 << 20
ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("bytes", pa.int64()), ("content", pa.binary())])
SCHEMA = "archive string, member string, bytes long, content binary"


@dataclass(frozen=True)
class Member:
    name: str
    flags: int
    method: int
    crc: int
    packed: int
    size: int
    at: int

    @property
    def problem(self) -> str | None:
        if self.name.startswith("/") or "\\" in self.name or ".." in self.name.split("/"):
            return "its path leaves the archive"
        if self.flags & 1:
            return "it is encrypted"
        if self.method not in (0, 8):
            return "it is packed in another way"
        return "its size is a bomb's" if self.size > MOST_RATIO * max(self.packed, 1) else None


def directory(f) -> tuple[int, int, int]:
    """(offset, bytes, members) of an archive's directory, from its end."""
    size = f.size()
    back = min(size, 22 + 65535 + 20)
    f.seek(size - back)
    tail = f.read(back)
    end = tail.rfind(END)
    if end < 0 or len(tail) < end + 22:
        raise GateError("not a ZIP archive, or cut short")
    disks, count, length, offset = struct.unpack_from("<4xHHHHII", tail, end)[1], *struct.unpack_from("<10xHII", tail, end)
    if disks:
        raise GateError("an archive of several files")
    if end >= 20 and tail[end - 20 : end - 16] == LOCATOR64:
        f.seek(struct.unpack_from("<8xQ", tail, end - 20)[0])
        record = f.read(56)
        if record[:4] != END64:
            raise GateError("the archive's end is damaged")
        count, length, offset = struct.unpack_from("<32xQQQ", record)
    if offset + length > size:
        raise GateError("the archive's directory is cut short")
    return offset, length, count


def entries(f, start: int, end: int) -> Iterator[tuple[int, Member]]:
    """(place behind it, member) of the directory's bytes from start to end, a chunk at a time."""
    data, base, at = b"", start, 0
    while base + at < end:
        if len(data) - at < 46 + 3 * 65535 and base + len(data) < end:
            f.seek(base + len(data))
            data, base, at = data[at:] + f.read(min(CHUNK, end - base - len(data))), base + at, 0
        if data[at : at + 4] != ENTRY or len(data) - at < 46:
            raise GateError("the archive's directory is damaged")
        flags, method, crc, packed, size, n, extra, comment, offset = struct.unpack_from("<8xHH4xIIIHHH8xI", data, at)
        name = data[at + 46 : at + 46 + n]
        more, k, wide = data[at + 46 + n : at + 46 + n + extra], 0, {}
        while k + 4 <= len(more):
            kind, length = struct.unpack_from("<HH", more, k)
            wide[kind], k = more[k + 4 : k + 4 + length], k + 4 + length
        values = [size, packed, offset]
        if 0xFFFFFFFF in values:
            numbers = iter(struct.unpack(f"<{len(wide.get(1, b'')) // 8}Q", wide.get(1, b"")[: len(wide.get(1, b"")) // 8 * 8]))
            values = [next(numbers, -1) if v == 0xFFFFFFFF else v for v in values]
            if -1 in values:
                raise GateError("a member's size is missing")
        at += 46 + n + extra + comment
        yield base + at, Member(name.decode("utf-8" if flags & 0x800 else "cp437"), flags, method, crc, values[1], values[0], values[2])


def content(member: Member, data: bytes | memoryview) -> bytes:
    """A member from its local header on."""
    if bytes(data[:4]) != LOCAL:
        raise GateError(f"{member.name} isn't where the directory says")
    n, extra = struct.unpack_from("<26xHH", data)
    body = bytes(data[30 + n + extra : 30 + n + extra + member.packed])
    if member.method == 8:
        inflate = zlib.decompressobj(-15)
        body = inflate.decompress(body, member.size + 1)
        if not inflate.eof:
            raise GateError(f"{member.name} isn't what the directory declares")
    if len(body) != member.size or zlib.crc32(body) != member.crc:
        raise GateError(f"{member.name} is corrupt")
    return body


def contents(f, members: list[Member]) -> Iterator[tuple[Member, bytes]]:
    """Members in the order of their places; neighbours are read together."""
    members = sorted(members, key=lambda m: m.at)
    room = lambda m: 30 + 2 * 65535 + m.packed  # noqa: E731  with the longest local header
    i = 0
    while i < len(members):
        j, end = i + 1, members[i].at + room(members[i])
        while j < len(members) and members[j].at <= end and members[j].at + room(members[j]) - members[i].at <= SPAN:
            end, j = members[j].at + room(members[j]), j + 1
        f.seek(members[i].at)
        data = memoryview(f.read(min(end, f.size()) - members[i].at))
        for m in members[i:j]:
            yield m, content(m, data[m.at - members[i].at :])
        i = j


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


class MemberReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths, self.suffix = options["paths"].split("\n"), options.get("suffix", "").lower()
        self.target, self.most = int(options.get("partitionBytes", 32 << 20)), int(options.get("partitionMembers", 2000))
        self.names_only = options.get("namesOnly", "false") == "true"

    def partitions(self) -> list[Range]:
        parts = []
        for path in self.paths:
            with opened(path) as f:
                offset, length, count = directory(f)
                start = offset
                n = total = seen = 0
                for at, member in entries(f, offset, offset + length):
                    n, total, seen = n + 1, total + member.packed, seen + 1
                    if n >= self.most or total >= self.target:
                        parts.append(Range(path, start, at))
                        start, n, total = at, 0, 0
                if seen != count:
                    raise GateError("the archive's directory has another number of members than its end says")
                if n:
                    parts.append(Range(path, start, offset + length))
        return parts

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        row = lambda *x: pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((partition.path, *x), ARROW.types, strict=True)], schema=ARROW)
        if partition is None or not self.paths:
            return
        with opened(partition.path) as f:
            own = []
            for _, m in entries(f, partition.start, partition.end):
                if m.name.endswith("/"):
                    continue
                if m.problem:
                    raise GateError(f"unsafe archive member {m.name}: {m.problem}")
                if m.name.lower().endswith(self.suffix):
                    if m.size > MOST_MEMBER:
                        raise GateError(f"{m.name} is longer than a value of a row")
                    own.append(m)
                if self.names_only:
                    yield row(m.name, m.size, None)
            if not self.names_only:
                for m, data in contents(f, own):
                    yield row(m.name, m.size, data)


class MemberSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MemberReader:
        return MemberReader(self.options)


def zip_members(spark: SparkSession, path: str, suffix: str = "", partition_members: int = 2000, names_only: bool = False) -> DataFrame:
    """(archive, member, bytes, content) of the members of archives at a path with the suffix in either case; names only:
    of all members, without contents, from the directories alone."""
    spark.dataSource.register(MemberSource)
    found = paths(spark, path)
    if not found:
        raise GateError(f"no archive at {path}")
    return spark.read.format("zip_members").options(paths="\n".join(found), suffix=suffix, partitionMembers=partition_members, namesOnly=str(names_only).lower()).load()


def zip_entries(spark: SparkSession, path: str, suffix: str = ".json", partition_members: int = 2000) -> DataFrame:
    """(member, content) of the archives' members with the suffix, after no member was unsafe and no name repeated."""
    names = zip_members(spark, path, partition_members=partition_members, names_only=True)
    require_empty(names.groupBy("archive", "member").count().filter("count > 1").select("archive", "member"), "an archive member's name is repeated")
    return zip_members(spark, path, suffix, partition_members).select("member", "content")
