"""Municipality polygons from zipped shapefiles, by record index: the index file's offsets are the partitions.

The driver checks the archive, reads headers and the index (of bounded size), and deals out ranges of records; a task
reads its rows of the table and its bytes of the shapes. A packed member is unpacked as a stream up to the range.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from postalis.operators.gates import GateError, require_empty
from postalis.sources.archives import MOST_RATIO
from postalis.sources.store import CHUNK, opened, paths

# Fixed values of the official archive: members with their most bytes, all of them together, encoding, coordinate system,
# bounds (longitude, latitude), table columns, number of records, and records that are no municipality.
MEMBERS = {".shp": 512 << 20, ".dbf": 64 << 20, ".shx": 16 << 20, ".prj": 1 << 20, ".cpg": 1 << 20}
MOST_UNPACKED = 600 << 20
ENCODING = b"UTF-8"
SYSTEM = b'GEOGCS["GCS_SIRGAS_2000",DATUM["D_SIRGAS_2000",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
OFFICIAL_BOX = (-74.5, -34.5, -28.0, 6.0)
OFFICIAL_COLUMNS = [
    ("CD_MUN", "C", 7, 0), ("NM_MUN", "C", 100, 0), ("CD_RGI", "C", 6, 0), ("NM_RGI", "C", 100, 0), ("CD_RGINT", "C", 4, 0), ("NM_RGINT", "C", 100, 0), ("CD_UF", "C", 2, 0), ("NM_UF", "C", 50, 0),
    ("SIGLA_UF", "C", 2, 0), ("CD_REGIA", "C", 1, 0), ("NM_REGIA", "C", 20, 0), ("SIGLA_RG", "C", 2, 0), ("CD_CONCU", "C", 7, 0), ("NM_CONCU", "C", 100, 0), ("AREA_KM2", "N", 12, 3),
]
OFFICIAL_RECORDS, OPERATIONAL = 5573, ("4300001", "4300002")
# Limits of a record and of the table.
MOST_PARTS, MOST_POINTS, MOST_RECORD, MOST_RECORDS = 10_000, 1_000_000, 64 << 20, 1_000_000
HEADER = 100

EDGES = pa.schema([("record", pa.int32()), ("ibge", pa.string()), ("ring", pa.int32()), *((c, pa.int64()) for c in ("x1", "y1", "x2", "y2"))])
BOXES = pa.schema([("record", pa.int32()), ("ibge", pa.string()), *((c, pa.float64()) for c in ("xmin", "ymin", "xmax", "ymax"))])


def need(fine: bool, problem: str) -> None:
    if not fine:
        raise GateError(problem)


def members_of(archive: zipfile.ZipFile, expected: dict[str, tuple[int, str]] | None = None) -> dict[str, zipfile.ZipInfo]:
    """Suffix -> member of an archive that holds exactly one shapefile, of bounded size; with expected (name -> bytes,
    SHA-256), exactly those files."""
    found = archive.infolist()
    names = [m.filename for m in found]
    need(len(set(names)) == len(names), "a member's name is repeated")
    need(not any(m.is_dir() or "/" in m.filename or "\\" in m.filename or m.flag_bits & 1 for m in found), "unsafe member path, or encryption")
    suffix = {m.filename: PurePosixPath(m.filename).suffix.lower() for m in found}
    need(len(found) == len(MEMBERS) and set(suffix.values()) == set(MEMBERS), "the members aren't those of one shapefile")
    need(len({PurePosixPath(n).stem.lower() for n in names}) == 1, "the members' names differ")
    for m in found:
        need(1 <= m.file_size <= MEMBERS[suffix[m.filename]], f"the size of {m.filename} is out of bounds")
        need(m.compress_size >= 1 and m.file_size <= m.compress_size * MOST_RATIO, f"the compression ratio of {m.filename} is a bomb's")
    need(sum(m.file_size for m in found) <= MOST_UNPACKED, "the archive unpacks to too much")
    need(expected is None or set(expected) == set(names), "the members aren't the locked ones")
    try:
        for m in found:  # to its end, which checks its sum
            digest = hashlib.sha256()
            with archive.open(m) as f:
                while chunk := f.read(CHUNK):
                    digest.update(chunk)
            need(expected is None or expected[m.filename] == (m.file_size, digest.hexdigest()), f"{m.filename} isn't the locked file")
    except zipfile.BadZipFile as error:
        raise GateError(f"the archive is corrupt: {error}") from error
    by = {suffix[m.filename]: m for m in found}
    need(archive.read(by[".cpg"]) == ENCODING, "the encoding isn't UTF-8")
    need(archive.read(by[".prj"]) == SYSTEM, "the coordinate system isn't SIRGAS 2000")
    return by


def header_box(data: bytes, size: int, label: str) -> tuple[float, ...]:
    """The bounds in a shape or index file's header, which must fit the file."""
    need(len(data) == HEADER, f"the {label} header is cut short")
    need(struct.unpack_from(">i", data)[0] == 9994 and not any(data[4:24]), f"the {label} file code is another")
    need(2 * struct.unpack_from(">i", data, 24)[0] == size, f"the {label} length is another than declared")
    need(struct.unpack_from("<ii", data, 28) == (1000, 5), f"the {label} version or shape is another")
    box = struct.unpack_from("<4d", data, 36)
    need(all(map(math.isfinite, box)), f"the {label} bounds aren't finite")
    return box


@dataclass(frozen=True)
class Table:
    """Dimensions of a table file, and where a row has the code."""

    count: int
    start: int
    width: int
    offset: int
    length: int


def table_of(f, size: int, official: bool, field: str = "CD_MUN") -> Table:
    head = f.read(32)
    need(len(head) == 32, "the table's header is cut short")
    count, start, width = struct.unpack_from("<IHH", head, 4)
    need(1 <= count <= MOST_RECORDS and start >= 33 and width >= 2, "the table's dimensions are out of bounds")
    need(start + count * width + 1 == size, "the table's dimensions don't match its size")
    rest = f.read(start - 32)
    need(len(rest) == start - 32 and rest[-1:] == b"\r" and len(rest) % 32 == 1, "the table's columns are cut short")
    columns, place = {}, 1
    for i in range(0, len(rest) - 1, 32):
        name, kind, length, decimals = rest[i : i + 11].split(b"\0")[0].decode("ascii", "replace"), chr(rest[i + 11]), rest[i + 16], rest[i + 17]
        columns[name] = (name, kind, length, decimals, place)
        place += length
    need(place == width, "the table's columns don't make up a row")
    need(field in columns, "the table lacks the code")
    need(not official or [c[:4] for c in columns.values()] == OFFICIAL_COLUMNS and count == OFFICIAL_RECORDS, "the table isn't the official one")
    return Table(count, start, width, columns[field][4], columns[field][2])


def codes_of(rows: bytes, table: Table) -> list[str]:
    """The codes of whole rows."""
    found = []
    for i in range(0, len(rows), table.width):
        need(rows[i : i + 1] != b"*", "the table has deleted rows")
        code = rows[i + table.offset : i + table.offset + table.length].decode("ascii", "replace").strip()
        need(bool(re.fullmatch("[0-9]{7}", code)), f"malformed municipality code {code!r}")
        found.append(code)
    return found


def record_of(data: bytes, number: int, words: int) -> tuple[tuple[float, ...], np.ndarray, np.ndarray]:
    """(box, first points of the rings, points) of a record with its header, which must be the index's."""
    own = f"record {number}"
    need(len(data) >= 8 and struct.unpack_from(">ii", data) == (number, words), f"{own} isn't aligned with the index")
    need(44 <= 2 * words <= MOST_RECORD and len(data) == 8 + 2 * words, f"the length of {own} is out of bounds")
    need(struct.unpack_from("<i", data, 8)[0] == 5, f"{own} is no polygon")
    box = struct.unpack_from("<4d", data, 12)
    parts, points = struct.unpack_from("<ii", data, 44)
    need(1 <= parts <= MOST_PARTS and 4 <= points <= MOST_POINTS and 44 + 4 * parts + 16 * points == 2 * words, f"the dimensions of {own} are out of bounds")
    first = np.frombuffer(data, "<i4", parts, 52).astype(np.int64)
    need(first[0] == 0 and bool((np.diff(first) > 0).all()) and first[-1] < points, f"the part indexes of {own} are out of order")
    return box, first, np.frombuffer(data, "<f8", 2 * points, 52 + 4 * parts).reshape(-1, 2)


def edges_of(data: bytes, number: int, words: int, code: str) -> pa.RecordBatch:
    """A record's edges in nanodegrees. Rings are closed, of four points or more, and repeat no point."""
    box, first, xy = record_of(data, number, words)
    own = f"record {number}"
    need(bool(np.isfinite(xy).all()), f"{own} isn't finite")
    need(box == (*xy.min(0).tolist(), *xy.max(0).tolist()), f"the bounds of {own} aren't its points'")
    need(-180 <= box[0] and box[2] <= 180 and -90 <= box[1] and box[3] <= 90, f"{own} lies outside longitude and latitude")
    ends = np.append(first[1:], len(xy))
    need(bool((ends - first >= 4).all()), f"{own} has a ring of less than four points")
    need(bool((xy[first] == xy[ends - 1]).all()), f"{own} has a ring that isn't closed")
    start = np.setdiff1d(np.arange(len(xy)), ends - 1)
    need(not bool((xy[start] == xy[start + 1]).all(1).any()), f"{own} repeats a point")
    grid = np.rint(xy * 1e9).astype(np.int64)
    ring = np.searchsorted(ends, start, "right").astype(np.int32)
    columns = [np.full(len(start), number, np.int32), [code] * len(start), ring, grid[start, 0], grid[start, 1], grid[start + 1, 0], grid[start + 1, 1]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, EDGES.types, strict=True)], schema=EDGES)


class Records(InputPartition):
    """Records from first (from 0), with their offsets and lengths in words."""

    def __init__(self, path: str, first: int, places: list[tuple[int, int]]) -> None:
        self.path, self.first, self.places = path, first, places


class ShapeReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths, self.target = options["paths"].split("\n"), int(options.get("partitionBytes", 16 << 20))
        self.official, self.boxes = options.get("official", "false") == "true", options.get("boxes", "false") == "true"
        expected = options.get("expected")
        self.expected = {n: (int(size), digest) for n, size, digest in (x.split("\t") for x in expected.split("\n"))} if expected else None

    def partitions(self) -> list[Records]:
        parts = []
        for path in self.paths:
            with opened(path) as f, zipfile.ZipFile(f) as archive:
                by = members_of(archive, self.expected)
                with archive.open(by[".shx"]) as x, archive.open(by[".shp"]) as s, archive.open(by[".dbf"]) as d:
                    index = x.read()
                    box = header_box(index[:HEADER], by[".shx"].file_size, "index")
                    need(box == header_box(s.read(HEADER), by[".shp"].file_size, "shape"), "the bounds of shapes and index differ")
                    table = table_of(d, by[".dbf"].file_size, self.official)
                need((len(index) - HEADER) % 8 == 0 and (len(index) - HEADER) // 8 == table.count, "shapes and table differ in number")
                if self.official:
                    need(OFFICIAL_BOX[0] <= box[0] < box[2] <= OFFICIAL_BOX[2] and OFFICIAL_BOX[1] <= box[1] < box[3] <= OFFICIAL_BOX[3], "the bounds aren't the official ones: longitude is x, latitude y")
                words = np.frombuffer(index, ">u4", offset=HEADER).reshape(-1, 2).astype(np.int64)
                ends = HEADER + np.cumsum(8 + 2 * words[:, 1])
                need(bool((2 * words[:, 0] == ends - 8 - 2 * words[:, 1]).all()), "index and shapes aren't aligned")
                need(int(ends[-1]) == by[".shp"].file_size, "shapes that the index doesn't have")
                cuts = np.searchsorted(ends, np.arange(self.target, int(ends[-1]), self.target))
                cuts = sorted({0, *cuts.tolist(), len(words)})
                parts += [Records(path, i, [(2 * a, b) for a, b in words[i:j].tolist()]) for i, j in zip(cuts, cuts[1:])]
        return parts

    def read(self, partition: Records) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        with opened(partition.path) as f, zipfile.ZipFile(f) as archive:
            by = {PurePosixPath(m.filename).suffix.lower(): m for m in archive.infolist()}
            with archive.open(by[".dbf"]) as d:
                table = table_of(d, by[".dbf"].file_size, self.official)
                d.seek(table.start + partition.first * table.width)
                codes = codes_of(d.read(len(partition.places) * table.width), table)
                if partition.first + len(codes) == table.count:
                    need(d.read() == b"\x1a", "the table has bytes behind its rows")
            with archive.open(by[".shp"]) as s:
                s.seek(partition.places[0][0])
                for k, (_, words) in enumerate(partition.places):
                    number, data = partition.first + k + 1, s.read(8 + 2 * words)
                    if self.boxes:
                        box = record_of(data, number, words)[0]
                        yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip((number, codes[k], *box), BOXES.types, strict=True)], schema=BOXES)
                    elif not (self.official and codes[k] in OPERATIONAL):
                        yield edges_of(data, number, words, codes[k])
                    else:
                        edges_of(data, number, words, codes[k])


class ShapeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "municipality_shapes"

    def schema(self) -> str:
        return "record int, ibge string, " + ("xmin double, ymin double, xmax double, ymax double" if self.options.get("boxes") == "true" else "ring int, x1 long, y1 long, x2 long, y2 long")

    def reader(self, schema) -> ShapeReader:
        return ShapeReader(self.options)


def polygon_edges(spark: SparkSession, path: str, official: bool = False, expected: dict[str, tuple[int, str]] | None = None, partition_bytes: int = 16 << 20) -> DataFrame:
    """(ibge, ring, x1, y1, x2, y2) in nanodegrees of the municipality polygons of zipped shapefiles, after codes were
    different and the records' bounds made up the header's. official: the archive must be the official one, and records
    that are no municipality are left out."""
    spark.dataSource.register(ShapeSource)
    found = paths(spark, path)
    need(bool(found), f"no archive at {path}")
    options = {"paths": "\n".join(found), "official": str(official).lower(), "partitionBytes": partition_bytes}
    if expected:
        options["expected"] = "\n".join(f"{n}\t{size}\t{digest}" for n, (size, digest) in expected.items())
    source = spark.read.format("municipality_shapes").options(**options)
    boxes = source.option("boxes", "true").load()
    require_empty(boxes.groupBy("ibge").count().filter("count > 1").select("ibge"), "repeated municipality codes")
    if official:
        need(boxes.filter(F.col("ibge").isin(*OPERATIONAL)).count() == len(OPERATIONAL), "the operational records aren't the official ones")
    if len(found) == 1:
        with opened(found[0]) as f, zipfile.ZipFile(f) as archive:
            name = next(m for m in archive.infolist() if m.filename.lower().endswith(".shp"))
            with archive.open(name) as s:
                box = header_box(s.read(HEADER), name.file_size, "shape")
        whole = boxes.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
        need(tuple(whole) == box, "the header's bounds aren't the records'")
    options.pop("boxes", None)
    return spark.read.format("municipality_shapes").options(**options).load().drop("record")
