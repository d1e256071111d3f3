"""OpenStreetMap PBF nodes as a Spark data source: blobs are dealt out by offset, so a large extract is read by many tasks.

The driver walks over the blob headers only; tasks decode their blobs with numpy. The path must be one that driver and
executors open alike (a shared mount, or a store that pyarrow knows).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from postalis.functions import postal_code
from postalis.operators.gates import GateError, require_empty
from postalis.sources.store import opened

# Limits of the format.
MOST_HEADER, MOST_BLOB, MOST_RAW = 64 << 10, 64 << 20, 32 << 20
SCHEMA = "id long, latitude double, longitude double, tags map<string,string>"
ARROW = pa.schema([("id", pa.int64()), ("latitude", pa.float64()), ("longitude", pa.float64()), ("tags", pa.map_(pa.string(), pa.string()))])


def varint(data: memoryview, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise GateError("a number is cut short or too long")
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def fields(data: bytes | memoryview) -> Iterator[tuple[int, int | memoryview]]:
    """(field number, value) of a message: integers, or the bytes of length-delimited fields."""
    data, at = memoryview(data), 0
    while at < len(data):
        key, at = varint(data, at)
        if key & 7 == 0:
            value, at = varint(data, at)
        elif key & 7 in (1, 2, 5):
            length, at = varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + length], at + length
            if at > len(data):
                raise GateError("a field is cut short")
        else:
            raise GateError("unknown field kind")
        yield key >> 3, value


def packed(data: bytes | memoryview) -> np.ndarray:
    """All numbers of a packed field at once."""
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    if not len(raw):
        return np.zeros(0, np.uint64)
    if not len(ends) or ends[-1] != len(raw) - 1:
        raise GateError("packed numbers are cut short")
    starts = np.append(0, ends[:-1] + 1)
    length = ends - starts + 1
    out = np.zeros(len(ends), np.uint64)
    for k in range(int(length.max())):
        has = length > k
        out[has] |= (raw[starts[has] + k].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * k)
    return out


def signed(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def blobs(path: str) -> list[tuple[int, int]]:
    """(offset, length) of the data blobs."""
    found = []
    with opened(path) as f:
        size, at = f.size(), 0
        while at < size:
            f.seek(at)
            head = int.from_bytes(f.read(4), "big")
            if head > MOST_HEADER:
                raise GateError("a blob header is too long")
            header = dict(fields(f.read(head)))
            kind, length, at = bytes(header.get(1, b"")), header.get(3, -1), at + 4 + head
            if kind not in (b"OSMHeader", b"OSMData") or not 0 <= length <= MOST_BLOB or at + length > size:
                raise GateError("unknown, too long or cut blob")
            if kind == b"OSMData":
                found.append((at, length))
            at += length
    return found


def unpacked(blob: bytes) -> bytes:
    parts = dict(fields(blob))
    if 1 in parts:
        return bytes(parts[1])
    if 3 not in parts or parts.get(2, MOST_RAW + 1) > MOST_RAW:
        raise GateError("the blob is packed in another way or declares too much")
    inflate = zlib.decompressobj()
    raw = inflate.decompress(bytes(parts[3]), parts[2] + 1)
    if len(raw) != parts[2] or not inflate.eof or inflate.unused_data:
        raise GateError("the blob isn't what it declares")
    return raw


def block_nodes(raw: bytes) -> pa.RecordBatch:
    """The nodes of a primitive block, plain and dense."""
    strings, groups, scale = [], [], {17: 100, 19: 0, 20: 0}
    for number, value in fields(raw):
        if number == 1:
            strings = [bytes(v).decode("utf-8") for n, v in fields(value) if n == 1]
        elif number == 2:
            groups.append(value)
        elif number in scale:
            scale[number] = value - (1 << 64) if value >> 63 else value
    ids, lats, lons, tags = [], [], [], []
    for group in groups:
        for number, value in fields(group):
            if number == 1:
                node = dict(fields(value))
                one = lambda n: signed(np.array([node[n]], np.uint64))
                ids.append(one(1)), lats.append(one(8)), lons.append(one(9))
                keys, values = (packed(node.get(n, b"")).astype(int) for n in (2, 3))
                tags.append([(strings[k], strings[v]) for k, v in zip(keys, values, strict=True)])
            elif number == 2:
                dense = dict(fields(value))
                some = np.cumsum(signed(packed(dense.get(1, b""))))
                ids.append(some), lats.append(np.cumsum(signed(packed(dense.get(8, b""))))), lons.append(np.cumsum(signed(packed(dense.get(9, b"")))))
                pairs = packed(dense.get(10, b"")).astype(int)
                if len(pairs):
                    tags += dense_tags(pairs, strings, len(some))
                else:
                    tags += [[] for _ in some]
    place = lambda parts, offset: (np.concatenate(parts) * scale[17] + offset) / 1e9 if parts else np.zeros(0)
    arrays = [np.concatenate(ids) if ids else np.zeros(0, np.int64), place(lats, scale[19]), place(lons, scale[20])]
    return pa.RecordBatch.from_arrays([*(pa.array(a) for a in arrays), pa.array(tags, ARROW.field("tags").type)], schema=ARROW)


def dense_tags(pairs: np.ndarray, strings: list[str], count: int) -> list[list[tuple[str, str]]]:
    """Tags of each node: key and value numbers in turn, each node's list ended by a zero."""
    out, at = [], 0
    for _ in range(count):
        own = []
        while pairs[at]:
            own.append((strings[pairs[at]], strings[pairs[at + 1]]))
            at += 2
        out.append(own)
        at += 1
    return out


class Blobs(InputPartition):
    def __init__(self, ranges: list[tuple[int, int]]) -> None:
        self.ranges = ranges


class NodeReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.target = options["path"], int(options.get("partitionBytes", 32 << 20))

    def partitions(self) -> list[Blobs]:
        parts, total = [[]], 0
        for offset, length in blobs(self.path):
            if parts[-1] and total + length > self.target:
                parts.append([])
                total = 0
            parts[-1].append((offset, length))
            total += length
        return [Blobs(p) for p in parts]

    def read(self, partition: Blobs) -> Iterator[pa.RecordBatch]:
        with opened(self.path) as f:
            for offset, length in partition.ranges:
                f.seek(offset)
                yield block_nodes(unpacked(f.read(length)))


class NodeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "osm_pbf_nodes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> NodeReader:
        return NodeReader(self.options)


def nodes(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(NodeSource)
    return spark.read.format("osm_pbf_nodes").option("path", path).load()


def judged_postcodes(found: DataFrame) -> DataFrame:
    """Nodes with postcode tag, cep, and status: untagged, invalid_postcode, invalid_coordinate or accepted. A blank first
    tag falls through to the second."""
    tag = F.coalesce(F.nullif(found.tags["addr:postcode"], F.lit("")), found.tags["postal_code"])
    code = postal_code(tag)
    good = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    status = F.when(tag.isNull(), "untagged").when(code.isNull(), "invalid_postcode").when(~F.coalesce(good, F.lit(False)), "invalid_coordinate").otherwise("accepted")
    return found.select("id", "latitude", "longitude", code.alias("cep"), status.alias("status"))


def counters(judged: DataFrame) -> DataFrame:
    """One row: scanned, tagged, accepted, invalid_postcode, invalid_coordinate."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return judged.agg(F.count("*").alias("scanned"), F.count_if(F.col("status") != "untagged").alias("tagged"), *map(count, ("accepted", "invalid_postcode", "invalid_coordinate")))


def evidence(judged: DataFrame) -> DataFrame:
    """(evidence_id, cep, ibge, latitude, longitude, source) of the accepted nodes."""
    name = F.concat(F.lit("openstreetmap:node/"), F.col("id").cast("string"))
    return judged.filter("status = 'accepted'").select(name.alias("evidence_id"), "cep", F.lit(None).cast("string").alias("ibge"), "latitude", "longitude", name.alias("source"))


def extract(spark: SparkSession, path: str, folder: str) -> dict[str, int]:
    """Write a map's accepted nodes as evidence: Parquet rows, whose writing pass takes the counters, and from these CSV in
    the order of codes and sources. A node that stands twice is an error. Returns the counters."""
    seen = Observation("nodes")
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    judged = judged_postcodes(nodes(spark, path)).observe(seen, F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("status") != "untagged").alias("tagged"), *map(count, ("accepted", "invalid_postcode", "invalid_coordinate")))
    evidence(judged).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    require_empty(rows.groupBy("source").count().filter("count > 1").select("source"), "map nodes that stand twice")
    write_evidence(rows, f"{folder}/csv")
    return {k: int(v) for k, v in seen.get.items()}


def write_evidence(rows: DataFrame, folder: str) -> None:
    """Evidence as CSV in the order of codes and sources, with a header in each part; places as Python writes doubles."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cep, lat, lon, source = (batch.column(c).to_pylist() for c in ("cep", "latitude", "longitude", "source"))
            yield pa.RecordBatch.from_arrays([pa.array(cep), pa.array([None] * len(cep), pa.string()), pa.array(list(map(repr, lat))), pa.array(list(map(repr, lon))), pa.array(source)], ["cep", "ibge", "latitude", "longitude", "source"])

    ordered = rows.select("cep", "latitude", "longitude", "source").orderBy("cep", "source")
    ordered.mapInArrow(lines, "cep string, ibge string, latitude string, longitude string, source string").write.csv(folder, header=True, nullValue="", emptyValue="", lineSep="\n", escape='"')
