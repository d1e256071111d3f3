"""Text lines with their place: file, byte offset, and whether a line feed ends them.

Files are dealt out by ranges of bytes; a line belongs to the range in which it starts, so tasks need no common pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from postalis.operators.gates import GateError
from postalis.sources.store import CHUNK, file_name, listing, opened

ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("value", pa.string()), ("ended", pa.bool_())])
SCHEMA = "path string, offset long, value string, ended boolean"


class Span(InputPartition):
    def __init__(self, path: str, start: int, end: int) -> None:
        self.path, self.start, self.end = path, start, end


def lines_of(f, start: int, end: int, most: int) -> Iterator[list[tuple[int, bytes, bool]]]:
    """(offset, line, ended) of lines that start from start to end (excluded), a chunk at a time."""
    at, data = start, b""
    if start:  # the line of the byte before belongs to the range before
        f.seek(start - 1)
        at, data, skip = start - 1, b"", True
    else:
        f.seek(0)
        skip = False
    done = False
    while not done:
        chunk = f.read(CHUNK)
        data += chunk
        own, place = [], 0
        while (stop := data.find(b"\n", place)) >= 0:
            if skip:
                skip = False
            elif at + place >= end:
                done = True
                break
            else:
                own.append((at + place, data[place:stop], True))
            place = stop + 1
        data, at = data[place:], at + place
        if not chunk:
            if data and not skip and at < end:
                own.append((at, data, False))
            done = True
        elif at >= end and not skip:
            done = True
        elif len(data) >= most and not done:
            raise GateError(f"a line at byte {at} is longer than {most} bytes")
        if own:
            yield own


class LineReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.files = [(p, int(n)) for p, n in (x.rsplit("\t", 1) for x in options["files"].split("\n"))]
        self.target, self.most = int(options.get("partitionBytes", 32 << 20)), int(options["most"])

    def partitions(self) -> list[Span]:
        return [Span(p, i, min(size, i + self.target)) for p, size in self.files for i in range(0, size, self.target)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        with opened(partition.path) as f:
            for own in lines_of(f, partition.start, partition.end, self.most):
                try:
                    texts = [x[1].decode("utf-8") for x in own]
                except UnicodeDecodeError as error:
                    raise GateError(f"a line isn't UTF-8: {error}") from error
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * len(own), pa.string()), pa.array([x[0] for x in own], pa.int64()), pa.array(texts, pa.string()), pa.array([x[2] for x in own], pa.bool_())], schema=ARROW)


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "placed_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)


def placed_lines(spark: SparkSession, path: str, most: int = 1 << 20, partition_bytes: int = 32 << 20, pattern: str | None = None) -> DataFrame:
    """(position, file, offset, value, ended) of the lines of a file, or of a folder's files read by name one after
    another; position: bytes before the line in all of them. A line of more than most bytes is an error."""
    spark.dataSource.register(LineSource)
    files = [(r.path, r.bytes) for r in listing(spark, path, pattern).orderBy("path").collect()]  # a row a file
    if not files:
        raise GateError(f"no file at {path}")
    before, rows = 0, []
    for p, size in files:
        rows.append((p, before))
        before += size
    found = spark.read.format("placed_lines").options(files="\n".join(f"{p}\t{n}" for p, n in files), most=most, partitionBytes=partition_bytes).load()
    starts = spark.createDataFrame(rows, "path string, _before long")  # a row a file, as above
    return found.join(F.broadcast(starts), "path").select((F.col("_before") + F.col("offset")).alias("position"), file_name(F.col("path")).alias("file"), "offset", "value", "ended")
