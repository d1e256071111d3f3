"""Files where they lie: opened by range or as a stream in tasks, listed and digested by Spark, and held against change.

Paths must be ones that driver and executors open alike: a shared mount, or a store that pyarrow knows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.operators.gates import GateError

CHUNK = 1 << 20


def opened(path: str):
    """A file for reading at any place."""
    local = re.match("(?:file:)?/", path)
    system, place = (fs.LocalFileSystem(), re.sub("^file:/*", "/", path)) if local else fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return system.open_input_file(place)


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, bytes, modified) of files below a path; contents aren't read, so files may have any size."""
    source = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = (source.option("pathGlobFilter", pattern) if pattern else source).load(path)
    return found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def paths(spark: SparkSession, path: str, pattern: str | None = None) -> list[str]:
    """The files' paths in order: a row a file, for a reader that deals out their ranges."""
    return [r.path for r in listing(spark, path, pattern).select("path").orderBy("path").collect()]


def sha256_of(path: str) -> tuple[int, str]:
    digest, size = hashlib.sha256(), 0
    with opened(path) as f:
        while chunk := f.read(CHUNK):
            digest.update(chunk)
            size += len(chunk)
    return size, digest.hexdigest()


def digests(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, bytes, sha256): tasks stream their files through a chunk of memory, whatever the files' size. Large files are
    dealt to tasks of their own; a file's digest is one sequence."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for path in frame["path"]:
                yield pd.DataFrame([(path, *sha256_of(path))], columns=["path", "bytes", "sha256"])

    return listing(spark, path, pattern).select("path").mapInPandas(stream, "path string, bytes long, sha256 string")


def identity(spark: SparkSession, path: str, content: bool = False) -> tuple:
    """What a path's files are now, in one row however many: number, bytes, and sums of hashes of path, size and time of
    change (or digest, with content) that don't depend on their order."""
    rows = listing(spark, path)
    if content:
        rows = rows.join(digests(spark, path).select("path", "sha256"), "path")
    parts = [F.sum(F.xxhash64(F.lit(seed), *rows.columns).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return tuple(rows.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0)), *parts).first())


@contextmanager
def unchanged(spark: SparkSession, *inputs: str, content: bool = False) -> Iterator[dict[str, tuple]]:
    """Around a job: its inputs' identities, which must be the same afterwards."""
    before = {p: identity(spark, p, content) for p in inputs}
    yield before
    if changed := [p for p in inputs if identity(spark, p, content) != before[p]]:
        raise GateError(f"inputs changed while they were read: {changed}")
