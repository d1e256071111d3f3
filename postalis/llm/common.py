"""Helpers the operators of this subpackage share: Arrow batches in and out, byte-level text access, checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of the white space class [\x20\x09-\x0D]; bytes.split() and bytes.strip() use the same class.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of spark.checkpoint.dir, so a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def arrow_schema(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(","))])


def to_batch(columns: dict, target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in ((columns[f.name], f) for f in target)], schema=target)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share. Only a session in one process, as in tests,
    gets a new folder of its machine if none is set; on a cluster that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="postalis-checkpoint-"))
    return context.getCheckpointDir()


class Scratch:
    """Intermediate tables as Parquet in the shared folder: they cut lineage as a checkpoint does, but are compressed,
    read by column, and deleted once nothing reads them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for path in {x.rsplit("/", 1)[0] for t in tables for x in t.inputFiles()}:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


#: Bits of the largest id filter (32 MiB, broadcast); a wrong hit costs some work, never a result.
MOST_BITS = 1 << 28


def screen(df: DataFrame, column: str, ids: DataFrame, hit: bool = True) -> DataFrame:
    """Rows whose id may be one of ids (a column of the same name; all that are pass), or with hit false only rows whose
    id is none of them (some such rows may be missing: they are among the others). No row of df is shuffled: ids are
    broadcast as bits, 16 an id. Beyond MOST_BITS / 8 ids, a join decides exactly instead."""
    n = ids.count()
    if 8 * n > MOST_BITS:
        return df.join(ids.select(column).distinct(), column, "left_semi" if hit else "left_anti")
    size = max(1 << 15, min(MOST_BITS, 1 << (16 * n).bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(size))
    bits = ids.select(slot(column).alias("_s")).groupBy(F.shiftright("_s", 15).alias("_b")).agg(F.bitmap_construct_agg(F.col("_s").bitwiseAND(32767)).alias("_m"))
    rows = df.withColumn("_s", slot(column)).withColumn("_b", F.shiftright("_s", 15)).join(F.broadcast(bits), "_b", "left")
    byte = F.conv(F.hex(F.expr("substring(_m, cast((_s & 32767) >> 3 as int) + 1, 1)")), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, F.col("_s").bitwiseAND(7).cast("int")) == 1, F.lit(False))
    return rows.filter(found if hit else ~found).select(*df.columns)


#: Rows of an Arrow batch, unless the session has a setting other than Spark's default, which stays: thousands of whole texts at once, in the executor and
#: twice or more in its Python worker, would take much of an executor's memory.
BATCH_ROWS, BATCH_SETTING, BATCH_DEFAULT = "1000", "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]], schema: str, end: bool = False) -> DataFrame:
    """mapInArrow with one function per task: make() builds it, it turns a batch into dicts of columns; with end, it is
    called with None after the last batch."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for columns in step(batch):
                yield to_batch(columns, target)
        if end:
            for columns in step(None):
                yield to_batch(columns, target)
        pa.default_memory_pool().release_unused()  # a worker lives on after its task

    spark = df.sparkSession
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT and not spark.sparkContext.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    return df.mapInArrow(run, schema)


def map_sorted(df: DataFrame, keys: list[str], order: list, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]], schema: str) -> DataFrame:
    """map_arrow over rows dealt out by the keys and sorted by the keys and then by order; a group may span batches."""
    return map_arrow(df.repartition(*keys).sortWithinPartitions(*keys, *order), make, schema)


def raw(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.binary()).to_pylist()


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words [^\\x20\\x09-\\x0D]+ of each text, 0 for null, from the column's buffer without a Python loop over words."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(len(column), np.int64)
    space = SPACE[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]]
    starts = ~space
    starts[1:] &= space[:-1]
    first = (offsets[:-1] - offsets[0])[offsets[1:] > offsets[:-1]]
    starts[first] = ~space[first]
    total = np.concatenate([[0], np.cumsum(starts)])
    at = offsets - offsets[0]
    return total[at[1:]] - total[at[:-1]]


def fold(column: str, modulus: int) -> Column:
    """crc32(id as text) mod modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of a public 64-bit hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))
CHUNK = 1 << 18


@cache
def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


def hashed_words(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """64-bit hashes of the white-space words of the texts, and how many each text has, for half a megabyte at a time.

    A word's hash comes from differences of one running sum over all bytes, so there is no loop over words.
    """

    def of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        own = np.frombuffer(data, np.uint8)
        edge = np.ones(len(own) + 2, bool)
        edge[1:-1] = SPACE[own]
        at = np.flatnonzero(edge[1:] != edge[:-1])
        starts, ends = at[0::2], at[1::2]
        n = 1 << max(16, len(own).bit_length())
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(BYTES[own] * powers(MULTIPLIER, n)[: len(own)], out=total[1:])
        return mixed((total[ends] - total[starts]) * powers(INVERSE, n)[starts] + (ends - starts).astype(np.uint64)), starts

    at = 0
    while at < len(texts):
        if len(texts[at]) > CHUNK:  # a very long text: its words in portions
            words = texts[at].split()
            parts = [of(b" ".join(words[i : i + CHUNK // 8]))[0] for i in range(0, len(words), CHUNK // 8)]
            yield np.concatenate([np.zeros(0, np.uint64), *parts]), np.array([len(words)])
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and len(texts[end]) <= CHUNK and (size := size + len(texts[end]) + 1) <= 2 * CHUNK:
            end += 1
        hashes, starts = of(b" ".join(texts[at:end]))
        first = np.cumsum([0, *(len(t) + 1 for t in texts[at:end])])
        yield hashes, np.diff(np.searchsorted(starts, first))
        at = end


def packed(*parts: np.ndarray) -> bytes:
    """Arrays with their bytes by place, compressed."""
    return zstandard.compress(b"".join(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in parts), 3)


def unpacked(data: bytes, *shape: tuple[int, str]) -> list[np.ndarray]:
    data, at, found = zstandard.decompress(data), 0, []
    for n, kind in shape:
        size = n * np.dtype(kind).itemsize
        found.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, size, at).reshape(-1, n).T).view(kind).ravel() if n else np.zeros(0, kind))
        at += size
    return found


def steps(sorted_values: np.ndarray) -> np.ndarray:
    """Differences, which cumsum undoes."""
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))
