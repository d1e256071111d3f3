"""Canonical exports of the resolved table: JSON lines and CSV in the order of codes, and what reads them back.

An export is a folder of parts; read by name they are the whole file in order, so no task writes all of it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.operators import strict
from postalis.operators.contract import row_problems
from postalis.operators.gates import GateError, require_empty
from postalis.operators.refresh import order_violations
from postalis.sources.lines import placed_lines
from postalis.sources.store import digests, file_name

# Text columns of a row and the keys of its geography.
TEXT = ["cep", "prefix", "street", "complement", "unit", "neighborhood", "city", "uf", "state", "region", "ibge", "dataset_version"]
GEO = "struct<type: string, coordinates: array<double>, precision: string, method: string, evidence_count: bigint, evidence_radius_km: double, source: array<string>, evidence_digest: string>"
ROW = ", ".join(f"{c} string" for c in TEXT) + f", geo {GEO}"
MOST_LINE = 65_536
_OPEN = (*strict.TEXT, *strict.NOTHING)
SHAPE: strict.Shape = {
    **dict.fromkeys(TEXT, strict.TEXT), **dict.fromkeys(("street", "complement", "unit", "neighborhood", "state", "region"), _OPEN),
    "geo": {"type": strict.TEXT, "coordinates": strict.NUMBERS, "precision": strict.TEXT, "method": strict.TEXT, "evidence_count": strict.WHOLE, "evidence_radius_km": strict.NUMBER, "source": strict.TEXTS, "evidence_digest": strict.TEXT},
}
#: Every column of a flat row, in the order of the CSV export.
FLAT = [*TEXT[:-1], "latitude", "longitude", "precision", "method", "evidence_count", "evidence_radius_km", "geo_source", "evidence_digest", "dataset_version"]


def contract_rows(flat: DataFrame) -> DataFrame:
    """Flat rows with the geography nested, longitude first; null unless both coordinates are there."""
    geo = F.struct(
        F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"), "precision", "method", F.col("evidence_count").cast("long").alias("evidence_count"),
        F.col("evidence_radius_km").cast("double").alias("evidence_radius_km"), F.col("geo_source").alias("source"), "evidence_digest",
    )
    return flat.select(*TEXT, F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), geo).alias("geo"))


def flat_rows(contract: DataFrame) -> DataFrame:
    g = lambda n: F.col(f"geo.{n}")
    return contract.select(*TEXT[:-1], g("coordinates")[1].alias("latitude"), g("coordinates")[0].alias("longitude"), *(g(n).alias(n) for n in ("precision", "method", "evidence_count", "evidence_radius_km")), g("source").alias("geo_source"), g("evidence_digest").alias("evidence_digest"), "dataset_version")


def canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def canonical_lines(contract: DataFrame) -> DataFrame:
    """(value): each row as canonical JSON. Python writes it, since doubles must read as in its own notation; the order
    of rows is kept."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(canonical, batch.to_pylist()), pa.string())], ["value"])

    return contract.mapInArrow(write, "value string")


def write_jsonl(flat: DataFrame, folder: str) -> None:
    canonical_lines(contract_rows(flat).orderBy("cep")).write.text(folder, lineSep="\n")


def write_csv(flat: DataFrame, folder: str) -> None:
    """With a header in each part; sources as a JSON array, nulls empty."""
    flat.select(*(F.to_json(c).alias(c) if c == "geo_source" else c for c in FLAT)).orderBy("cep").write.csv(folder, header=True, nullValue="", emptyValue="", lineSep="\n", escape='"')


def line_problems(lines: DataFrame) -> DataFrame:
    """lines (value) that are too long, no JSON object of exactly the known keys, or not in canonical form."""
    keys = {*TEXT, "geo"}

    def judge(value: str) -> str | None:
        if len(value.encode()) + 1 > MOST_LINE:
            return "too long"
        try:
            row = json.loads(value)
        except ValueError:
            return "no JSON"
        if not isinstance(row, dict) or set(row) != keys:
            return "other keys"
        return None if canonical(row) == value else "not canonical"

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found = [(v, p) for v in frame["value"] if (p := judge(v))]
            yield pd.DataFrame(found, columns=["value", "problem"])

    return lines.select("value").mapInPandas(check, "value string, problem string")


def file_problems(spark: SparkSession, path: str, expected: dict[str, tuple[int, str]]) -> DataFrame:
    """(file, problem): files that are missing, not expected, or of another size or digest (name -> bytes, SHA-256)."""
    found = digests(spark, path).select(file_name(F.col("path")).alias("file"), "bytes", "sha256")
    want = spark.createDataFrame([(n, *x) for n, x in expected.items()], "file string, _bytes long, _sha256 string")
    problem = F.when(F.col("bytes").isNull(), "missing").when(F.col("_bytes").isNull(), "unexpected").when(F.col("bytes") != F.col("_bytes"), "size").when(F.col("sha256") != F.col("_sha256"), "digest")
    return found.join(want, "file", "full").select("file", problem.alias("problem")).filter("problem is not null")


def read_jsonl(spark: SparkSession, path: str, version: str | None = None, expected: dict[str, tuple[int, str]] | None = None) -> DataFrame:
    """Flat rows of a canonical export, a file or a folder of parts that are read by name. Errors: other files than
    expected (name -> bytes, SHA-256), a line that is too long, has no line feed, other keys or kinds at any depth, isn't
    canonical or breaks a rule of a row; codes that don't rise from line to line; no line at all."""
    if expected is not None:
        require_empty(file_problems(spark, path, expected), "files that aren't the expected ones")
    lines = placed_lines(spark, path, MOST_LINE)
    if lines.isEmpty():
        raise GateError("an export has lines")
    require_empty(lines.filter("not ended").select("file", "offset"), "a line without a line feed")
    odd = strict.strict(F.col("value"), SHAPE, ("geo",))
    require_empty(lines.select("file", "offset", odd.alias("problems")).filter(F.size("problems") > 0), "lines of other keys or kinds")
    require_empty(line_problems(lines).select("problem", F.substring("value", 1, 80)), "lines that aren't canonical")
    rows = lines.select("position", F.from_json("value", ROW, {"mode": "FAILFAST"}).alias("r")).select("position", "r.*")
    require_empty(order_violations(rows, "position", span=32 << 20).select("cep"), "codes out of order, or twice")
    require_empty(rows.filter("geo is not null and (geo.type <> 'Point' or size(geo.coordinates) <> 2)").select("cep"), "a geography is a point of two numbers")
    flat = flat_rows(rows)
    require_empty(row_problems(flat, version).select("cep", "failed"), "rows against the contract")
    return flat


def part_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of an export's parts, for its manifest."""
    return digests(spark, folder, "part-*")
