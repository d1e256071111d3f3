"""A handle on a stored build for lookups: verified once, and every lookup fails if the files have changed since."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from postalis.functions import postal_code
from postalis.operators import build, lookup, manifest
from postalis.operators.gates import GateError
from postalis.sinks import contract_rows
from postalis.sources import store

# What a lookup finds.
RESOLVED, UNRESOLVED, UNKNOWN, INVALID = "resolved", "unresolved", "unknown", "invalid"


@dataclass(frozen=True)
class Dataset:
    spark: SparkSession
    folder: str
    version: str
    records: int
    located: int
    identity: tuple

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/rows")

    def unchanged(self) -> None:
        if store.identity(self.spark, f"{self.folder}/rows") != self.identity:
            raise GateError("the dataset's files have changed since it was verified")

    def code_of(self, text: str) -> str | None:
        """The eight ASCII digits of a written code, null if there are others."""
        from pyspark.sql import functions as F

        return self.spark.range(1).select(postal_code(F.lit(text)).alias("c")).first().c

    def find(self, text: str) -> dict:
        """status and the row of a code, as the contract nests it. The code is a literal, so file statistics prune the scan."""
        code = self.code_of(text)
        if code is None:
            return {"status": INVALID, "row": None}
        self.unchanged()
        row = contract_rows(lookup.point(self.rows, code)).first()
        self.unchanged()
        if row is None:
            return {"status": UNKNOWN, "row": None}
        found = row.asDict(recursive=True)
        return {"status": UNRESOLVED if found["geo"] is None else RESOLVED, "row": found}

    def find_prefix(self, text: str) -> dict:
        """status and the estimate from the other codes of a code's prefix and municipality."""
        code = self.code_of(text)
        if code is None:
            return {"status": INVALID, "estimate": None}
        self.unchanged()
        near = self.rows.filter(f"cep between '{code[:5]}000' and '{code[:5]}999'")
        own = lookup.point(near, code).select("prefix", "ibge", "dataset_version")
        estimate = lookup.prefix_estimates(near.join(own, ["prefix", "ibge", "dataset_version"], "left_semi")).filter(f"cep = '{code}'").first()
        self.unchanged()
        if estimate is None:
            return {"status": UNKNOWN, "estimate": None}
        found = estimate.asDict(recursive=True)
        return {"status": UNRESOLVED if found["latitude"] is None else RESOLVED, "estimate": found}


def open_dataset(spark: SparkSession, folder: str, version: str, rows: str | None = None) -> Dataset:
    """A stored build of the expected version, and with rows of the expected digest (as in its manifest), after one pass over
    its rows counted what metadata and manifest say."""
    metadata = build.read_metadata(spark, folder)
    if metadata.get("format") != build.FORMAT or metadata.get("dataset_version") != version:
        raise GateError(f"not a dataset of version {version}")
    before = store.identity(spark, f"{folder}/rows")
    stored = spark.read.parquet(f"{folder}/rows")
    if rows is not None and manifest.rows_digest(stored) != rows:
        raise GateError("the dataset's rows aren't the expected ones")
    counted = build.verify_artifact(stored, version).first()
    said = {k: int(metadata[f"count_{k}"]) for k in ("records", "located") if f"count_{k}" in metadata}
    if counted.version_mismatches or not counted.records or any(said[k] != counted[k] for k in said):
        raise GateError("the dataset's rows and metadata disagree")
    found = Dataset(spark, folder, version, counted.records, counted.located, before)
    found.unchanged()
    return found
