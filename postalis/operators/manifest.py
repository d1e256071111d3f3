"""What a build was: counts taken while its rows are written, a digest of the rows that doesn't depend on files or order,
identities of inputs, settings and code. Equal builds give equal manifests; there is no clock in them."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postalis.config import TIERS

# Fixed value: the manifest's format.
FORMAT = "postalis-build-manifest-v1"


def row_hashes(columns: list[str]) -> list[Column]:
    """Two 60-bit numbers from the SHA-256 of a row's columns; their sums over rows identify a set of rows in any order."""
    digest = F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16)]


def digest_text(records: int, first: object, second: object) -> str:
    return f"{records}:{int(first or 0):x}:{int(second or 0):x}"


def counts(columns: list[str]) -> dict[str, Column]:
    """What is counted of rows while they are written: records, located and unresolved ones, tiers, the rows' digest, and
    what carries a mark (_joined, _origin) of how it came about."""
    found = {
        "records": F.count(F.lit(1)), "located": F.count("latitude"), "unresolved": F.count_if(F.col("latitude").isNull()),
        **{f"tier_{t}": F.count_if(F.col("precision") == t) for t in TIERS}, "tier_unresolved": F.count_if(F.col("precision").isNull()),
    }
    if "_joined" in columns:
        found["ibge_joined"] = F.count_if("_joined")
    plain = [c for c in columns if not c.startswith("_")]
    return found | {f"_hash_{i}": F.sum(h) for i, h in enumerate(row_hashes(plain))}


def observed_write(rows: DataFrame, path: str, origins: tuple[str, ...] = ()) -> dict:
    """Write rows in the order of codes and return their counts, which the writing pass takes: no second scan. Columns
    whose name begins with _ are counted and left out. The counts stand behind the sort, whose sampling is no pass."""
    own = counts(rows.columns) | {o: F.count_if(F.col("_origin") == o) for o in origins}
    seen = Observation("rows")
    plain = [c for c in rows.columns if not c.startswith("_")]
    rows.orderBy("cep").observe(seen, *(F.coalesce(c, F.lit(0)).alias(n) for n, c in own.items())).select(*plain).write.parquet(path)
    found = seen.get
    statistics = {n: int(found[n]) for n in own if not n.startswith("_")}
    if "ibge_joined" in statistics:
        statistics["ibge_join_rate"] = round(statistics["ibge_joined"] / statistics["records"], 8) if statistics["records"] else 0.0
    return {"statistics": statistics, "rows": digest_text(statistics["records"], found["_hash_0"], found["_hash_1"])}


def rows_digest(rows: DataFrame) -> str:
    """The digest that observed_write gives, of stored rows."""
    found = rows.agg(F.count(F.lit(1)), *(F.sum(h) for h in row_hashes(rows.columns))).first()
    return digest_text(*found)


def code_identity() -> dict[str, str]:
    """This package's own code: its files by name, each with the digest of its content. The optional subpackage, which
    takes no part in a build, isn't among them."""
    root = Path(__file__).resolve().parent.parent
    files = sorted(p for p in root.rglob("*.py") if p.relative_to(root).parts[0] != "llm")
    lines = [f"{p.relative_to(root).as_posix()}\t{hashlib.sha256(p.read_bytes()).hexdigest()}" for p in files]
    return {"name": root.name, "source_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def document(version: str, written: dict, inputs: dict, settings: dict) -> dict:
    """A build's manifest; inputs: name -> identity, settings: name -> value."""
    return {"format": FORMAT, "dataset_version": version, "builder": code_identity(), "inputs": inputs, "settings": settings, "statistics": written["statistics"], "rows": written["rows"]}
