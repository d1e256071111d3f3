"""Rules of a single row of the artifact: keys, texts, and a geography that is whole or absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalis.config import TIERS
from postalis.functions import STATES, in_bounds, valid_digest
from postalis.operators.gates import failed_rules

# Most bytes of texts, of a method and of the sources as JSON; form of a source.
MOST_BYTES = {"street": 4096, "complement": 4096, "unit": 1024, "neighborhood": 4096, "city": 512, "state": 512, "region": 512}
MOST_METHOD, MOST_SOURCES, MOST_SOURCE_BYTES = 128, 16, 2048
SOURCE = "^[a-z0-9][a-z0-9_.:-]{0,63}$"
GEO = ["latitude", "longitude", "precision", "method", "evidence_count", "evidence_radius_km", "geo_source", "evidence_digest"]


def rules(columns: list[str], version: str | Column | None = None) -> dict[str, Column]:
    """name -> condition that a sound row meets; rules of a located row hold for others too."""
    c, absent = F.col, F.col("latitude").isNull()
    sources, seen = c("geo_source"), [c(n).isNull().cast("int") for n in GEO]
    found = {
        "cep": c("cep").rlike("^[0-9]{8}$"),
        "prefix": c("prefix") == F.substring("cep", 1, 5),
        "ibge": c("ibge").rlike("^[0-9]{7}$"),
        "uf": c("uf").isin(*STATES),
        "city": F.trim("city") != "",
        "geo_whole": sum(seen[1:], seen[0]).isin(0, len(GEO)),
        "bounds": absent | (~F.isnan("latitude") & ~F.isnan("longitude") & in_bounds(c("latitude"), c("longitude"))),
        "precision": absent | c("precision").isin(*TIERS),
        "method": absent | ((F.trim("method") != "") & (F.octet_length("method") <= MOST_METHOD)),
        "evidence_count": absent | (c("evidence_count") >= 1),
        "evidence_radius": absent | ((c("evidence_radius_km") >= 0) & (c("evidence_radius_km") < float("inf"))),
        "sources": absent | (F.size(sources).between(1, MOST_SOURCES) & F.forall(sources, lambda x: F.coalesce(x.rlike(SOURCE), F.lit(False))) & (sources == F.array_sort(F.array_distinct(sources)))),
        "source_bytes": absent | (F.octet_length(F.to_json(sources)) <= MOST_SOURCE_BYTES),
        "digest": absent | valid_digest(c("evidence_digest")),
    }
    found |= {f"{n}_bytes": F.coalesce(F.octet_length(n), F.lit(0)) <= most for n, most in MOST_BYTES.items() if n in columns}
    if version is not None:
        found["version"] = c("dataset_version") == (version if isinstance(version, Column) else F.lit(version))
    return found


def row_problems(rows: DataFrame, version: str | Column | None = None) -> DataFrame:
    """(cep, failed): rows with the sorted names of the rules that they break."""
    return rows.select("cep", failed_rules(**rules(rows.columns, version)).alias("failed")).filter(F.size("failed") > 0)
