"""Address records, corrections and observations: parsing with explicit schemas, and the rules that reject bad input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.functions import clean_text, float_hex, municipality_code, postal_code
from postalis.operators.centroid import evidence_conflicts
from postalis.operators.gates import GateError, require_empty

# The fields of an address record and of a correction.
FIELDS = ["cep", "logradouro", "complemento", "unidade", "bairro", "localidade", "uf", "estado", "regiao", "ibge"]
CORRECTION = ["member", "source_sha256", "field", "from", "to", "reason"]


def strings(names: list[str]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def records(entries: DataFrame) -> DataFrame:
    """entries (member, content) as (member, sha256, the record's fields). UTF-8 with or without a byte order mark; text
    that isn't one JSON object fails the job."""
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^﻿", "")
    parsed = F.from_json(text, strings(FIELDS), {"mode": "FAILFAST"})
    rows = entries.select("member", F.sha2("content", 256).alias("sha256"), F.when(F.ltrim(text).startswith("{"), parsed).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("member")))).alias("r"))
    return rows.select("member", "sha256", "r.*")


def load_corrections(spark: SparkSession, path: str) -> DataFrame:
    """The corrections of a document: all fields given, a SHA-256 of 64 characters, one correction a member."""
    shape = f"corrections array<struct<{', '.join(f'`{n}`: string' for n in CORRECTION)}>>"
    found = spark.read.schema(shape).option("multiLine", True).option("mode", "FAILFAST").json(path).select(F.inline("corrections"))
    full = F.lit(True)
    for name in CORRECTION:
        full = full & F.coalesce(F.col(f"`{name}`") != "", F.lit(False))
    if found.isEmpty():
        raise GateError("no corrections")
    require_empty(found.filter(~(full & (F.length("source_sha256") == 64))).select("member"), "incomplete corrections")
    require_empty(found.groupBy("member").count().filter("count > 1").select("member"), "members corrected twice")
    return found


def _matched(rows: DataFrame, corrections: DataFrame, fields: list[str]) -> DataFrame:
    """rows with the correction c of their member, and ok: file and current value are those the correction expects."""
    own = corrections.select("member", F.struct(*(F.col(f"`{n}`").alias(n) for n in CORRECTION)).alias("c"))
    current = F.coalesce(*(F.when(F.col("c.field") == n, F.col(n)) for n in fields))
    return rows.join(own, "member", "left").withColumn("ok", F.coalesce((F.col("sha256") == F.col("c.source_sha256")) & (current == F.col("c.from")), F.lit(False)))


def correct(rows: DataFrame, corrections: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """rows (member, sha256, fields) with the fitting corrections applied; correction_violations has the others."""
    both = _matched(rows, corrections, fields)
    return both.select(*(c if c not in fields else F.when(F.col("ok") & (F.col("c.field") == c), F.col("c.to")).otherwise(F.col(c)).alias(c) for c in rows.columns))


def correction_violations(rows: DataFrame, corrections: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """(member, problem): corrections of no member (unused), or that expect another file or value (stale)."""
    stale = _matched(rows, corrections, fields).filter("c is not null and not ok").select("member", F.lit("stale").alias("problem"))
    return stale.unionByName(corrections.join(rows, "member", "left_anti").select("member", F.lit("unused").alias("problem")))


def misnamed(rows: DataFrame) -> DataFrame:
    """(member, cep): members whose name is a code, but not their record's."""
    stem = F.regexp_extract("member", r"([^/]*)\.[^./]*$", 1)
    return rows.filter(stem.rlike("^[0-9]{8}$") & ~stem.eqNullSafe(postal_code(F.col("cep")))).select("member", "cep")


def load_records(entries: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """Records with corrections, after all their rules held."""
    rows = records(entries)
    if corrections is not None:
        require_empty(correction_violations(rows, corrections), "corrections that don't fit")
        rows = correct(rows, corrections)
    require_empty(misnamed(rows), "members named after another code")
    return rows


def evidence_identity(explicit, source, cep, ibge, latitude, longitude):
    """The given identity, else a map node's name, else a digest of source and place."""
    place = F.concat_ws("|", source, cep, F.coalesce(ibge, F.lit("")), float_hex(latitude), float_hex(longitude))
    return F.coalesce(clean_text(explicit), F.when(source.startswith("openstreetmap:"), source), F.concat(F.lit("sha256:"), F.sha2(place, 256)))


def parse_observations(raw: DataFrame) -> DataFrame:
    """raw string columns as evidence (evidence_id, cep, ibge, latitude, longitude, source), with problem (null: fine)."""
    column = lambda name: F.col(name) if name in raw.columns else F.lit(None).cast("string")
    cep, given, source = postal_code(column("cep")), clean_text(column("ibge")), clean_text(column("source"))
    lat, lon = (F.expr(f"try_cast(trim({n}) as double)") for n in ("latitude", "longitude"))
    ibge = municipality_code(given)
    placed = F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))  # NaN is above all numbers
    problem = F.when(cep.isNull(), "invalid code").when(given.isNotNull() & ibge.isNull(), "invalid municipality").when(source.isNull(), "no source").when(~placed, "invalid place")
    return raw.select(evidence_identity(column("evidence_id"), source, cep, ibge, lat, lon).alias("evidence_id"), cep.alias("cep"), ibge.alias("ibge"), lat.alias("latitude"), lon.alias("longitude"), source.alias("source"), problem.alias("problem"), column("evidence_id").alias("_given"))


def load_observations(spark: SparkSession, path: str, require_evidence_id: bool = False, map_nodes: bool = False) -> DataFrame:
    """Evidence of a CSV file: invalid rows and identities of two places are errors, equal repetitions count once.
    map_nodes: only map nodes, which name no municipality."""
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if missing := {"cep", "latitude", "longitude", "source"} - set(raw.columns):
        raise GateError(f"columns missing: {sorted(missing)}")
    rows = parse_observations(raw)
    require_empty(rows.filter("problem is not null").select("cep", "source", "problem"), "invalid observations")
    if require_evidence_id:
        require_empty(rows.filter(clean_text(F.col("_given")).isNull()).select("cep"), "observations without identity")
    if map_nodes:
        require_empty(rows.filter(~F.col("source").startswith("openstreetmap:") | F.col("ibge").isNotNull()).select("source"), "not map nodes")
    rows = rows.drop("problem", "_given")
    require_empty(evidence_conflicts(rows.withColumn("source", F.concat_ws("|", "source", "cep", F.coalesce("ibge", F.lit(""))))), "identities of several places")
    return rows.dropDuplicates(["evidence_id"])
