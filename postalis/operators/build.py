"""A build from records to the artifact: rows with their estimate, gated, stored sorted by code with its metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.config import TIERS, QualityPolicy, Thresholds
from postalis.functions import clean_text, municipality_code, postal_code
from postalis.operators import containment, manifest, report, tiers
from postalis.operators.contract import row_problems
from postalis.operators.gates import GateError, require_empty

#: Column of an address row -> field of the record.
TEXTS = {"street": "logradouro", "complement": "complemento", "unit": "unidade", "neighborhood": "bairro", "city": "localidade", "uf": "uf", "state": "estado", "region": "regiao"}
# Fixed value: the stored table's format.
FORMAT = "postalis-parquet-v1"


def address_rows(records: DataFrame) -> DataFrame:
    """Records (text fields of the input) as address rows: normalised codes, trimmed texts, empty ones null."""
    texts = (clean_text(F.col(field)).alias(name) for name, field in TEXTS.items())
    return records.select(postal_code(F.col("cep")).alias("cep"), *texts, municipality_code(F.col("ibge")).alias("ibge"))


def record_problems(addresses: DataFrame) -> DataFrame:
    """(cep, problem) of address rows that a build fails by."""
    problem = F.when(F.col("cep").isNull(), "invalid code").when(F.col("ibge").isNull(), "invalid municipality").when(F.col("city").isNull() | F.col("uf").isNull(), "no city or state")
    return addresses.select("cep", problem.alias("problem")).filter("problem is not null")


def estimated_rows(addresses: DataFrame, first_party: DataFrame, osm: DataFrame, localities: DataFrame, version: str, t: Thresholds = Thresholds()) -> DataFrame:
    """Address rows as flat rows of the artifact, without any gate: see build_rows."""
    municipalities = tiers.municipality_reference(localities)
    rows = tiers.resolve(addresses, first_party, osm, municipalities, t)
    for tier, found in tiers.digests(addresses, first_party, osm, municipalities, localities, t).items():
        rows = rows.join(found.withColumnRenamed("evidence_digest", f"_{tier}"), [c for c in found.columns if c != "evidence_digest"], "left")
    digest = F.coalesce(*(F.when(F.col("precision") == tier, F.col(f"_{tier}")) for tier in TIERS))
    method = F.coalesce(*(F.when(F.col("precision") == tier, F.lit(m)) for tier, m in tiers.METHODS.items()))
    names = [c for c in ("cep", "prefix", *TEXTS, "ibge") if c in rows.columns]
    return rows.select(
        *names, "latitude", "longitude", "precision", method.alias("method"), "evidence_count", F.col("radius_km").alias("evidence_radius_km"),
        F.split("geo_source", ",").alias("geo_source"), digest.alias("evidence_digest"), F.lit(version).alias("dataset_version"),
    )


def polygon_eligible(osm: DataFrame, addresses: DataFrame, edges: DataFrame) -> DataFrame:
    """Map nodes without those outside the polygon of their code's municipality; codes nobody knows stay. Every
    municipality of an observed code must have a polygon."""
    require_empty(containment.missing_polygons(osm, addresses, edges), "municipalities without a polygon")
    return containment.select(osm, addresses, edges).filter("eligible").select(*(c for c in osm.columns if c != "ibge"), F.lit(None).cast("string").alias("ibge")).select(*osm.columns)


def build_rows(records: DataFrame, first_party: DataFrame, osm: DataFrame, localities: DataFrame, version: str, t: Thresholds = Thresholds(), edges: DataFrame | None = None) -> DataFrame:
    """The artifact's rows from the inputs, after every rule about them held; with polygon edges, only map nodes that lie in
    their municipality count."""
    addresses = address_rows(records)
    if edges is not None:
        osm = polygon_eligible(osm, addresses, edges)
    require_empty(record_problems(addresses), "unfit records")
    tiers.require_sound(addresses, first_party, osm)
    tiers.require_references(tiers.municipality_reference(localities))
    return estimated_rows(addresses, first_party, osm, localities, version, t)


def build_statistics(rows: DataFrame, municipalities: DataFrame) -> DataFrame:
    """One row: records, those whose municipality has a reference, their share, located, unresolved and each tier."""
    joined = rows.join(municipalities.select("ibge", F.lit(1).alias("_there")), "ibge", "left")
    tier = {f"tier_{t}": F.count_if(F.col("precision") == t) for t in TIERS} | {"tier_unresolved": F.count_if(F.col("precision").isNull())}
    return joined.agg(
        F.count("*").alias("input_records"), F.countDistinct("cep").alias("unique_ceps"), F.count("_there").alias("ibge_joined"),
        F.round(F.coalesce(F.count("_there") / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 8).alias("ibge_join_rate"),
        F.count("latitude").alias("located"), (F.count("*") - F.count("latitude")).alias("unresolved"), *(c.alias(n) for n, c in tier.items()),
    )


def write_artifact(rows: DataFrame, folder: str, **metadata: str) -> dict:
    """Rows sorted by code, so that file statistics prune point lookups, and key-value metadata beside them; the counts and
    digest that the writing pass took are returned."""
    require_empty(row_problems(rows).select("cep", "failed"), "rows against the contract")
    written = manifest.observed_write(rows, f"{folder}/rows")
    write_metadata(rows.sparkSession, folder, metadata)
    return written


def write_metadata(spark: SparkSession, folder: str, metadata: dict[str, str]) -> None:
    pairs = sorted({"format": FORMAT, **metadata}.items())
    spark.createDataFrame(pairs, "key string, value string").coalesce(1).write.parquet(f"{folder}/metadata")


def store(rows: DataFrame, folder: str, version: str, policy: QualityPolicy, inputs: dict, settings: dict, origins: tuple[str, ...] = ()) -> dict:
    """Write a build: rows with their counts, then, if the stored rows keep contract and policy, metadata and manifest.
    Columns beginning with _ are counted, not stored. A folder without a manifest is no build."""
    spark = rows.sparkSession
    written = manifest.observed_write(rows, f"{folder}/rows", origins)
    stored = spark.read.parquet(f"{folder}/rows")
    require_empty(row_problems(stored, version).select("cep", "failed"), "rows against the contract")
    require_empty(stored.groupBy("cep").count().filter("count > 1").select("cep"), "codes that stand twice")
    report.require_quality(stored, policy)
    found = manifest.document(version, written, inputs, settings | {"quality_version": policy.version, "quality_sha256": policy.sha256})
    write_metadata(spark, folder, {"dataset_version": version, **{f"count_{k}": str(v) for k, v in written["statistics"].items()}})
    spark.createDataFrame([(json.dumps(found, ensure_ascii=False, sort_keys=True, separators=(",", ":")),)], "value string").coalesce(1).write.text(f"{folder}/manifest")
    return found


def read_manifest(spark: SparkSession, folder: str) -> dict:
    found = json.loads(spark.read.text(f"{folder}/manifest", wholetext=True).first()[0])
    if found.get("format") != manifest.FORMAT:
        raise GateError(f"not a build of format {manifest.FORMAT}")
    return found


def build(records: DataFrame, first_party: DataFrame, osm: DataFrame, localities: DataFrame, edges: DataFrame, folder: str, version: str, policy: QualityPolicy, inputs: dict, t: Thresholds = Thresholds(), lineage: dict | None = None) -> dict:
    """From inputs to a stored build and its manifest; lineage: the lock and the locked sources that the inputs are."""
    rows = build_rows(records, first_party, osm, localities, version, t, edges)
    known = tiers.municipality_reference(localities).select("ibge", F.lit(True).alias("_joined"))
    marked = rows.join(known, "ibge", "left").withColumn("_joined", F.coalesce("_joined", F.lit(False)))
    return store(marked, folder, version, policy, inputs, {"thresholds": {k: v for k, v in sorted(vars(t).items())}, **(lineage or {})})


def read_metadata(spark: SparkSession, folder: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.read.schema("key string, value string").parquet(f"{folder}/metadata").collect()}  # a few keys


def read_artifact(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows, if their format and version are what the metadata say."""
    metadata = read_metadata(spark, folder)
    if metadata.get("format") != FORMAT or not metadata.get("dataset_version"):
        raise GateError(f"not an artifact of format {FORMAT}: {json.dumps(metadata)[:200]}")
    rows = spark.read.parquet(f"{folder}/rows")
    require_empty(rows.filter(~F.col("dataset_version").eqNullSafe(F.lit(metadata["dataset_version"]))).select("cep", "dataset_version"), "rows of another version than the metadata's")
    return rows


def verify_artifact(rows: DataFrame, version: str) -> DataFrame:
    """One row: records, rows of another version, located rows."""
    return rows.agg(F.count("*").alias("records"), F.count_if(~F.col("dataset_version").eqNullSafe(F.lit(version))).alias("version_mismatches"), F.count("latitude").alias("located"))
