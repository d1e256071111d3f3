"""A build from normalized rows: a candidate with its diff, gated, with its gaps filled from references whose evidence is
digested, and stored with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.config import QualityPolicy
from postalis.operators import build, chain, identities, manifest, refresh, tiers
from postalis.operators.contract import row_problems
from postalis.operators.gates import GateError, require_empty


def references(candidate: DataFrame, localities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Municipality references, and administrative ones for codes of unlocated rows that have none, both with the digest of
    the localities they rest on."""
    municipalities = tiers.municipality_reference(localities)
    administrative = tiers.administrative_reference(localities, refresh.unreferenced(candidate, municipalities))
    return municipalities.join(tiers.locality_digests(localities), "ibge"), administrative.join(tiers.administrative_digests(localities), "ibge")


def candidate_rows(candidate: DataFrame, diff: DataFrame, localities: DataFrame, counts: dict[str, int] | None = None, base: DataFrame | None = None, recorded: str | None = None) -> DataFrame:
    """A candidate's rows with every gap filled (_origin: one of refresh.ORIGINS), after diff, declared counts, inheritance
    and filled rows kept their rules. candidate: flat rows; base: the rows of the release before."""
    refresh.require_diff(diff)
    require_empty(diff.select("cep").join(candidate.select("cep"), "cep", "left_anti"), "diff rows that the candidate lacks")
    require_empty(candidate.select("cep").join(diff.select("cep"), "cep", "left_anti"), "rows that the diff lacks")
    require_empty(candidate.filter(~F.col("precision").isin(*refresh.CANDIDATE_PRECISIONS)).select("cep", "precision"), "precisions that no candidate has")
    if counts is not None:
        identities.require_counts(counts, candidate, diff)
    if base is not None:
        chain.require_inherited(base, candidate, diff, recorded)
    filled = refresh.fill_null_geo(candidate, *references(candidate, localities))
    require_empty(filled.filter(F.col("origin") == refresh.ORIGINS[3]).select("cep"), "rows that no reference fills")
    require_empty(row_problems(filled.drop("origin")).select("cep", "failed"), "filled rows against the contract")
    return filled.withColumnRenamed("origin", "_origin")


def write_candidate(rows: DataFrame, localities: DataFrame, folder: str, version: str, policy: QualityPolicy, inputs: dict, settings: dict) -> dict:
    """Store candidate_rows' result with its manifest, if the stored rows keep the policy; the manifest comes last."""
    names = localities.select("ibge").distinct().withColumn("_joined", F.lit(True))
    marked = rows.join(names, "ibge", "left").withColumn("_joined", F.coalesce("_joined", F.lit(False)))
    if rows.filter(F.col("dataset_version") != version).take(1):
        raise GateError(f"rows of another version than {version}")
    return build.store(marked, folder, version, policy, inputs, settings, refresh.ORIGINS[:3])


def verify_stored(spark, folder: str) -> dict:
    """The manifest of a stored build, after its rows were those it records."""
    found = build.read_manifest(spark, folder)
    if manifest.rows_digest(spark.read.parquet(f"{folder}/rows")) != found["rows"]:
        raise GateError("the stored rows aren't those of their manifest")
    return found

