"""A release: the artifact, its exports, the quality report and a manifest of all parts; and its verification."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.config import QualityPolicy
from postalis.operators import build, refresh, report
from postalis.operators.contract import row_problems
from postalis.operators.gates import GateError, require_empty
from postalis.sinks import FLAT, canonical, part_digests, read_jsonl, write_csv, write_jsonl

# Fixed value: the manifest's format.
FORMAT = "postalis-release-v1"
PARTS = ("artifact/rows", "artifact/metadata", "jsonl", "csv", "report", "markdown", "notice")
# Who must be named where a source category of their data stands in the rows.
CREDITS = {"openstreetmap": "OpenStreetMap", "ibge-localidades": "IBGE", "ibge-localidades-administrative": "IBGE"}


def notice_problems(rows: DataFrame, notice: str, credits: tuple[str, ...] = ()) -> list[str]:
    """Names that a notice lacks: those of the rows' sources, and what the locked inputs ask for."""
    categories = {r.c for r in rows.select(F.explode("geo_source").alias("c")).distinct().collect()}  # a few categories
    return sorted(n for n in {CREDITS[c] for c in categories if c in CREDITS} | set(credits) if n not in notice)


def sums_of(parts: dict[str, list[dict]]) -> str:
    """A line a file: digest and place, in order of places."""
    return "".join(f"{digest}  {place}\n" for place, digest in sorted((f"{part}/{f['file']}", f["sha256"]) for part, files in parts.items() for f in files))


def write_document(spark: SparkSession, text: str, folder: str) -> None:
    """A small document as the single part of a folder, in any store that Spark reaches."""
    spark.createDataFrame([(text.removesuffix("\n"),)], "value string").coalesce(1).write.text(folder)


def read_document(spark: SparkSession, folder: str) -> str:
    return spark.read.text(folder, wholetext=True).first()[0]


def contents(spark: SparkSession, folder: str) -> dict[str, list[dict]]:
    """Part -> its files' names, sizes and digests, by name."""
    return {name: files_of(spark, f"{folder}/{name}") for name in PARTS}


def files_of(spark: SparkSession, folder: str) -> list[dict]:
    return [r.asDict() for r in part_digests(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "bytes", "sha256").orderBy("file").collect()]  # a row a file


def package(rows: DataFrame, found: dict, policy: QualityPolicy, folder: str, notice: str, credits: tuple[str, ...] = ()) -> dict:
    """Write a release of flat rows with their passed report and a notice that names all sources; manifest and sums, which
    come last, make it complete."""
    if report.report_problems(found, policy) or found["status"] != "pass":
        raise GateError("only a sound report that passed is released")
    spark, version = rows.sparkSession, found["dataset_version"]
    require_empty(row_problems(rows, version).select("cep", "failed"), "rows against the contract")
    require_empty(rows.groupBy("cep").count().filter("count > 1").select("cep"), "codes that stand twice")
    if lacking := notice_problems(rows, notice, credits):
        raise GateError(f"the notice doesn't name {', '.join(lacking)}")
    build.write_artifact(rows, f"{folder}/artifact", dataset_version=version)
    stored = build.read_artifact(spark, f"{folder}/artifact")
    write_jsonl(stored, f"{folder}/jsonl")
    write_csv(stored, f"{folder}/csv")
    write_document(spark, canonical(found) + "\n", f"{folder}/report")
    write_document(spark, report.markdown(found), f"{folder}/markdown")
    write_document(spark, notice, f"{folder}/notice")
    manifest = {"format": FORMAT, "dataset_version": version, "quality_version": policy.version, "records": stored.count(), "credits": list(credits), "contents": contents(spark, folder)}
    write_document(spark, canonical(manifest) + "\n", f"{folder}/manifest")
    write_document(spark, sums_of(manifest["contents"] | {"manifest": files_of(spark, f"{folder}/manifest")}), f"{folder}/sums")
    return manifest


def export_problems(spark: SparkSession, folder: str) -> DataFrame:
    """(cep, difference): rows of the JSON lines that aren't the artifact's."""
    stored = build.read_artifact(spark, f"{folder}/artifact").select(*FLAT)
    lines = read_jsonl(spark, f"{folder}/jsonl").select(*FLAT)
    kinds = dict(stored.dtypes)
    return refresh.compare(stored, lines.select(*(F.col(c).cast(kinds[c]).alias(c) for c in FLAT)))


def verify(spark: SparkSession, folder: str, policy: QualityPolicy) -> dict:
    """The manifest of a release, after every part has the digest it names, the report follows from the policy and passed,
    the rows keep the contract, and the exports hold the artifact's rows."""
    manifest = json.loads(read_document(spark, f"{folder}/manifest"))
    if manifest.get("format") != FORMAT or manifest.get("quality_version") != policy.version:
        raise GateError("not a release of this format and policy")
    if manifest["contents"] != contents(spark, folder):
        raise GateError("parts differ from the manifest")
    if read_document(spark, f"{folder}/sums") != sums_of(manifest["contents"] | {"manifest": files_of(spark, f"{folder}/manifest")}):
        raise GateError("files differ from their sums")
    found = json.loads(read_document(spark, f"{folder}/report"))
    if problems := report.report_problems(found, policy):
        raise GateError("; ".join(problems))
    if report.markdown(found) != read_document(spark, f"{folder}/markdown"):
        raise GateError("the Markdown isn't the report's")
    stored = build.read_artifact(spark, f"{folder}/artifact")
    counted = build.verify_artifact(stored, manifest["dataset_version"]).first()
    if found["status"] != "pass" or counted.version_mismatches or not counted.records == manifest["records"] == found["artifact"]["record_count"] or counted.located != found["artifact"]["located"]:
        raise GateError("artifact, report and manifest disagree")
    require_empty(row_problems(stored, manifest["dataset_version"]).select("cep", "failed"), "rows against the contract")
    require_empty(export_problems(spark, folder), "exports against the artifact")
    if lacking := notice_problems(stored, read_document(spark, f"{folder}/notice"), tuple(manifest["credits"])):
        raise GateError(f"the notice doesn't name {', '.join(lacking)}")
    return manifest
