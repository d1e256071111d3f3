"""Command line: build an artifact, build one from normalized rows, look up codes, report on quality, extract map nodes, verify
locked sources, package or verify a release. Exit codes: 0 done, 1 rule broken or not found, 2 wrong call."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from postalis.config import Thresholds, load_policy, load_thresholds
from postalis.operators import build, candidate, dataset, manifest, refresh, release, report, tiers
from postalis.operators.gates import GateError
from postalis.sinks import canonical, read_jsonl
from postalis.sources import archives, containers, lock, pbf, records, shapefile, store

#: Options that name an input, whose files must stay the same while it is read.
INPUTS = ("records", "corrections", "observations", "osm", "localities", "boundaries", "config", "policy", "rows", "diff", "counts", "base", "official")


def call(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="postalis", description=__doc__)
    kinds = parser.add_subparsers(dest="kind", required=True)

    def command(name: str, text: str, *positional: str, needed: tuple[str, ...] = (), more: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        own = kinds.add_parser(name, help=text)
        for x in positional:
            own.add_argument(x)
        for x in (*needed, *more):
            own.add_argument(f"--{x}", required=x in needed)
        return own

    command("build", "from records and evidence to an artifact", needed=("records", "observations", "localities", "boundaries", "policy", "version", "output"), more=("corrections", "osm", "config", "lock", "lock-format"))
    command("build-from-normalized", "from normalized rows and their diff to an artifact", needed=("rows", "diff", "localities", "policy", "version", "output"), more=("counts", "base"))
    command("lookup", "the row of a code, as JSON", "artifact", "code", more=("version",)).add_argument("--prefix", action="store_true", help="the estimate from its prefix instead")
    command("quality", "the quality report of an artifact", "artifact", needed=("osm", "localities", "boundaries", "official", "policy", "output"))
    command("osm", "evidence from a map's nodes", "map", "output")
    own = command("sources", "verify inputs against their lock", "lock", "format", "folder")
    own.add_argument("--source", action="append", default=[])
    own.add_argument("--include-optional", action="store_true")
    command("package", "package a release", "artifact", "report", "notice", "policy", "output")
    command("release", "verify a release", "folder", "policy")
    return parser.parse_args(arguments)


def entries(spark: SparkSession, path: str):
    return archives.zip_entries(spark, path) if path.lower().endswith(".zip") else containers.directory_entries(spark, path)


def files(spark: SparkSession, path: str) -> dict:
    """Number, bytes and a digest of names and digests of a path's files, however many there are."""
    own = store.digests(spark, path).select(store.file_name(F.col("path")).alias("file"), "bytes", "sha256")
    found = own.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0)), *(F.sum(h) for h in manifest.row_hashes(own.columns))).first()
    return {"files": found[0], "bytes": found[1], "digest": manifest.digest_text(found[0], *found[2:])}


def lineage(spark: SparkSession, own: argparse.Namespace) -> dict:
    """With a lock, what it says of localities and polygons, which must be its files."""
    if not own.lock:
        return {}
    whole = lock.whole_lock(spark, own.lock, own.lock_format or "")
    return {"source_lock": whole.metadata, "sources": lock.locked_inputs(spark, whole, {"localities": own.localities, "boundaries": own.boundaries})}


def inputs_of(spark: SparkSession, own: argparse.Namespace) -> dict[str, str]:
    return {name: path for name in INPUTS if (path := getattr(own, name, None))}


def run(spark: SparkSession, own: argparse.Namespace) -> int:
    with store.unchanged(spark, *inputs_of(spark, own).values()):
        return done(spark, own)


def done(spark: SparkSession, own: argparse.Namespace) -> int:
    identities = {name: files(spark, path) for name, path in inputs_of(spark, own).items() if own.kind.startswith("build")}
    if own.kind == "build":
        fixes = records.load_corrections(spark, own.corrections) if own.corrections else None
        found = records.load_records(entries(spark, own.records), fixes)
        first = records.load_observations(spark, own.observations)
        osm = records.load_observations(spark, own.osm, map_nodes=True) if own.osm else first.limit(0)
        print(canonical(build.build(found, first, osm, containers.geopackage_localities(spark, own.localities), shapefile.polygon_edges(spark, own.boundaries), own.output, own.version, load_policy(own.policy), identities, load_thresholds(own.config) if own.config else Thresholds(), lineage(spark, own))))
    elif own.kind == "build-from-normalized":
        rows, diff, places = read_jsonl(spark, own.rows, own.version), refresh.read_diff(spark, own.diff), containers.geopackage_localities(spark, own.localities)
        counts = json.loads("\n".join(r.value for r in spark.read.text(own.counts, wholetext=True).collect())) if own.counts else None  # one document
        base, recorded = (build.read_artifact(spark, own.base), build.read_manifest(spark, own.base)["rows"]) if own.base else (None, None)
        print(canonical(candidate.write_candidate(candidate.candidate_rows(rows, diff, places, counts, base, recorded), places, own.output, own.version, load_policy(own.policy), identities, {})))
    elif own.kind == "quality":
        artifact, places = build.read_artifact(spark, own.artifact), containers.geopackage_localities(spark, own.localities)
        official = records.load_observations(spark, own.official).select("cep", "latitude", "longitude")
        inputs = report.Inputs(artifact, records.load_observations(spark, own.osm, map_nodes=True), tiers.municipality_reference(places), shapefile.polygon_edges(spark, own.boundaries), official)
        found = report.quality_report(inputs, load_policy(own.policy), build.read_metadata(spark, own.artifact)["dataset_version"])
        found = report.bound(found, build.read_manifest(spark, own.artifact))
        release.write_document(spark, canonical(found) + "\n", f"{own.output}/report")
        release.write_document(spark, report.markdown(found), f"{own.output}/markdown")
        return 0 if found["status"] == "pass" else 1
    elif own.kind == "osm":
        print(canonical(pbf.extract(spark, own.map, own.output)))
    elif own.kind == "sources":
        lock.verify_sources(spark, own.folder, lock.selected(lock.load_lock(spark, own.lock, own.format), tuple(own.source), own.include_optional))
    elif own.kind == "package":
        found, notice = (release.read_document(spark, p) for p in (own.report, own.notice))
        found, policy, made = json.loads(found), load_policy(own.policy), build.read_manifest(spark, own.artifact)
        if problems := report.binding_problems(found, made, policy):
            raise GateError("; ".join(problems))
        credits = tuple(sorted({s["attribution"] for s in made["settings"].get("sources", [])}))
        release.package(build.read_artifact(spark, own.artifact), found, policy, own.output, notice, credits)
    elif own.kind == "release":
        release.verify(spark, own.folder, load_policy(own.policy))
    else:
        handle = dataset.open_dataset(spark, own.artifact, own.version or build.read_metadata(spark, own.artifact).get("dataset_version", ""))
        found = handle.find_prefix(own.code) if own.prefix else handle.find(own.code)
        row = found["estimate" if own.prefix else "row"]
        if row is None:
            return 1
        print(canonical(row))
    return 0


def main(arguments: list[str] | None = None) -> int:
    own = call(sys.argv[1:] if arguments is None else arguments)
    try:
        return run(SparkSession.builder.getOrCreate(), own)
    except (GateError, ValueError, OSError, AnalysisException) as error:
        print(error, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
