"""The quality report: two hold-out cohorts with their own inputs, raw diagnostics, purposes, an official sample, and every
check of a policy. Spark sums up; what reaches the driver is one row a cohort, state, purpose or check."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.config import BUILD, COHORTS, TIERS, QualityPolicy, Thresholds
from postalis.functions import STATES
from postalis.operators import containment, evaluation
from postalis.operators.gates import GateError
from postalis.operators.settled import settle
from postalis.sinks import canonical

# Fixed value: the report's format.
FORMAT = "postalis-quality-report-v1"
CHECK = "name string, passed boolean, actual string, threshold string"


@dataclass(frozen=True)
class Inputs:
    """What a report is about: the artifact, raw map nodes, municipality references, polygon edges, an official sample. The
    artifact is read by several sums, so it is best a stored one; addresses: its codes with municipality, state, street and
    neighbourhood, where they can be had without its estimates."""

    artifact: DataFrame
    osm: DataFrame
    municipalities: DataFrame
    edges: DataFrame
    official: DataFrame
    addresses: DataFrame | None = None

    @property
    def known(self) -> DataFrame:
        return (self.artifact if self.addresses is None else self.addresses).select("cep", "ibge", "uf", "street", "neighborhood")


def cohort_inputs(inputs: Inputs, t: Thresholds = Thresholds(), cohort: str | None = None) -> dict[str, DataFrame]:
    """cohort -> map nodes. Leave-observation-out takes what production retains of the nodes in their polygon; unseen codes
    take all of the nodes in their polygon, since training applies production's rules itself. Both are read for training
    and for what is held out, so the nodes in their polygon are computed once, and what production retains of them too
    where it is asked for."""
    eligible = settle(containment.select(inputs.osm, inputs.known, inputs.edges).filter("eligible").select(*inputs.osm.columns))
    if cohort == "unseen_cep":
        return {cohort: eligible}
    retained = settle(evaluation.production_eligible(eligible, inputs.known, inputs.municipalities, t).filter("exclusion_reason is null").drop("exclusion_reason"))
    return {"leave_observation_out": retained, "unseen_cep": eligible}


def cohort_outcomes(osm: DataFrame, inputs: Inputs, cohort: str, modulus: int = 5, remainder: int = 0, t: Thresholds = Thresholds()) -> DataFrame:
    """Outcomes of a cohort's held-out nodes: single observations, or whole codes."""
    parted = evaluation.split(osm, modulus, remainder, by_code=cohort == "unseen_cep")
    return evaluation.outcomes(parted, inputs.known, inputs.municipalities, t)


def all_outcomes(inputs: Inputs, policy: QualityPolicy, t: Thresholds = Thresholds()) -> DataFrame:
    """Outcomes of both cohorts, of both on raw nodes (raw_...), and of the official sample, marked by cohort."""
    modulus, remainder = policy.at("validation", "modulus"), policy.at("validation", "remainder")
    tables = [(name, cohort_outcomes(osm, inputs, name, modulus, remainder, t)) for name, osm in cohort_inputs(inputs, t).items()]
    tables += [(f"raw_{name}", cohort_outcomes(inputs.osm, inputs, name, modulus, remainder, t)) for name in COHORTS]
    tables += [("official_pilot", evaluation.official_outcomes(inputs.official, inputs.artifact))]
    out = None
    for name, rows in tables:
        rows = rows.select(F.lit(name).alias("cohort"), "cep", "outcome", "uf", "address_class", "precision", "error_km")
        out = rows if out is None else out.unionByName(rows)
    return out


def build_checks(statistics: dict, policy: QualityPolicy) -> list[str]:
    """What of a build's statistics breaks the policy."""
    out = []
    for name, (kind, bound) in BUILD.items():
        limit = policy.at("build_thresholds", bound)
        if (statistics[name] < limit) if kind == "min" else (statistics[name] > limit):
            out.append(f"{name}={statistics[name]} breaks {bound}={limit}")
    allowed = policy.at("build_thresholds", "allowed_precision_tiers")
    out += [f"tier {t} isn't allowed" for t in TIERS if statistics[f"tier_{t}"] and t not in allowed]
    return out


def require_quality(artifact: DataFrame, policy: QualityPolicy) -> dict:
    """The artifact's statistics; those that break the policy are an error."""
    statistics = evaluation.artifact_statistics(artifact).first().asDict()
    if failures := build_checks(statistics, policy):
        raise GateError("quality gate: " + "; ".join(failures))
    return statistics


def checks(statistics: dict, selection: dict, cohorts: dict[str, dict], metrics: dict[str, dict[str, dict]], purposes: dict[str, dict], policy: QualityPolicy) -> list[dict]:
    """Every check of the policy: name, passed, actual, threshold. metrics: cohort -> metric -> its row."""
    out: list[dict] = []

    def check(name: str, passed: bool, actual: object, threshold: object) -> None:
        out.append({"name": name, "passed": bool(passed), "actual": actual, "threshold": threshold})

    def bounded(name: str, actual: float | None, limit: float, least: bool = False) -> None:
        check(name, actual is not None and (actual >= limit if least else actual <= limit), actual, limit)

    at = lambda *path: policy.at("validation", *path)
    failures = build_checks(statistics, policy)
    check("artifact_build_policy", not failures, failures, [])
    name = "maximum_outside_target_municipality_fraction"
    bounded(f"osm_evidence.{name}", selection["outside_fraction"], at("osm_evidence", name))
    for name in COHORTS:
        own, limits = cohorts[name], at("cohorts", name)
        bounded(f"{name}.minimum_records", own["evaluated"], limits["minimum_records"], least=True)
        bounded(f"{name}.maximum_missing_fraction", own["missing_fraction"], limits["maximum_missing_fraction"])
        bounded(f"{name}.maximum_prediction_failure_fraction", own["failure_fraction"], limits["maximum_prediction_failure_fraction"])
        bounded(f"{name}.minimum_ufs", own["uf_count"], limits["minimum_ufs"], least=True)
        found, needed = set(filter(None, own["address_classes"].split(","))), set(limits["required_address_classes"])
        check(f"{name}.required_address_classes", needed <= found, sorted(found), sorted(needed))
    per = metrics[at("per_uf", "cohort")]
    for uf in sorted(at("per_uf", "required_ufs")):
        row, limits = per.get(f"uf:{uf}", {"n": 0, "p95_km": None}), at("per_uf", "thresholds", uf)
        bounded(f"per_uf.{uf}.minimum_samples", row["n"], limits["minimum_samples"], least=True)
        bounded(f"per_uf.{uf}.maximum_p95_km", row["p95_km"], limits["maximum_p95_km"])
    for name in sorted(at("purposes")):
        bounded(f"purpose.{name}.minimum_records", purposes[name]["n"], at("purposes", name, "minimum_records"), least=True)
        bounded(f"purpose.{name}.maximum_p95_km", purposes[name]["p95_km"], at("purposes", name, "maximum_p95_km"))
    own, limits = cohorts["official_pilot"], at("official_pilot")
    bounded("official_pilot.minimum_records", own["evaluated"], limits["minimum_records"], least=True)
    bounded("official_pilot.maximum_missing_fraction", own["missing_fraction"], limits["maximum_missing_fraction"])
    bounded("official_pilot.maximum_prediction_failure_fraction", own["failure_fraction"], limits["maximum_prediction_failure_fraction"])
    found = sorted(filter(None, own["ufs"].split(",")))
    check("official_pilot.expected_ufs", found == sorted(limits["expected_ufs"]), found, sorted(limits["expected_ufs"]))
    bounded("official_pilot.maximum_p95_km", metrics["official_pilot"].get("overall", {}).get("p95_km"), limits["maximum_p95_km"])
    return out


def check_names(policy: QualityPolicy) -> list[str]:
    """The names that a complete report's checks have, in order."""
    none = {"outside_fraction": None}
    cohorts = {n: {"evaluated": 0, "missing_fraction": 0, "failure_fraction": 0, "uf_count": 0, "ufs": "", "address_classes": ""} for n in (*COHORTS, "official_pilot")}
    statistics = dict.fromkeys(BUILD, 0) | {f"tier_{t}": 0 for t in TIERS}
    purposes = {n: {"n": 0, "p95_km": None} for n in policy.at("validation", "purposes")}
    return [c["name"] for c in checks(statistics, none, cohorts, {n: {} for n in cohorts}, purposes, policy)]


def quality_report(inputs: Inputs, policy: QualityPolicy, version: str, t: Thresholds = Thresholds()) -> dict:
    """The report as a document. References and outcomes are read by several sums, so they are computed once."""
    inputs = replace(inputs, municipalities=settle(inputs.municipalities))
    rows = settle(all_outcomes(inputs, policy, t))
    cohorts = {r.cohort: {k: v for k, v in r.asDict().items() if k != "cohort"} for r in evaluation.cohort(rows.groupBy("cohort")).collect()}  # five rows
    empty = evaluation.cohort(rows.limit(0)).first().asDict()
    cohorts = {n: cohorts.get(n, empty) for n in (*COHORTS, *(f"raw_{n}" for n in COHORTS), "official_pilot")}
    good = rows.filter(F.col("outcome") == evaluation.EVALUATED)
    none = {"n": 0, "p50_km": None, "p90_km": None, "p95_km": None}
    metrics: dict[str, dict[str, dict]] = {n: {f"precision:{t}": none for t in TIERS} for n in cohorts}
    for r in evaluation.grouped_metrics(good, "cohort").collect():  # a row a cohort and group of states and tiers
        metrics[r.cohort][r.metric] = {k: r[k] for k in none}
    purposes = {}
    for name, own in sorted(policy.at("validation", "purposes").items()):
        sample = good.filter(F.col("cohort") == own["cohort"])
        purposes[name] = evaluation.purpose_metrics(sample, own["allowed_precision_tiers"], own.get("ufs")).first().asDict() | {"cohort": own["cohort"], "ufs": sorted(own.get("ufs", STATES))}
    selected = containment.select(inputs.osm, inputs.known, inputs.edges)
    selection = containment.selection_statistics(selected).first().asDict()
    eligible = selected.filter("eligible").select(*inputs.osm.columns)
    excluded = {r.reason: r.n for r in evaluation.exclusion_counts(evaluation.production_eligible(eligible, inputs.known, inputs.municipalities, t)).collect()}  # four rows
    retained = excluded.pop("retained")
    if selection["outside"] + sum(excluded.values()) != selection["observations"] - retained:
        raise GateError("the counts of excluded map nodes don't add up")
    statistics = evaluation.artifact_statistics(inputs.artifact).first().asDict()
    found = checks(statistics, selection, cohorts, metrics, purposes, policy)
    failures = [c["name"] for c in found if not c["passed"]]
    return {
        "format": FORMAT, "quality_version": policy.version, "policy_sha256": policy.sha256, "dataset_version": version, "status": "fail" if failures else "pass", "failures": failures,
        "artifact": statistics, "evidence_selection": selection | {"retained": retained, "excluded_by_reason": {"outside_target_municipality": selection["outside"], **excluded}},
        "cohorts": {n: cohorts[n] | {"metrics": metrics[n]} for n in COHORTS}, "uncensored_diagnostics": {n: cohorts[f"raw_{n}"] | {"metrics": metrics[f"raw_{n}"]} for n in COHORTS},
        "official_pilot": cohorts["official_pilot"] | {"metrics": metrics["official_pilot"]}, "purposes": purposes, "checks": found,
    }


def bound(report: dict, manifest: dict) -> dict:
    """A report with the identity of the build that it is about."""
    return report | {"build": {"rows": manifest["rows"], "manifest_sha256": hashlib.sha256(canonical(manifest).encode()).hexdigest()}}


def binding_problems(report: dict, manifest: dict, policy: QualityPolicy) -> list[str]:
    """What a report and a build's manifest say otherwise: the build, its version, its policy, its counts."""
    own, out = manifest["statistics"], []
    if report.get("build") != bound({}, manifest)["build"]:
        out.append("the report is about another build")
    if report.get("dataset_version") != manifest["dataset_version"]:
        out.append("the versions differ")
    if (manifest["settings"].get("quality_version"), manifest["settings"].get("quality_sha256")) != (policy.version, policy.sha256):
        out.append("the build was gated by another policy")
    if any(report.get("artifact", {}).get(a) != own[b] for a, b in (("record_count", "records"), ("located", "located"), ("unresolved", "unresolved"), *((f"tier_{t}", f"tier_{t}") for t in TIERS))):
        out.append("the counts differ")
    return out


def report_problems(report: dict, policy: QualityPolicy) -> list[str]:
    """What contradicts itself or the policy in a report that was read back."""
    out = []
    if report.get("format") != FORMAT or report.get("quality_version") != policy.version or report.get("policy_sha256") != policy.sha256:
        out.append("another format or policy")
    if [c.get("name") for c in report.get("checks", [])] != check_names(policy):
        out.append("the checks aren't the policy's")
    failures = [c["name"] for c in report.get("checks", []) if not c.get("passed")]
    if report.get("failures") != failures or report.get("status") != ("fail" if failures else "pass"):
        out.append("status and failures don't follow from the checks")
    return out


def check_table(report: dict, like: DataFrame) -> DataFrame:
    """A report's checks as rows; actual and threshold as canonical JSON."""
    rows = [(c["name"], c["passed"], canonical(c["actual"]), canonical(c["threshold"])) for c in report["checks"]]
    return like.sparkSession.createDataFrame(rows, CHECK)


def markdown(report: dict) -> str:
    """The report for readers, the same bytes for the same report."""
    number = lambda x: "-" if x is None else f"{x:g}" if isinstance(x, float) else str(x)
    out = [f"# Quality of {report['dataset_version']}", "", f"Policy {report['quality_version']}: {report['status']}.", "", "| statistic | value |", "|-|-|"]
    out += [f"| {k} | {number(v)} |" for k, v in sorted(report["artifact"].items())]
    out += ["", "| evidence | observations |", "|-|-|"] + [f"| {k} | {number(v)} |" for k, v in sorted(report["evidence_selection"].items()) if not isinstance(v, dict)]
    out += [f"| excluded: {k} | {v} |" for k, v in sorted(report["evidence_selection"]["excluded_by_reason"].items())]
    for title, cohorts in (("Cohorts", report["cohorts"]), ("Raw diagnostics, not gated", report["uncensored_diagnostics"]), ("Official sample", {"official_pilot": report["official_pilot"]})):
        out += ["", f"## {title}"]
        for name, own in sorted(cohorts.items()):
            out += ["", f"{name}: {own['evaluated']} of {own['heldout_observations']} evaluated, {own['missing']} of unknown codes, {own['failures']} without an estimate.", "", "| group | n | p50 km | p90 km | p95 km |", "|-|-|-|-|-|"]
            out += [f"| {m} | {r['n']} | {number(r['p50_km'])} | {number(r['p90_km'])} | {number(r['p95_km'])} |" for m, r in sorted(own["metrics"].items())]
    out += ["", "## Checks", "", "| check | passed | actual | threshold |", "|-|-|-|-|"] + [f"| {c['name']} | {'yes' if c['passed'] else 'no'} | {canonical(c['actual'])} | {canonical(c['threshold'])} |" for c in report["checks"]]
    return "\n".join(out) + "\n"
