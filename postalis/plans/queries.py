"""Registered queries over the adapter views; each applies operators to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis import functions as fn
from postalis.config import QualityPolicy
from postalis.operators import build, candidate, centroid, chain, containment, contract, evaluation, identities, lookup, refresh, report, tiers
from postalis.operators.settled import settle
from postalis.plans import testdata as T
from postalis.sinks import FLAT
from postalis.sources import records

QUERIES = {}


def point() -> list:
    return [F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"), "evidence_count", "radius_km", "geo_source"]


class Views:
    """The adapter views of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        own = {"addr": T.ADDR, "fp": T.FIRST_PARTY, "osm": T.OSM, "holdout": T.HOLDOUT, "localities": T.LOCALITIES, "polygons": T.POLYGONS, "diff": T.DIFF, "raw": T.RAW, "records": T.RECORDS, "every_polygon": T.EVERY_POLYGON, "every_locality": T.EVERY_LOCALITY, "sound_diff": T.SOUND_DIFF, "fates": T.FATES, "halves": T.HALVES}
        return T.view(self.spark, self.sf_dir, own[name])

    def muni(self) -> DataFrame:
        return tiers.municipality_reference(self.localities)

    def artifact(self) -> DataFrame:
        return tiers.resolve(self.addr, self.fp, self.osm, self.muni())

    def stored(self) -> DataFrame:
        """The artifact with a digest (of the code; some malformed), sources as an array, and a version."""
        digest = F.when(F.col("latitude").isNotNull(), F.when(F.substring("cep", 8, 1) == "9", "sha256:zz").otherwise(F.concat(F.lit("sha256:"), F.sha2("cep", 256))))
        return self.artifact().withColumns({"evidence_digest": digest, "dataset_version": F.lit("v1"), "geo_source": F.split("geo_source", ",")})

    def candidate(self) -> DataFrame:
        """Flat rows of a candidate: only points of the precisions that one may carry."""
        located = F.col("precision").isin(*refresh.CANDIDATE_PRECISIONS)
        kept = {c: F.when(located, F.col(c)) for c in ("latitude", "longitude", "evidence_count", "precision")}
        rows = self.artifact().withColumns({"evidence_radius_km": F.when(located, F.col("radius_km")), "geo_source": F.when(located, F.split("geo_source", ",")), **kept})
        none = F.lit(None).cast("string")
        rows = rows.withColumns({"method": F.when(located, F.lit("earlier")), "evidence_digest": F.when(located, F.concat(F.lit("sha256:"), F.sha2("cep", 256))), "dataset_version": F.lit("v2"), **dict.fromkeys(("complement", "unit", "state", "region"), none)})
        return rows.select(*FLAT)

    def inheritance(self) -> tuple[DataFrame, DataFrame]:
        """A base and a candidate of the same rows, in which some are added, smuggled in, lost, given another street or moved."""
        rows = settle(self.candidate().join(self.fates, "cep"))  # a release is stored
        marks = ["added", "smuggled", "lost", "readdressed", "moved"]
        base = rows.filter("not added and not smuggled").withColumn("dataset_version", F.lit("v1"))
        new = rows.filter("not lost").withColumn("street", F.when(F.col("readdressed"), "another").otherwise(F.col("street"))).withColumn("latitude", F.when(F.col("moved"), F.col("latitude") + 1).otherwise(F.col("latitude")))
        return base.drop(*marks), new.drop(*marks)

    def inputs(self) -> report.Inputs:
        return report.Inputs(self.artifact(), self.osm, settle(self.muni()), self.polygons, self.holdout, self.addr)

    def outcomes(self, cohort: str) -> DataFrame:
        inputs = self.inputs()
        return report.cohort_outcomes(report.cohort_inputs(inputs, cohort=cohort)[cohort], inputs, cohort)


def query(f):
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
    return f


@query
def normalize_codes(v):
    code = fn.postal_code(F.col("raw_code"))
    return v.raw.select("c_custkey", code.alias("code"), F.substring(code, 1, 5).alias("prefix"))


@query
def clean_text(v):
    return v.raw.select("c_custkey", fn.clean_text(F.col("raw_text")).alias("text"))


@query
def address_class(v):
    return v.addr.select("cep", fn.address_class(F.col("street"), F.col("neighborhood")).alias("address_class"))


@query
def evidence_conflicts(v):
    shared = F.concat(F.lit("store:"), (F.substring("evidence_id", 7, 20).cast("long") % 700).cast("string"))
    return centroid.evidence_conflicts(v.fp.withColumn("evidence_id", shared))


@query
def unique_evidence(v):
    twice = v.fp.unionByName(v.fp.filter(F.substring("cep", 8, 1).cast("int") < 5))
    return centroid.unique_evidence(twice, ["cep"]).groupBy("cep").agg(F.count("*").alias("n"))


@query
def source_categories(v):
    rows = v.fp.select("source").unionByName(v.osm.select("source")).select(fn.source_category(F.col("source")).alias("category"))
    return rows.groupBy("category", fn.valid_category(F.col("category")).alias("valid")).agg(F.count("*").alias("n"))


@query
def mad_outliers(v):
    return centroid.mad_filter(v.fp, ["cep"]).filter("not retained").select("evidence_id", "cep")


@query
def robust_centroid(v):
    return centroid.robust_centroid(centroid.mad_filter(v.fp, ["cep"]).filter("retained"), ["cep"]).select("cep", *point())


@query
def municipality_reference(v):
    return v.muni().select("ibge", *point())


@query
def tier_observed(v):
    return tiers.observed(v.fp).select("cep", *point())


@query
def tier_osm(v):
    return tiers.osm_postcode(v.osm, v.addr, v.muni()).select("cep", *point())


@query
def tier_prefix(v):
    return tiers.observed_prefix(v.fp).select("prefix", "ibge", *point())


@query
def resolve_all(v):
    return v.artifact().select("cep", "ibge", "precision", *point())


@query
def tier_distribution(v):
    return tiers.tier_distribution(v.artifact())


@query
def ibge_conflicts(v):
    other = F.when(F.substring("evidence_id", 7, 20).cast("long") % 50 == 0, "3550308").otherwise(F.col("ibge"))
    return tiers.ibge_conflicts(v.addr, v.fp.withColumn("ibge", other))


@query
def ibge_join_rate(v):
    rows = v.addr.join(v.muni().select("ibge", F.lit(1).alias("there")), "ibge", "left")
    return rows.agg(F.count("*").alias("n"), F.count("there").alias("joined"), F.round(F.count("there") / F.count("*"), 8).alias("rate"))


@query
def contract_rows(v):
    located = F.col("latitude").isNotNull()
    coordinates = F.when(located, F.array(F.round("longitude", 9), F.round("latitude", 9)))
    return v.artifact().select("cep", "prefix", "city", "uf", "ibge", coordinates.alias("coordinates"), F.when(located, F.split("geo_source", ",")).alias("source"))


@query
def point_in_polygon(v):
    return containment.classify(containment.targets(v.osm, v.addr).filter("ibge is not null"), v.polygons)


@query
def boundary_selection(v):
    return containment.selection_statistics(containment.select(v.osm, v.addr, v.polygons))


@query
def missing_polygons(v):
    return containment.missing_polygons(v.osm, v.addr, v.polygons)


@query
def production_eligible(v):
    return evaluation.exclusion_counts(evaluation.production_eligible(v.osm, v.addr, v.muni()))


@query
def artifact_statistics(v):
    return evaluation.artifact_statistics(v.stored())


@query
def uf_ibge_mismatch(v):
    return evaluation.uf_mismatches(v.addr)


@query
def municipality_conflicts(v):
    return evaluation.municipality_variants(v.addr)


@query
def bounds_violations(v):
    moved = F.col("latitude") + F.when(F.substring("cep", 8, 1) == "7", 12.0).otherwise(0.0)  # beyond the northern bound
    return evaluation.bounds_violations(v.artifact().withColumn("latitude", moved)).select("cep", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@query
def holdout_split_obs(v):
    return evaluation.split(v.osm).select("evidence_id", "held_out")


@query
def holdout_split_cep(v):
    return evaluation.split(v.osm, by_code=True).groupBy("cep", "held_out").agg(F.count("*").alias("n"))


def samples(v, cohort="leave_observation_out"):
    good = F.col("outcome") == evaluation.EVALUATED
    return v.outcomes(cohort).filter(good).select("evidence_id", "uf", "address_class", "precision", "error_km")


@query
def evaluate_loo(v):
    return v.outcomes("leave_observation_out").withColumn("error_km", F.round("error_km", 6))


@query
def evaluate_unseen(v):
    return v.outcomes("unseen_cep").withColumn("error_km", F.round("error_km", 6))


@query
def group_metrics(v):
    return evaluation.group_metrics(samples(v))


@query
def purpose_metrics(v):
    return evaluation.purpose_metrics(samples(v), ["osm_postcode"], ["RO", "AC", "SP", "PA"])


@query
def cohort_summary(v):
    return evaluation.cohort(report.all_outcomes(v.inputs(), POLICY).groupBy("cohort"))


@query
def official_pilot(v):
    return evaluation.official_pilot(v.holdout, v.artifact())


@query
def quality_checks(v):
    return evaluation.checks(evaluation.artifact_statistics(v.stored()), {"record_count": ("min", 100), "coverage": ("min", 0.95), "unresolved": ("max", 10), "invalid_digests": ("max", 0)})


#: A policy with bounds that the test tables meet in part.
POLICY = QualityPolicy({
    "version": "test-1", "brazil_bounds": {"latitude_min": -34.0, "latitude_max": 5.5, "longitude_min": -74.0, "longitude_max": -28.0},
    "build_thresholds": {"minimum_records": 100, "minimum_coverage": 0.5, "maximum_unresolved": 10**9, "minimum_ufs": 2, "maximum_invalid_bounds": 0, "maximum_uf_ibge_mismatches": 10**9, "maximum_municipality_conflicts": 100, "maximum_geo_source_bytes": 2048, "maximum_evidence_digest_bytes": 71, "maximum_invalid_evidence_digests": 0, "allowed_precision_tiers": ["observed_cep", "osm_postcode", "municipality"]},
    "validation": {
        "modulus": 5, "remainder": 0, "osm_evidence": {"maximum_outside_target_municipality_fraction": 0.01},
        "cohorts": {c: {"minimum_records": 10, "minimum_ufs": 3, "maximum_missing_fraction": share, "maximum_prediction_failure_fraction": 0.02, "required_address_classes": ["urban_address_proxy"]} for c, share in (("leave_observation_out", 0.9), ("unseen_cep", 0.001))},
        "per_uf": {"cohort": "unseen_cep", "required_ufs": ["AC", "RO"], "thresholds": {"AC": {"minimum_samples": 1, "maximum_p95_km": 5.0}, "RO": {"minimum_samples": 3, "maximum_p95_km": 700.0}}},
        "purposes": {"near": {"cohort": "leave_observation_out", "allowed_precision_tiers": ["osm_postcode"], "minimum_records": 5, "maximum_p95_km": 2.0}, "region": {"cohort": "unseen_cep", "allowed_precision_tiers": ["municipality"], "ufs": ["RO"], "minimum_records": 10**6, "maximum_p95_km": 700.0}},
        "official_pilot": {"minimum_records": 10, "maximum_missing_fraction": 0.1, "maximum_prediction_failure_fraction": 0.0, "expected_ufs": ["RO"], "maximum_p95_km": 700.0},
    },
})


@query
def report_checks(v):
    """Every check of the policy, from the whole report."""
    inputs = v.inputs()
    found = report.quality_report(report.Inputs(v.stored(), inputs.osm, inputs.municipalities, inputs.edges, inputs.official, v.addr), POLICY, "v1")
    return report.check_table(found, inputs.osm).select("name", "passed")


@query
def point_lookup(v):
    return lookup.point(v.artifact(), "01000037").select("cep", "precision", *point())


@query
def prefix_members(v):
    return lookup.prefix_members(v.artifact(), "01000037")


@query
def prefix_aggregate(v):
    found = lookup.prefix_estimates(v.stored()).withColumns({c: F.round(c, 9) for c in ("latitude", "longitude")})
    return found.withColumn("sources", F.array_join("sources", ",")).drop("evidence_digest")  # tested with a known digest


def gaps(v):
    """Flat rows of which only first-party ones have a place, and administrative references of municipalities without a city."""
    own = tiers.observed(v.fp)
    rows = v.addr.select("cep", "ibge").join(own, "cep", "left").withColumns({
        "precision": F.when(F.col("latitude").isNotNull(), "osm_postcode"), "method": F.when(F.col("latitude").isNotNull(), "m"), "evidence_radius_km": F.col("radius_km"), "geo_source": F.split("geo_source", ","), "evidence_digest": F.lit(None).cast("string"),
    }).drop("radius_km")
    digest = F.lit(None).cast("string").alias("evidence_digest")
    lacking = refresh.unreferenced(rows, v.muni())
    return rows, v.muni().select("*", digest), tiers.administrative_reference(v.localities, lacking.filter("ibge < '3'"), "Povoado").select("*", digest)


@query
def fill_null_geo(v):
    filled = refresh.fill_null_geo(*gaps(v))
    return filled.select("cep", "ibge", "origin", "precision", "method", *(F.round(c, 9).alias(c) for c in ("latitude", "longitude")), "evidence_count", "evidence_radius_km", F.array_join("geo_source", ",").alias("geo_source"))


@query
def candidate_counts(v):
    return refresh.candidate_counts(v.artifact())


@query
def diff_counts(v):
    return refresh.diff_counts(v.diff)


@query
def diff_problems(v):
    fields = F.when(F.col("c_custkey") % 47 == 0, F.array(F.lit("uf"), F.lit("uf"))).otherwise(F.array(F.lit("uf"), F.lit("city")))
    return refresh.diff_problems(v.diff.withColumn("changed_fields", fields)).select("cep", F.array_join("failed", ",").alias("failed"))


@query
def invalid_pairs(v):
    return refresh.invalid_pairs(v.diff).select("cep", "classification", "geography_action")


@query
def merge_compare(v):
    one = v.artifact().select("cep", "street", "precision")
    last = F.substring("cep", 8, 1).cast("int")
    return refresh.compare(one, one.filter(last != 3).withColumn("street", F.when(last != 4, F.col("street"))))


@query
def sorted_unique_check(v):
    """Positions leave gaps of whole ranges; codes fall back at some of them."""
    customer = v.spark.read.parquet(f"{v.sf_dir}/customer.parquet")
    code = F.when(F.col("c_custkey") % 40 == 0, "00000000").otherwise(F.expr(T.CEP.format("c_custkey")))
    place = F.col("c_custkey") + F.floor(F.col("c_custkey") / 30) * 250_000
    return refresh.order_violations(customer.select(place.alias("position"), code.alias("cep")), "position")


@query
def needed_codes(v):
    return v.addr.join(v.osm.select("cep").distinct(), "cep", "left_semi").select("cep", "ibge")


@query
def row_contract_violations(v):
    """Rows of the artifact with faults of every kind at some codes."""
    n = F.substring("cep", 4, 5).cast("int")
    broken = v.stored().withColumns({
        "method": F.when(F.col("latitude").isNotNull(), F.when(n % 5 == 0, " ").otherwise("m")), "evidence_radius_km": F.when(n % 7 == 0, F.lit(-1.0)).otherwise(F.col("radius_km")),
        "uf": F.when(n % 11 == 0, "XX").otherwise(F.col("uf")), "city": F.when(n % 13 == 0, "  ").when(n % 17 == 0, F.repeat(F.lit("é"), 257)).otherwise(F.col("city")),
        "dataset_version": F.when(n % 19 == 0, "v2").otherwise(F.col("dataset_version")), "prefix": F.when(n % 23 == 0, "00000").otherwise(F.col("prefix")),
        "geo_source": F.when(n % 29 == 0, F.array(F.lit("b"), F.lit("a"))).otherwise(F.col("geo_source")), "longitude": F.when(n % 31 == 0, F.lit(-20.0)).otherwise(F.col("longitude")),
    })
    return contract.row_problems(broken, "v1").select("cep", F.array_join("failed", ",").alias("failed"))


@query
def build_rows(v):
    """From text records to the artifact's rows, under all gates; digests, which SQL lacks, by their form."""
    rows = build.build_rows(v.records, v.fp, v.osm, v.localities, "v1", edges=v.every_polygon)
    places = [F.round(c, 9).alias(c) for c in ("latitude", "longitude")]
    formed = F.coalesce(F.length("evidence_digest"), F.lit(0)).alias("digest_length")
    names = ["cep", "prefix", "street", "complement", "unit", "neighborhood", "city", "uf", "state", "region", "ibge", "precision", "method", "evidence_count", "evidence_radius_km", "dataset_version"]
    return rows.select(*names, *places, F.array_join("geo_source", ",").alias("geo_source"), formed)


@query
def candidate_rows(v):
    """A candidate with its diff, under all gates, and its gaps filled."""
    rows = candidate.candidate_rows(v.candidate(), v.sound_diff.withColumn("changed_fields", F.array().cast("array<string>")), v.every_locality)
    places = [F.round(c, 9).alias(c) for c in ("latitude", "longitude")]
    return rows.select("cep", "street", "city", "uf", "ibge", "precision", "method", "evidence_count", "evidence_radius_km", *places, F.array_join("geo_source", ",").alias("geo_source"), F.length("evidence_digest").alias("digest_length"), "dataset_version", F.col("_origin").alias("origin"))


@query
def count_identities(v):
    """Which sums of a refresh's counts hold, from all located rows and the unsound diff."""
    return identities.differences(identities.measured(v.artifact(), v.diff))


@query
def inherited_problems(v):
    return chain.inherited_problems(*v.inheritance(), v.sound_diff)


@query
def exact_rounding(v):
    return v.halves.select("o_orderkey", fn.round_exact(F.col("small"), 3).alias("small"), fn.round_exact(-F.col("small"), 3).alias("negative"), fn.round_exact(F.col("wide"), 2).alias("wide"))


@query
def build_statistics(v):
    return build.build_statistics(v.artifact(), v.muni())


@query
def artifact_versions(v):
    version = F.when(F.substring("cep", 8, 1) == "4", F.lit(None)).when(F.substring("cep", 8, 1) == "5", "v2").otherwise("v1")
    return build.verify_artifact(v.artifact().withColumn("dataset_version", version), "v1")


@query
def record_problems(v):
    n = F.regexp_replace("cep", "-", "").cast("int")
    broken = v.records.withColumns({"ibge": F.when(n % 5 == 0, "12").otherwise(F.col("ibge")), "localidade": F.when(n % 7 == 0, chr(160)).otherwise(F.col("localidade"))})
    return build.record_problems(build.address_rows(broken))


@query
def category_problems(v):
    source = F.when(F.substring("cep", 8, 1) == "3", F.concat(F.lit("-bad:"), "source")).otherwise(F.col("source"))
    return centroid.category_problems(v.fp.withColumn("source", source), ["cep"])


@query
def bounded_centroid(v):
    return centroid.bounded_centroid(v.fp.withColumn("prefix", F.substring("cep", 1, 5)), ["prefix"], 3, 25.0).select("prefix", *point())


@query
def administrative_reference(v):
    codes = v.localities.filter("ibge < '3'").select("ibge")
    return tiers.administrative_reference(v.localities, codes, "Povoado").select("ibge", *point())


@query
def tier_municipality(v):
    return v.addr.select("cep", "ibge").join(v.muni(), "ibge").select("cep", *point())


@query
def target_lookup(v):
    return containment.targets(v.osm, v.addr).select("evidence_id", "ibge")


def filed(v):
    """Addresses as records of a file each, whose digest stands for its content."""
    own = v.addr.select(F.concat(F.lit("v1/"), "cep", F.lit(".json")).alias("member"), F.sha2("cep", 256).alias("sha256"), "cep", F.col("city").alias("localidade"), "uf")
    last = F.substring("cep", 8, 1).cast("int")
    stale = F.when(last == 2, F.lit("0" * 64)).otherwise(F.col("sha256"))
    fixes = own.filter(last < 3).select("member", stale.alias("source_sha256"), F.when(last == 1, "localidade").otherwise("uf").alias("field"), F.when(last == 1, F.col("localidade")).otherwise(F.col("uf")).alias("from"), F.concat(F.lit("fixed "), F.col("uf")).alias("to"), F.lit("test").alias("reason"))
    return own, fixes


@query
def corrections_apply(v):
    own, fixes = filed(v)
    return records.correct(own, fixes, ["cep", "localidade", "uf"]).select("member", "localidade", "uf")


@query
def correction_violations(v):
    own, fixes = filed(v)
    return records.correction_violations(own.filter("cep <> '01000037'"), fixes, ["cep", "localidade", "uf"])


@query
def observations_parse(v):
    """Evidence written as text columns, some of it broken, and parsed again."""
    n = F.substring("evidence_id", 7, 20).cast("long")
    text = v.fp.select(
        F.when(n % 31 == 0, "123").otherwise(F.concat(F.substring("cep", 1, 5), F.lit("-"), F.substring("cep", 6, 3))).alias("cep"), F.when(n % 29 == 0, "12").otherwise(F.col("ibge")).alias("ibge"), "source",
        F.when(n % 23 == 0, "far").otherwise(F.col("latitude").cast("string")).alias("latitude"), F.col("longitude").cast("string").alias("longitude"), "evidence_id",
    )
    return records.parse_observations(text).groupBy(F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.count("*").alias("n"), F.countDistinct("evidence_id").alias("identities"))


@query
def evidence_digest(v):
    return centroid.evidence_digests(v.fp, ["cep"])
