"""Statistics of the artifact and hold-out evaluation of the estimator."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from postalis.config import TIERS, Thresholds
from postalis.functions import STATES, address_class, distance_km, evidence_key, hash_bucket, in_bounds, state_code, valid_digest
from postalis.operators.centroid import mad_filter, robust_centroid, unique_evidence
from postalis.operators.tiers import near_municipality, osm_postcode

# Why a map node is left out of production, and what becomes of a held-out one.
EXCLUSIONS = ("outside_reference_distance_backstop", "robust_spatial_outlier", "cep_group_radius_rejection")
EVALUATED, MISSING, FAILED = "evaluated", "missing_cep", "prediction_failure"


def uf_mismatches(artifact: DataFrame) -> DataFrame:
    """(cep, uf, ibge): states that contradict the municipality code's first two digits."""
    return artifact.filter(~F.substring("ibge", 1, 2).eqNullSafe(state_code(F.col("uf")))).select("cep", "uf", "ibge")


def municipality_variants(artifact: DataFrame) -> DataFrame:
    """(ibge, ufs, labels): municipalities seen with more than one state or city name."""
    return artifact.groupBy("ibge").agg(F.countDistinct("uf").alias("ufs"), F.countDistinct("city").alias("labels")).filter("ufs > 1 or labels > 1")


def bounds_violations(artifact: DataFrame) -> DataFrame:
    return artifact.filter("latitude is not null").filter(~in_bounds(F.col("latitude"), F.col("longitude"))).select("cep", "latitude", "longitude")


def artifact_statistics(artifact: DataFrame) -> DataFrame:
    """One row of the fourteen metrics that a build is gated on; the tiers as a column each. The table is read once: sums
    by (ibge, uf, city) first, of which there are few, then their totals."""
    located = F.col("latitude").isNotNull()
    digest = F.coalesce(valid_digest(F.col("evidence_digest")), F.lit(False))
    source = F.octet_length(F.to_json("geo_source") if dict(artifact.dtypes)["geo_source"].startswith("array") else F.col("geo_source"))
    parts = artifact.groupBy("ibge", "uf", "city").agg(
        F.count("*").alias("n"), F.count("latitude").alias("located"), F.count_if(located & ~in_bounds(F.col("latitude"), F.col("longitude"))).alias("out"),
        *(F.count_if(F.col("precision").eqNullSafe(F.lit(t))).alias(f"tier_{t or 'unresolved'}") for t in (*TIERS, None)),
        F.max(source).alias("source"), F.max(F.length("evidence_digest")).alias("digest"), F.count_if(located & ~digest).alias("bad"),
    )
    wrong = F.when(~F.substring("ibge", 1, 2).eqNullSafe(state_code(F.col("uf"))), F.col("n")).otherwise(0)
    per = parts.withColumn("wrong", wrong).groupBy("ibge").agg(
        *(F.sum(c).alias(c) for c in ("n", "located", "out", "bad", "wrong", *(f"tier_{t}" for t in (*TIERS, "unresolved")))),
        F.max("source").alias("source"), F.max("digest").alias("digest"), F.collect_set("uf").alias("ufs"), F.countDistinct("city").alias("labels"),  # states
    )
    n, found = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("located"), F.lit(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    ufs = F.array_sort(F.array_distinct(F.flatten(F.collect_set("ufs"))))  # sets of states
    return per.agg(
        n.alias("record_count"), found.alias("located"), F.round(F.coalesce(found / F.nullif(n, F.lit(0)), F.lit(0.0)), 8).alias("coverage"), (n - found).alias("unresolved"),
        *(total(f"tier_{t}").alias(f"tier_{t}") for t in TIERS), ufs.alias("_ufs"), total("out").alias("invalid_bounds"), total("wrong").alias("uf_ibge_mismatches"),
        F.count_if(F.size("ufs") > 1).alias("municipality_conflicts"), F.count_if(F.col("labels") > 1).alias("municipality_label_variants"),
        F.coalesce(F.max("source"), F.lit(0)).alias("max_geo_source_bytes"), F.coalesce(F.max("digest"), F.lit(0)).alias("max_digest_bytes"), total("bad").alias("invalid_digests"),
    ).withColumn("ufs", F.array_join("_ufs", ",")).withColumn("uf_count", F.size("_ufs").cast("long")).drop("_ufs")


def split(observations: DataFrame, modulus: int = 5, remainder: int = 0, by_code: bool = False) -> DataFrame:
    """observations with held_out, decided by a hash of the evidence or of its whole code."""
    key = F.col("cep") if by_code else evidence_key(F.col("evidence_id"), F.col("cep"), F.col("latitude"), F.col("longitude"), F.col("source"))
    return observations.withColumn("held_out", hash_bucket(key, modulus) == remainder)


def production_eligible(osm: DataFrame, addresses: DataFrame, municipalities: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """osm with exclusion_reason (null: retained), as the production tier would treat each node; nodes of unknown
    codes are retained. Within a code: distance backstop, outlier rule, then the group's radius."""
    known = near_municipality(osm, addresses, municipalities)
    backstop = F.col("distance_km").isNull() | (F.col("distance_km") > t.max_osm_municipality_distance_km)
    near = mad_filter(unique_evidence(known.filter(~backstop), ["cep"]), ["cep"], t)
    wide = robust_centroid(near.filter("retained"), ["cep"]).filter(F.col("radius_km") > t.max_osm_radius_km).select("cep", F.lit(True).alias("wide"))
    judged = near.join(wide, "cep", "left").withColumn("exclusion_reason", F.when(~F.col("retained"), EXCLUSIONS[1]).when(F.col("wide"), EXCLUSIONS[2]))
    columns = [*osm.drop("ibge").columns, "exclusion_reason"]
    out = known.filter(backstop).withColumn("exclusion_reason", F.lit(EXCLUSIONS[0])).select(*columns)
    unknown = osm.join(addresses.select("cep"), "cep", "left_anti").withColumn("exclusion_reason", F.lit(None).cast("string")).select(*columns)
    return judged.select(*columns).unionByName(out).unionByName(unknown)


def exclusion_counts(judged: DataFrame) -> DataFrame:
    """(reason, n): every reason, zero included, and the retained."""
    keys = judged.sparkSession.createDataFrame([(x,) for x in (*EXCLUSIONS, "retained")], "reason string")
    found = judged.groupBy(F.coalesce("exclusion_reason", F.lit("retained")).alias("reason")).agg(F.count("*").alias("n"))
    return keys.join(found, "reason", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def outcomes(parted: DataFrame, addresses: DataFrame, municipalities: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """(evidence_id, cep, outcome, uf, address_class, precision, error_km) of held-out map nodes, estimated from the others
    alone. outcome: evaluated, missing_cep (its code isn't known) or prediction_failure (no tier has an estimate)."""
    train = parted.filter("not held_out").drop("held_out")
    trained = osm_postcode(train, addresses, municipalities, t).select("cep", F.struct("latitude", "longitude").alias("t2"))
    held = parted.filter("held_out").select("evidence_id", "cep", F.col("latitude").alias("olat"), F.col("longitude").alias("olon"))
    own = addresses.select("cep", "ibge", "uf", address_class(F.col("street"), F.col("neighborhood")).alias("address_class"), F.lit(True).alias("there"))
    rows = held.join(own, "cep", "left").join(trained, "cep", "left")
    rows = rows.join(municipalities.select("ibge", F.struct("latitude", "longitude").alias("t4")), "ibge", "left").withColumn("p", F.when(F.col("there"), F.coalesce("t2", "t4")))
    outcome = F.when(F.col("there").isNull(), MISSING).when(F.col("p").isNull(), FAILED).otherwise(EVALUATED)
    precision = F.when(F.col("p").isNotNull(), F.when(F.col("t2").isNotNull(), "osm_postcode").otherwise("municipality"))
    return rows.select("evidence_id", "cep", outcome.alias("outcome"), "uf", "address_class", precision.alias("precision"), distance_km(F.col("olat"), F.col("olon"), F.col("p.latitude"), F.col("p.longitude")).alias("error_km"))


def evaluate(parted: DataFrame, addresses: DataFrame, municipalities: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """(evidence_id, uf, address_class, precision, error_km): the samples among the outcomes."""
    return outcomes(parted, addresses, municipalities, t).filter(F.col("outcome") == EVALUATED).select("evidence_id", "uf", "address_class", "precision", "error_km")


def percentiles(prefix: str = "error_km") -> list:
    """Nearest-rank percentiles."""
    return [F.round(F.expr(f"percentile_disc({q}) within group (order by {prefix})"), 3).alias(n) for q, n in ((0.5, "p50_km"), (0.9, "p90_km"), (0.95, "p95_km"))]


def grouped_metrics(samples: DataFrame, by: str | None = None) -> DataFrame:
    """(by, metric, n, p50_km, p90_km, p95_km) overall and by state, class, precision and (state, precision), of each value
    of by, in one pass of grouping sets; only groups that have samples."""
    aggregates = ", ".join(f"round(percentile_disc({q}) within group (order by error_km), 3) as {n}" for q, n in ((0.5, "p50_km"), (0.9, "p90_km"), (0.95, "p95_km")))
    own = [by] if by else []
    name = f"""case grouping_id({", ".join([*own, "uf", "address_class", "precision"])}) when 7 then 'overall' when 3 then concat('uf:', uf) when 5 then concat('address_class:', address_class)
              when 6 then concat('precision:', precision) else concat('uf_precision:', uf, ':', precision) end"""
    sets = ", ".join(f"({', '.join([*own, *x])})" for x in ([], ["uf"], ["address_class"], ["precision"], ["uf", "precision"]))
    return samples.sparkSession.sql(f"select {''.join(f'{x}, ' for x in own)}{name} as metric, count(*) as n, {aggregates} from {{s}} group by grouping sets ({sets})", s=samples).filter("n > 0")


def group_metrics(samples: DataFrame) -> DataFrame:
    """grouped_metrics, in which the four tiers appear even without a sample."""
    tiers = samples.sparkSession.createDataFrame([(f"precision:{t}",) for t in TIERS], "metric string")
    return grouped_metrics(samples).join(tiers, "metric", "full").withColumn("n", F.coalesce("n", F.lit(0)))


def purpose_metrics(samples: DataFrame, precisions: list[str], ufs: list[str] | None = None) -> DataFrame:
    """One row: n and percentiles of the samples that serve a purpose."""
    rows = samples.filter(F.col("precision").isin(precisions))
    rows = rows if ufs is None else rows.filter(F.col("uf").isin(ufs))
    return rows.agg(F.count("*").alias("n"), *percentiles())


def official_outcomes(holdout: DataFrame, artifact: DataFrame) -> DataFrame:
    """Outcomes, as above, of an official sample against stored points, not new estimates."""
    own = artifact.select("cep", "uf", address_class(F.col("street"), F.col("neighborhood")).alias("address_class"), "precision", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), F.lit(True).alias("there"))
    rows = holdout.join(own, "cep", "left")
    outcome = F.when(F.col("there").isNull(), MISSING).when(F.col("_lat").isNull() | F.col("_lon").isNull() | F.col("precision").isNull(), FAILED).otherwise(EVALUATED)
    return rows.select("cep", outcome.alias("outcome"), "uf", "address_class", "precision", distance_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")).alias("error_km"))


def official_pilot(holdout: DataFrame, artifact: DataFrame) -> DataFrame:
    """(precision, n, p50_km, p90_km, p95_km) of the official sample."""
    rows = official_outcomes(holdout, artifact).filter(F.col("outcome") == EVALUATED)
    return rows.groupBy("precision").agg(F.count("*").alias("n"), *percentiles())


def cohort(rows: DataFrame | GroupedData) -> DataFrame:
    """One row about outcomes (or about each group of them): held-out observations and codes, how many were evaluated, missed or failed, and which
    states and address classes the samples have or lack."""
    at = lambda kind: F.count_if(F.col("outcome") == kind)
    part = lambda n: F.round(F.coalesce(n / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 8)
    good = F.col("outcome") == EVALUATED
    found = F.array_sort(F.collect_set(F.when(good, F.col("uf"))))
    every = F.array(*map(F.lit, sorted(STATES)))
    return rows.agg(
        F.count("*").alias("heldout_observations"), F.countDistinct("cep").alias("heldout_codes"), at(EVALUATED).alias("evaluated"), at(MISSING).alias("missing"), part(at(MISSING)).alias("missing_fraction"),
        at(FAILED).alias("failures"), part(at(FAILED)).alias("failure_fraction"), F.array_join(found, ",").alias("ufs"), F.size(found).cast("long").alias("uf_count"),
        F.array_join(F.array_except(every, found), ",").alias("missing_ufs"), F.array_join(F.array_sort(F.collect_set(F.when(good, F.col("address_class")))), ",").alias("address_classes"),
    )


def checks(statistics: DataFrame, thresholds: dict[str, tuple[str, float]]) -> DataFrame:
    """(name, actual, threshold, passed) from one row of statistics; thresholds: name -> (min or max, value)."""
    rows = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("actual"), F.lit(float(v)).alias("threshold"), (F.col(n) >= v if kind == "min" else F.col(n) <= v).alias("passed")) for n, (kind, v) in thresholds.items()]
    return statistics.select(F.inline(F.array(*rows)))
