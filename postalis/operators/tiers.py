"""The five-tier estimate: code, tagged map nodes, prefix, municipality, unresolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.config import TIERS, Thresholds
from postalis.functions import distance_km, in_bounds
from postalis.operators.centroid import bounded_centroid, category_problems, evidence_conflicts, evidence_digests, mad_filter, unique_evidence
from postalis.operators.gates import GateError, require_empty

# How each tier's estimate is made.
METHODS = {"observed_cep": "robust_median_first_party", "osm_postcode": "robust_median_osm_postcode", "observed_cep_prefix": "bounded_same_ibge_prefix_median", "municipality": "ibge_city_reference_with_locality_dispersion"}
ESTIMATE = ["latitude", "longitude", "evidence_count", "radius_km", "geo_source"]


def municipality_reference(localities: DataFrame) -> DataFrame:
    """(ibge, latitude, longitude, evidence_count, radius_km, geo_source): mean of the city points; count and radius
    over all localities; municipalities without a city point are left out. Two aggregates, no window, so a
    municipality with very many localities is summed in parts. locality_digests has the digests of its evidence."""
    city = F.col("category") == "Cidade"
    mean = localities.groupBy("ibge").agg(F.avg(F.when(city, F.col("latitude"))).alias("clat"), F.avg(F.when(city, F.col("longitude"))).alias("clon")).filter("clat is not null")
    rows = localities.join(mean, "ibge")
    far = F.max(distance_km(F.col("clat"), F.col("clon"), F.col("latitude"), F.col("longitude")))
    return rows.groupBy("ibge").agg(F.min("clat").alias("latitude"), F.min("clon").alias("longitude"), F.count("*").alias("evidence_count"), F.round(far, 3).alias("radius_km")).withColumn("geo_source", F.lit("ibge-localidades"))


# Fixed value: the category of localities that stands for a municipality without a city.
ADMINISTRATIVE = "Distrito Estadual de Fernando de Noronha"


def administrative_reference(localities: DataFrame, codes: DataFrame, category: str = ADMINISTRATIVE) -> DataFrame:
    """Reference of the requested codes (ibge) from the localities of one category, whose mean is the point. That all
    localities of those codes lie in bounds, whatever their category, is required here."""
    require_empty(bounds_problems(localities, codes), "localities out of bounds")
    rows = localities.join(codes.select("ibge").distinct(), "ibge", "left_semi").filter(F.col("category") == category)
    mean = rows.groupBy("ibge").agg(F.avg("latitude").alias("clat"), F.avg("longitude").alias("clon"))
    far = F.max(distance_km(F.col("clat"), F.col("clon"), F.col("latitude"), F.col("longitude")))
    own = rows.join(mean, "ibge").groupBy("ibge").agg(F.min("clat").alias("latitude"), F.min("clon").alias("longitude"), F.count("*").alias("evidence_count"), F.round(far, 3).alias("radius_km"))
    return own.withColumn("geo_source", F.lit("ibge-localidades-administrative"))


def bounds_problems(localities: DataFrame, codes: DataFrame) -> DataFrame:
    rows = localities.join(codes.select("ibge").distinct(), "ibge", "left_semi")
    return rows.filter(~F.coalesce(in_bounds(F.col("latitude"), F.col("longitude")), F.lit(False)))


def ibge_conflicts(addresses: DataFrame, first_party: DataFrame) -> DataFrame:
    """(cep, evidence_id, asserted, target): evidence that names another municipality than its code's."""
    both = first_party.filter("ibge is not null").select("cep", "evidence_id", F.col("ibge").alias("asserted")).join(addresses.select("cep", F.col("ibge").alias("target")), "cep")
    return both.filter(~F.col("asserted").eqNullSafe(F.col("target"))).select("cep", "evidence_id", "asserted", "target")


def observed(first_party: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    return bounded_centroid(unique_evidence(first_party, ["cep"]), ["cep"], 1, t.max_observed_radius_km, t)


def near_municipality(osm: DataFrame, addresses: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Map nodes with the distance_km to the reference point of their code's municipality, null without one."""
    reference = municipalities.select("ibge", F.col("latitude").alias("_mlat"), F.col("longitude").alias("_mlon"))
    rows = osm.drop("ibge").join(addresses.select("cep", "ibge"), "cep").join(reference, "ibge", "left")
    return rows.withColumn("distance_km", distance_km(F.col("latitude"), F.col("longitude"), F.col("_mlat"), F.col("_mlon"))).drop("_mlat", "_mlon")


def corroborated(osm: DataFrame, addresses: DataFrame, municipalities: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Map nodes of known codes near enough to their municipality's reference point."""
    return near_municipality(osm, addresses, municipalities).filter(F.col("distance_km") <= t.max_osm_municipality_distance_km)


def osm_postcode(osm: DataFrame, addresses: DataFrame, municipalities: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    return bounded_centroid(unique_evidence(corroborated(osm, addresses, municipalities, t), ["cep"]), ["cep"], 1, t.max_osm_radius_km, t)


def prefix_pool(first_party: DataFrame) -> DataFrame:
    """First-party evidence that names its municipality, with its prefix."""
    return first_party.filter("ibge is not null").withColumn("prefix", F.substring("cep", 1, 5))


def observed_prefix(first_party: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """By (prefix, ibge), from evidence that names its municipality."""
    keys = ["prefix", "ibge"]
    return bounded_centroid(unique_evidence(prefix_pool(first_party), keys), keys, t.min_prefix_samples, t.max_prefix_radius_km, t)


def require_sound(addresses: DataFrame, first_party: DataFrame, osm: DataFrame) -> None:
    """The rules that a build fails by: codes that stand twice, one identity of several places in a group, evidence of
    another municipality than its code's (whatever tier would win), unfit source categories."""
    require_empty(addresses.groupBy("cep").count().filter("count > 1").select("cep"), "codes that stand twice")
    pool = prefix_pool(first_party)
    for evidence, keys in ((first_party, ["cep"]), (osm, ["cep"]), (pool, ["prefix", "ibge"])):
        require_empty(evidence_conflicts(evidence, keys), "identities of several places")
        require_empty(category_problems(evidence, keys), "unfit source categories")
    require_empty(ibge_conflicts(addresses, first_party), "evidence of another municipality")


def digests(addresses: DataFrame, first_party: DataFrame, osm: DataFrame, municipalities: DataFrame, localities: DataFrame, t: Thresholds = Thresholds()) -> dict[str, DataFrame]:
    """tier -> (keys, evidence_digest) of the evidence that its estimates rest on: what the outlier rule keeps."""
    pools = {"observed_cep": (first_party, ["cep"]), "osm_postcode": (corroborated(osm, addresses, municipalities, t), ["cep"]), "observed_cep_prefix": (prefix_pool(first_party), ["prefix", "ibge"])}
    kept = {tier: evidence_digests(mad_filter(unique_evidence(rows, keys), keys, t).filter("retained"), keys) for tier, (rows, keys) in pools.items()}
    return kept | {"municipality": locality_digests(localities)}


def locality_digests(localities: DataFrame, source: str = "ibge-localidades") -> DataFrame:
    """(ibge, evidence_digest) over all localities of a municipality, each as often as it stands."""
    rows = localities.select("ibge", F.lit(None).cast("string").alias("evidence_id"), F.lit(source).alias("source"), "latitude", "longitude")
    return evidence_digests(rows, ["ibge"], distinct=False)


def administrative_digests(localities: DataFrame, category: str = ADMINISTRATIVE) -> DataFrame:
    """(ibge, evidence_digest) over the localities that an administrative reference rests on."""
    return locality_digests(localities.filter(F.col("category") == category), "ibge-localidades-administrative")


def require_references(municipalities: DataFrame) -> None:
    if municipalities.isEmpty():
        raise GateError("no municipality has a city point")


def resolve(addresses: DataFrame, first_party: DataFrame, osm: DataFrame, municipalities: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """addresses (cep, ibge, ...) with precision (null: unresolved) and the estimate of the first tier that has one."""
    packed = lambda df, keys, name: df.select(*keys, F.struct(*ESTIMATE).alias(name))
    rows = addresses.withColumn("prefix", F.substring("cep", 1, 5))
    rows = rows.join(packed(observed(first_party, t), ["cep"], "t1"), "cep", "left")
    rows = rows.join(packed(osm_postcode(osm, addresses, municipalities, t), ["cep"], "t2"), "cep", "left")
    rows = rows.join(packed(observed_prefix(first_party, t), ["prefix", "ibge"], "t3"), ["prefix", "ibge"], "left")
    rows = rows.join(packed(municipalities, ["ibge"], "t4"), "ibge", "left")
    precision = F.coalesce(*(F.when(F.col(f"t{i + 1}").isNotNull(), F.lit(tier)) for i, tier in enumerate(TIERS)))
    first = F.coalesce("t1", "t2", "t3", "t4")
    return rows.select(*addresses.columns, "prefix", precision.alias("precision"), *(first[c].alias(c) for c in ESTIMATE))


def tier_distribution(resolved: DataFrame) -> DataFrame:
    """(tier, n) for all five tiers, zero included."""
    spark = resolved.sparkSession
    tiers = spark.createDataFrame([(t,) for t in (*TIERS, "unresolved")], "tier string")
    counts = resolved.groupBy(F.coalesce("precision", F.lit("unresolved")).alias("tier")).agg(F.count("*").alias("found"))
    return tiers.join(counts, "tier", "left").select("tier", F.coalesce("found", F.lit(0)).alias("n"))
