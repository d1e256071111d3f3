"""Robust centroids: distinct evidence, the median/MAD outlier rule, medians with the radius around them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postalis.config import Thresholds
from postalis.functions import distance_km, float_hex, source_category, valid_category


def identity() -> Column:
    """What makes two observations the same: the given identity, else the source."""
    return F.coalesce("evidence_id", "source")


def evidence_conflicts(evidence: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, evidence_id, versions): identities that stand for different places, within a group or anywhere."""
    own = evidence.withColumn("evidence_id", identity())
    places = own.groupBy(*(keys or []), "evidence_id").agg(F.countDistinct("latitude", "longitude", "source").alias("versions"))
    return places.filter("versions > 1")


def unique_evidence(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """One row an identity in a group; conflicts are a gate of their own. Dealt out by the keys, so what follows by
    group needs no further shuffle."""
    return evidence.repartition(*keys).withColumn("_identity", identity()).dropDuplicates([*keys, "_identity"]).drop("_identity")


def category_problems(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, categories, problem): groups without one to sixteen source categories, or with a malformed one."""
    category = source_category(F.col("source"))
    found = evidence.groupBy(*keys).agg(F.countDistinct(category).alias("categories"), F.count_if(~F.coalesce(valid_category(category), F.lit(False))).alias("bad"))
    problem = F.when(F.col("bad") > 0, "malformed").when(~F.col("categories").between(1, 16), "number")
    return found.withColumn("problem", problem).filter("problem is not null").select(*keys, "categories", "problem")


def mad_filter(points: DataFrame, keys: list[str], t: Thresholds = Thresholds()) -> DataFrame:
    """points with `retained`: within max(floor, median + multiplier * MAD) of the group's median point.

    Groups under outlier_min_samples keep all. One shuffle on the keys serves the whole chain of windows.
    """
    group = Window.partitionBy(*keys)
    d = distance_km(F.col("_clat"), F.col("_clon"), F.col("latitude"), F.col("longitude"))
    rows = points.withColumns({"_clat": F.median("latitude").over(group), "_clon": F.median("longitude").over(group), "_n": F.count("*").over(group)})
    rows = rows.withColumn("_d", d)
    rows = rows.withColumn("_md", F.median("_d").over(group))
    rows = rows.withColumn("_mad", F.median(F.abs(F.col("_d") - F.col("_md"))).over(group))
    limit = F.greatest(F.lit(t.outlier_floor_km), F.col("_md") + t.outlier_mad_multiplier * F.col("_mad"))
    return rows.withColumn("retained", (F.col("_n") < t.outlier_min_samples) | (F.col("_d") <= limit)).drop("_clat", "_clon", "_n", "_d", "_md", "_mad")


def robust_centroid(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, latitude, longitude, evidence_count, radius_km rounded to metres, geo_source)."""
    group = Window.partitionBy(*keys)
    rows = points.withColumns({"_clat": F.median("latitude").over(group), "_clon": F.median("longitude").over(group)})
    rows = rows.withColumn("_d", distance_km(F.col("_clat"), F.col("_clon"), F.col("latitude"), F.col("longitude")))
    return rows.groupBy(*keys).agg(
        F.min("_clat").alias("latitude"), F.min("_clon").alias("longitude"), F.count("*").alias("evidence_count"), F.round(F.max("_d"), 3).alias("radius_km"),
        F.array_join(F.array_sort(F.collect_set(source_category(F.col("source")))), ",").alias("geo_source"),  # a few categories
    )


def bounded_centroid(points: DataFrame, keys: list[str], min_samples: int, max_radius_km: float, t: Thresholds = Thresholds()) -> DataFrame:
    """The robust centroid of what the outlier rule keeps, where there are enough points close enough together."""
    kept = mad_filter(points, keys, t).filter("retained").drop("retained")
    return robust_centroid(kept, keys).filter((F.col("evidence_count") >= min_samples) & (F.col("radius_km") <= max_radius_km))


def evidence_digests(points: DataFrame, keys: list[str], distinct: bool = True) -> DataFrame:
    """(keys, evidence_digest): SHA-256 of a group's evidence as JSON of [identity, latitude, longitude], sorted, places
    in hexadecimal; distinct: an identity counts once (of two places the smaller, so gate conflicts first). The bytes
    need Python's JSON escapes; rows come sorted and are hashed as they pass, so a group may be of any size."""
    own = points.select(*(F.col(k).cast("string").alias(k) for k in keys), identity().alias("_id"), float_hex(F.col("latitude")).alias("_lat"), float_hex(F.col("longitude")).alias("_lon"))
    if distinct:
        place = F.min(F.struct("_lat", "_lon")).alias("_p")
        own = own.repartition(*keys).groupBy(*keys, "_id").agg(place).select(*keys, "_id", "_p._lat", "_p._lon")
    rows = own.repartition(*keys).sortWithinPartitions(*keys, "_id", "_lat", "_lon")
    schema = ", ".join([*(f"`{k}` string" for k in keys), "evidence_digest string"])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, digest, out = None, None, []
        for frame in batches:
            for *key, name, lat, lon in frame.itertuples(index=False, name=None):
                if key != group:
                    if group is not None:
                        digest.update(b"]")
                        out.append((*group, "sha256:" + digest.hexdigest()))
                    group, digest = key, hashlib.sha256(b"[")
                else:
                    digest.update(b",")
                digest.update(json.dumps([name, lat, lon], separators=(",", ":")).encode())
            yield pd.DataFrame(out, columns=[*keys, "evidence_digest"])
            out = []
        if group is not None:
            digest.update(b"]")
            yield pd.DataFrame([(*group, "sha256:" + digest.hexdigest())], columns=[*keys, "evidence_digest"])

    return rows.mapInPandas(fold, schema)
