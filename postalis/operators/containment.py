"""Which observations lie in the polygon of their code's municipality, in exact integer geometry (nanodegrees)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.operators.gates import require_empty

BIN = 50_000_000  # 0.05 degrees
NANO = "cast(rint({} * 1e9) as bigint)"


def edge_bins(edges: DataFrame) -> DataFrame:
    """edges (ibge, x1, y1, x2, y2) once for each latitude bin they touch."""
    low, high = "(least(y1, y2) + 90000000000) div {0}", "(greatest(y1, y2) + 90000000000) div {0}"
    return edges.withColumn("bin", F.explode(F.expr(f"sequence({low.format(BIN)}, {high.format(BIN)})")))


def classify(points: DataFrame, edges: DataFrame, key: str = "evidence_id") -> DataFrame:
    """points (key, ibge, latitude, longitude) with position: interior, boundary or outside, by even-odd crossings.

    An equi-join on municipality and latitude bin brings a point to the few edges that can matter; being on an edge
    wins over parity, so rings may turn either way and holes and islands need no marking. Rows that say the same count
    once, since parity would cancel them; a key with several places gets a row for each.
    """
    places = points.select(key, "ibge", F.expr(NANO.format("longitude")).alias("x"), F.expr(NANO.format("latitude")).alias("y")).distinct()
    rows = places.withColumn("bin", F.expr(f"(y + 90000000000) div {BIN}"))
    both = rows.join(edge_bins(edges), ["ibge", "bin"], "left")
    side = "(cast(x - x1 as decimal(13,0)) * cast(y2 - y1 as decimal(13,0)) - cast(y - y1 as decimal(13,0)) * cast(x2 - x1 as decimal(13,0)))"
    on = F.expr(f"coalesce({side} = 0 and x between least(x1, x2) and greatest(x1, x2) and y between least(y1, y2) and greatest(y1, y2), false)")
    crossing = F.expr(f"coalesce((y1 > y) <> (y2 > y) and (-{side} > 0) = (y2 > y1), false)")
    found = both.groupBy(key, "ibge", "x", "y").agg(F.bool_or(on).alias("on"), (F.count_if(crossing) % 2 == 1).alias("odd"))
    return found.select(key, F.when(F.col("on"), "boundary").when(F.col("odd"), "interior").otherwise("outside").alias("position"))


def targets(observations: DataFrame, addresses: DataFrame) -> DataFrame:
    """observations with the municipality of their code; null for unknown codes, which stay eligible."""
    return observations.drop("ibge").join(addresses.select("cep", "ibge"), "cep", "left")


def missing_polygons(observations: DataFrame, addresses: DataFrame, edges: DataFrame) -> DataFrame:
    """(ibge): municipalities of observed codes that have no polygon."""
    return targets(observations, addresses).filter("ibge is not null").select("ibge").distinct().join(edges.select("ibge").distinct(), "ibge", "left_anti")


def require_identities(observations: DataFrame, key: str = "evidence_id") -> None:
    """An identity stands once: a repeated one is an error, whatever it says."""
    require_empty(observations.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).select(key), "repeated or missing identities of observations")


def select(observations: DataFrame, addresses: DataFrame, edges: DataFrame) -> DataFrame:
    """observations with ibge, position (unknown_cep where the code isn't known) and eligible. Their identities must differ."""
    require_identities(observations)
    rows = targets(observations, addresses)
    placed = rows.join(classify(rows.filter("ibge is not null"), edges), "evidence_id", "left")
    position = F.when(F.col("ibge").isNull(), "unknown_cep").otherwise(F.col("position"))
    return placed.withColumn("position", position).withColumn("eligible", F.col("position") != "outside")


def selection_statistics(selected: DataFrame) -> DataFrame:
    """Counts by position; the outside fraction is of the known codes only."""
    is_ = lambda p: F.count_if(F.col("position") == p)
    known = F.count_if(F.col("position") != "unknown_cep")
    return selected.agg(
        F.count("*").alias("observations"), known.alias("known"), F.count_if("eligible").alias("eligible"), is_("interior").alias("interior"), is_("boundary").alias("boundary"),
        is_("outside").alias("outside"), F.round(F.coalesce(is_("outside") / F.nullif(known, F.lit(0)), F.lit(0.0)), 8).alias("outside_fraction"),
    )
