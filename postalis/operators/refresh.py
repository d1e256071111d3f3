"""Refreshing a published table: filling gaps, validating a diff, comparing two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postalis.operators import strict
from postalis.operators.gates import GateError, failed_rules, require_empty
from postalis.sources.lines import placed_lines

# Which geography actions a classification of a diff row allows, and the row's keys.
ALLOWED = {
    "added": ("assigned_municipality", "unresolved"),
    "address_changed": ("invalidated_exact_to_municipality", "preserved"),
    "ibge_changed": ("reassigned_municipality",),
    "missing_from_source": ("retained_missing",),
    "source_link_conflict": ("retained_source_link_conflict",),
    "unchanged": ("preserved",),
}
ACTIONS = ("assigned_municipality", "invalidated_exact_to_municipality", "preserved", "reassigned_municipality", "retained_missing", "retained_source_link_conflict", "unresolved")
DIFF = "candidate_included boolean, cep string, changed_fields array<string>, classification string, current_ibge string, geography_action string, previous_cep string, previous_ibge string, valid_until string"
_OPEN = (*strict.TEXT, *strict.NOTHING)
DIFF_SHAPE: strict.Shape = {
    "candidate_included": strict.FLAG, "cep": strict.TEXT, "changed_fields": strict.TEXTS, "classification": strict.TEXT, "geography_action": strict.TEXT,
    "current_ibge": _OPEN, "previous_cep": _OPEN, "previous_ibge": _OPEN, "valid_until": _OPEN,
}
MOST_DIFF_LINE = 65_536
# Precisions that a candidate may carry; methods of filled rows.
CANDIDATE_PRECISIONS = ("municipality", "osm_postcode")
FILLED = {"municipality": "ibge_municipality_reference", "administrative": "ibge_administrative_locality_aggregate"}
ORIGINS = ("geo_inherited", "geo_filled_municipality", "geo_filled_administrative", "geo_unresolved")
ESTIMATE = ["latitude", "longitude", "precision", "method", "evidence_count", "evidence_radius_km", "geo_source", "evidence_digest"]


def reference(table: DataFrame, kind: str) -> DataFrame:
    """(ibge, estimate as filled rows carry it) from references (ibge, latitude, longitude, evidence_count, radius_km,
    geo_source, evidence_digest)."""
    values = {"precision": F.lit("municipality"), "method": F.lit(FILLED[kind]), "evidence_radius_km": F.col("radius_km"), "geo_source": F.array("geo_source")}
    return table.select("ibge", F.struct(*(values.get(c, F.col(c)).alias(c) for c in ESTIMATE)).alias(kind))


def fill_null_geo(rows: DataFrame, municipalities: DataFrame, administrative: DataFrame) -> DataFrame:
    """Flat rows with gaps filled from the municipality, else the administrative reference; origin: one of ORIGINS.
    What is located stays untouched."""
    located = F.col("latitude").isNotNull()
    both = rows.join(reference(municipalities, "municipality"), "ibge", "left").join(reference(administrative, "administrative"), "ibge", "left")
    both = both.withColumn("_geo", F.when(~located, F.coalesce("municipality", "administrative")))
    origin = F.when(located, ORIGINS[0]).when(F.col("municipality").isNotNull(), ORIGINS[1]).when(F.col("administrative").isNotNull(), ORIGINS[2]).otherwise(ORIGINS[3])
    return both.select(*(F.when(located, F.col(c)).otherwise(F.col(f"_geo.{c}")).alias(c) if c in ESTIMATE else c for c in rows.columns), origin.alias("origin"))


def unreferenced(rows: DataFrame, municipalities: DataFrame) -> DataFrame:
    """(ibge): municipalities of rows without a place that have no reference; what administrative ones are asked for."""
    return rows.filter("latitude is null").select("ibge").distinct().join(municipalities.select("ibge"), "ibge", "left_anti")


def counted(rows: DataFrame, column: str, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """(value, n) over fixed keys, zero included."""
    fixed = rows.sparkSession.createDataFrame([(k,) for k in keys], "value string")
    return fixed.join(rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("found")), "value", "left").select("value", F.coalesce("found", F.lit(0)).alias("n"))


def diff_counts(diff: DataFrame) -> DataFrame:
    """(field, value, n): rows by classification and by action, over all that exist, zero included."""
    both = [counted(diff, field, keys).select(F.lit(field).alias("field"), "value", "n") for field, keys in (("classification", list(ALLOWED)), ("geography_action", ACTIONS))]
    return both[0].unionByName(both[1])


def candidate_counts(rows: DataFrame) -> DataFrame:
    """One row: rows, located and unresolved ones, of each candidate precision, and of any other."""
    return rows.agg(
        F.count("*").alias("candidate_rows"), F.count("latitude").alias("located_rows"), (F.count("*") - F.count("latitude")).alias("unresolved_rows"),
        *(F.count_if(F.col("precision") == p).alias(p) for p in CANDIDATE_PRECISIONS), F.count_if(~F.col("precision").isin(*CANDIDATE_PRECISIONS)).alias("other_precisions"),
    )


def invalid_pairs(diff: DataFrame, allowed: dict[str, tuple[str, ...]] = ALLOWED) -> DataFrame:
    """Diff rows whose action their classification doesn't allow."""
    pairs = diff.sparkSession.createDataFrame([(c, a) for c, actions in allowed.items() for a in actions], "classification string, geography_action string")
    return diff.join(pairs, ["classification", "geography_action"], "left_anti")


def diff_problems(diff: DataFrame) -> DataFrame:
    """(cep, failed): diff rows with the sorted names of the rules that they break."""
    code = lambda name, pattern: F.col(name).isNull() | F.col(name).rlike(pattern)
    pairs = F.lit(False)
    for classification, actions in ALLOWED.items():
        pairs = pairs | ((F.col("classification") == classification) & F.col("geography_action").isin(*actions))
    fields = F.col("changed_fields")
    failed = failed_rules(
        cep=F.col("cep").rlike("^[0-9]{8}$"), included=F.col("candidate_included"), classification=F.col("classification").isin(*ALLOWED), action=F.col("geography_action").isin(*ACTIONS), pair=pairs,
        changed_fields=F.forall(fields, lambda x: F.coalesce(x != "", F.lit(False))) & (F.size(F.array_distinct(fields)) == F.size(fields)),
        current_ibge=code("current_ibge", "^[0-9]{7}$"), previous_ibge=code("previous_ibge", "^[0-9]{7}$"), previous_cep=code("previous_cep", "^[0-9]{8}$"),
    )
    return diff.select("cep", failed.alias("failed")).filter(F.size("failed") > 0)


def require_diff(diff: DataFrame, position: str | None = None) -> None:
    """A diff has rows, sound ones, each code once and, with a position, in order."""
    if diff.isEmpty():
        raise GateError("the diff has no row")
    require_empty(diff_problems(diff), "unfit diff rows")
    require_empty(diff.groupBy("cep").count().filter("count > 1").select("cep"), "codes that stand twice in the diff")
    if position is not None:
        require_empty(order_violations(diff, position), "diff rows out of order")


def read_diff(spark: SparkSession, path: str) -> DataFrame:
    """Diff rows of a file of JSON lines with exactly the known keys and kinds, each line ended, in rising order of codes."""
    lines = placed_lines(spark, path, MOST_DIFF_LINE)
    require_empty(lines.filter("not ended").select("file", "offset"), "a diff line without a line feed")
    odd = strict.strict(F.col("value"), DIFF_SHAPE)
    require_empty(lines.select("file", "offset", odd.alias("problems")).filter(F.size("problems") > 0), "diff lines of other keys or kinds")
    diff = lines.select("position", F.from_json("value", DIFF, {"mode": "FAILFAST"}).alias("r")).select("position", "r.*")
    require_diff(diff, "position")
    return diff.drop("position")


def refreshed(rows: DataFrame, municipalities: DataFrame, administrative: DataFrame) -> DataFrame:
    """A candidate's rows with every gap filled; one that no reference fills is an error."""
    filled = fill_null_geo(rows, municipalities, administrative)
    require_empty(filled.filter(F.col("origin") == ORIGINS[3]).select("cep"), "rows that no reference fills")
    return filled.drop("origin")


def compare(left: DataFrame, right: DataFrame, key: str = "cep") -> DataFrame:
    """(key, difference): missing, extra or unequal rows of two tables with the same columns."""
    columns = [c for c in left.columns if c != key]
    a, b = left.select(key, F.struct(*columns).alias("a")), right.select(key, F.struct(*columns).alias("b"))
    both = a.join(b, key, "full")
    difference = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("b")), "unequal")
    return both.select(key, difference.alias("difference")).filter("difference is not null")


def order_violations(rows: DataFrame, position: str, key: str = "cep", span: int = 100_000) -> DataFrame:
    """(position, key) where the key isn't greater than the one before. Positions of one file; the order is checked in
    ranges of `span` positions, so no single task sees the whole file. Each range gets the last key of the one before
    that has any rows, by a window over the ranges' ends, a row a range."""
    own = rows.select(position, key).withColumn("_c", F.floor(F.col(position) / span))
    ends = own.groupBy("_c").agg(F.max_by(key, position).alias("_last"))
    carried = ends.select("_c", F.lag("_last").over(Window.orderBy("_c")).alias("_before"))
    before = F.coalesce(F.lag(key).over(Window.partitionBy("_c").orderBy(position)), F.col("_before"))
    return own.join(carried, "_c", "left").withColumn("_p", before).filter(F.col(key) <= F.col("_p")).select(position, key)
