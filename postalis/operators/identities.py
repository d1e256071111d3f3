"""Count identities of a refresh: named counts, declared by its manifest and measured from its rows and diff, must agree
with each other and make up linear identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.operators.gates import GateError, require_empty
from postalis.operators.refresh import ACTIONS, ALLOWED, CANDIDATE_PRECISIONS

# The parts that a snapshot's records are counted by.
CODE_TYPES, VALIDITIES = ("1", "2", "3", "4", "5", "6"), ("active", "expired")
RESOLUTIONS = ("cep_unidade_operacional", "direct", "numero_localidade_superior", "numero_localidade_superior+cep_unidade_operacional", "source_link_conflict", "unresolved")

COUNTS = "name string, n long"


def total(name: str, parts: list[str]) -> dict[str, int]:
    """The identity of a count with the sum of its parts, as coefficients that make zero."""
    return {name: -1, **dict.fromkeys(parts, 1)}


def of(field: str, keys) -> list[str]:
    return [f"{field}.{k}" for k in keys]


_CLASSES = of("classification", ALLOWED)
IDENTITIES: dict[str, dict[str, int]] = {
    "rows by classification": total("candidate.rows", _CLASSES),
    "rows by action": total("candidate.rows", of("action", ACTIONS)),
    "rows located or not": total("candidate.rows", ["candidate.located", "candidate.unresolved"]),
    "located rows by precision": total("candidate.located", of("precision", CANDIDATE_PRECISIONS)),
    "rows are current ones and additions": total("candidate.rows", ["current.rows", "classification.added"]),
    "current rows by classification": total("current.rows", [c for c in _CLASSES if c != "classification.added"]),
    "rows are the snapshot's and missing ones": total("candidate.rows", ["snapshot.records", "classification.missing_from_source"]),
    "snapshot by classification": total("snapshot.records", [c for c in _CLASSES if c != "classification.missing_from_source"]),
    "snapshot is raw without duplicates": total("snapshot.raw_records", ["snapshot.records", "snapshot.duplicate_records"]),
    "source total is raw": total("snapshot.source_total", ["snapshot.raw_records"]),
    "snapshot by type": total("snapshot.records", of("type", CODE_TYPES)),
    "raw by type": total("snapshot.raw_records", of("raw_type", CODE_TYPES)),
    "snapshot by validity": total("snapshot.records", of("validity", VALIDITIES)),
    "raw by validity": total("snapshot.raw_records", of("raw_validity", VALIDITIES)),
    "snapshot by resolution": total("snapshot.records", of("resolution", RESOLUTIONS)),
}
#: Sums that must not be negative: duplicates make groups of one at least; pages hold all raw records, the last not empty.
BOUNDS: dict[str, dict[str, int]] = {"duplicate groups": {"snapshot.duplicate_records": 1, "snapshot.duplicate_groups": -1}}
PAGES = ("snapshot.page_count", "snapshot.page_size", "snapshot.raw_records")
NAMES = sorted({n for terms in (*IDENTITIES.values(), *BOUNDS.values()) for n in terms} | set(PAGES))


def table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Declared counts as rows. Each known name must have a whole number of zero or more, and no other name."""
    odd = sorted(set(NAMES) ^ set(counts)) + sorted(n for n, x in counts.items() if isinstance(x, bool) or not isinstance(x, int) or x < 0)
    if odd:
        raise GateError(f"counts that are missing, unknown or no number: {odd[:10]}")
    return spark.createDataFrame(sorted(counts.items()), COUNTS)


def differences(counts: DataFrame, identities: dict[str, dict[str, int]] = IDENTITIES, complete: bool = False) -> DataFrame:
    """(identity, terms, difference) of counts (name, n): the weighted sum, zero where the identity holds. An identity of
    which a count isn't there is left out, or with complete an error."""
    terms = counts.sparkSession.createDataFrame([(i, n, c, len(t)) for i, t in identities.items() for n, c in t.items()], "identity string, name string, factor int, size int")
    found = terms.join(counts, "name", "left").groupBy("identity", "size").agg(F.count("n").alias("terms"), F.sum(F.col("factor") * F.col("n")).alias("difference"))
    if complete:
        require_empty(found.filter("terms < size").select("identity"), "identities of which a count is missing")
    return found.filter("terms = size").select("identity", F.col("terms").cast("long").alias("terms"), "difference")


def by_value(rows: DataFrame, field: str, column: str, keys) -> DataFrame:
    """(name, n) of a column's values, zero included; others under their own names."""
    found = rows.filter(F.col(column).isNotNull()).groupBy(F.concat(F.lit(f"{field}."), F.col(column)).alias("name")).agg(F.count("*").alias("n"))
    fixed = rows.sparkSession.createDataFrame([(n,) for n in of(field, keys)], "name string")
    return fixed.join(found, "name", "full").select("name", F.coalesce("n", F.lit(0)).alias("n"))


def measured(candidate: DataFrame, diff: DataFrame) -> DataFrame:
    """(name, n) of what rows and diff show themselves."""
    one = candidate.agg(F.count("*").alias("candidate.rows"), F.count("latitude").alias("candidate.located"), F.count_if(F.col("latitude").isNull()).alias("candidate.unresolved"))
    rows = one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("n")) for c in one.columns))))
    parts = [rows, by_value(candidate, "precision", "precision", CANDIDATE_PRECISIONS), by_value(diff, "classification", "classification", ALLOWED), by_value(diff, "action", "geography_action", ACTIONS)]
    return reduce(DataFrame.unionByName, parts)


def disagreements(declared: DataFrame, found: DataFrame) -> DataFrame:
    """(name, declared, measured): counts that were measured and declared otherwise, or not at all."""
    both = found.select("name", F.col("n").alias("measured")).join(declared.select("name", F.col("n").alias("declared")), "name", "left")
    return both.filter(~F.col("declared").eqNullSafe(F.col("measured"))).select("name", "declared", "measured")


def require_counts(counts: dict[str, int], candidate: DataFrame, diff: DataFrame) -> None:
    """A refresh's declared counts are whole, keep every identity, and are those of its rows and diff."""
    declared = table(candidate.sparkSession, counts)
    require_empty(differences(declared, complete=True).filter("difference <> 0").select("identity", "difference"), "counts that don't add up")
    require_empty(differences(declared, BOUNDS, complete=True).filter("difference < 0").select("identity", "difference"), "counts out of bounds")
    pages, size, raw = (counts[n] for n in PAGES)
    if size < 1 or pages != -(-raw // size):
        raise GateError(f"{pages} pages of {size} don't hold {raw} records")
    require_empty(disagreements(declared, measured(candidate, diff)), "counts that rows or diff contradict")
