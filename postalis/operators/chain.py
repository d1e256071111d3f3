"""A chain of releases: what a candidate inherits from its base must be the base's, row by row.

Both tables are digested by ranges of codes, in any order of rows; only ranges whose digests differ are read again and
compared, so a refresh that touches little costs two sums and a little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.operators.gates import GateError, require_empty
from postalis.operators.manifest import digest_text, row_hashes
from postalis.operators.refresh import ESTIMATE, compare

#: First digits of a code that name its range.
DIGITS = 3
# Bounds that a scan is pruned by at most; what sorts behind any rest of a code.
MOST_BOUNDS, LAST = 16, "\U0010ffff"
# Classifications whose rows stay whole, and the action whose rows keep their place.
WHOLE, KEPT = ("unchanged", "missing_from_source", "source_link_conflict"), "preserved"


def range_digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(range, records, first, second) of a table's columns; a thousand rows at most."""
    first, second = row_hashes(columns)
    return rows.groupBy(F.substring("cep", 1, DIGITS).alias("range")).agg(F.count("*").alias("records"), F.sum(first).alias("first"), F.sum(second).alias("second"))


def differing(a: DataFrame, b: DataFrame) -> list[str]:
    """Ranges whose digests differ."""
    left, right = a.select("range", F.struct("records", "first", "second").alias("a")), b.select("range", F.struct("records", "first", "second").alias("b"))
    return sorted(r.range for r in left.join(right, "range", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("range").collect())  # a row a range


def within(rows: DataFrame, ranges: list[str]) -> DataFrame:
    """Rows of ranges of codes, by their first digits, and by few bounds around neighbouring ranges that file statistics can
    prune by: a bound a range would nest deeper than a plan may."""
    size, bounds = -(-len(ranges) // MOST_BOUNDS) or 1, F.lit(False)
    for k in range(0, len(ranges), size):
        bounds = bounds | F.col("cep").between(ranges[k], ranges[k : k + size][-1] + LAST)
    return rows.filter(bounds & F.substring("cep", 1, DIGITS).isin(ranges))


def inherited_problems(base: DataFrame, candidate: DataFrame, diff: DataFrame) -> DataFrame:
    """(cep, problem): base rows that the candidate lacks, rows that it has more without their being added, rows that differ
    though the diff keeps them whole, or in their place though it is preserved. Versions may differ."""
    columns = [c for c in base.columns if c != "dataset_version"]
    ranges = differing(range_digests(base, columns), range_digests(candidate, columns))
    old, new, said = (within(x, ranges) for x in (base.select(*columns), candidate.select(*columns), diff))
    changed = compare(old, new).join(said.select("cep", "classification", "geography_action"), "cep", "left")
    moved = compare(old.select("cep", *ESTIMATE), new.select("cep", *ESTIMATE)).select("cep", F.lit(True).alias("moved"))
    whole = F.coalesce(F.col("classification").isin(*WHOLE), F.lit(True))
    place = F.coalesce(F.col("geography_action") == KEPT, F.lit(True)) & F.coalesce("moved", F.lit(False))
    problem = F.when(F.col("difference") == "missing", "missing").when((F.col("difference") == "extra") & ~F.coalesce(F.col("classification") == "added", F.lit(False)), "not added")
    problem = problem.when((F.col("difference") == "unequal") & whole, "changed").when((F.col("difference") == "unequal") & place, "moved")
    return changed.join(moved, "cep", "left").select("cep", problem.alias("problem")).filter("problem is not null")


def require_inherited(base: DataFrame, candidate: DataFrame, diff: DataFrame, recorded: str | None = None) -> None:
    """The base is the recorded one (its manifest's digest of rows), and the candidate inherits from it what the diff says."""
    if recorded is not None:
        found = base.agg(F.count(F.lit(1)), *(F.sum(h) for h in row_hashes(base.columns))).first()
        if digest_text(*found) != recorded:
            raise GateError("the base isn't the release that its manifest records")
    require_empty(inherited_problems(base, candidate, diff), "rows that aren't inherited as the diff says")
