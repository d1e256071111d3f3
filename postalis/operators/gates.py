"""Fail-closed checks: an action that counts violations, since an unused assertion column would be pruned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A data set breaks a rule."""


def require_empty(df: DataFrame, message: str) -> None:
    if found := df.limit(10).collect():
        raise GateError(f"{message}: {[tuple(r) for r in found]}")


def failed_rules(**rules: Column) -> Column:
    """Sorted names of the rules (true: fine) that a row breaks; a null counts as broken."""
    return F.array_sort(F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()))))
