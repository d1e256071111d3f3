"""Thresholds of the estimator and of the evaluation, validated on construction."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

from postalis.functions import STATES

TIERS = ("observed_cep", "osm_postcode", "observed_cep_prefix", "municipality")


@dataclass(frozen=True)
class Thresholds:
    min_prefix_samples: int = 3
    max_prefix_radius_km: float = 25.0
    max_observed_radius_km: float = 10.0
    max_osm_radius_km: float = 5.0
    max_osm_municipality_distance_km: float = 250.0
    outlier_min_samples: int = 3
    outlier_mad_multiplier: float = 3.0
    outlier_floor_km: float = 0.25

    def __post_init__(self) -> None:
        for name, value in asdict(self).items():
            if isinstance(value, bool) or not isinstance(value, int | float) or value <= 0:
                raise ValueError(f"{name} must be a positive number")
        if self.min_prefix_samples < 2 or self.outlier_min_samples < 3:
            raise ValueError("sample minima must be at least 2 in a prefix and 3 for outliers")


def load_thresholds(path: str | Path) -> Thresholds:
    """From a JSON document with exactly the known thresholds; the file's tier order must be the built-in one."""
    document = json.loads(Path(path).read_text("utf-8"))
    if tuple(document.get("tier_order", (*TIERS, "unresolved"))) != (*TIERS, "unresolved"):
        raise ValueError("unknown tier order")
    found = document["thresholds"]
    if set(found) != set(Thresholds.__dataclass_fields__):
        raise ValueError("thresholds must be exactly the known ones")
    return Thresholds(**found)


# The two cohorts, build thresholds by the statistic they bound, and what each cohort and official sample
# is bounded by.
COHORTS = ("leave_observation_out", "unseen_cep")
BUILD = {
    "record_count": ("min", "minimum_records"), "coverage": ("min", "minimum_coverage"), "unresolved": ("max", "maximum_unresolved"), "uf_count": ("min", "minimum_ufs"),
    "invalid_bounds": ("max", "maximum_invalid_bounds"), "uf_ibge_mismatches": ("max", "maximum_uf_ibge_mismatches"), "municipality_conflicts": ("max", "maximum_municipality_conflicts"),
    "max_geo_source_bytes": ("max", "maximum_geo_source_bytes"), "max_digest_bytes": ("max", "maximum_evidence_digest_bytes"), "invalid_digests": ("max", "maximum_invalid_evidence_digests"),
}
FRACTIONS = ("maximum_missing_fraction", "maximum_prediction_failure_fraction")


@dataclass(frozen=True)
class Rule:
    """What a value in a policy must be: bool counts as no number."""

    fits: Callable[[object], bool]
    wants: str


def number(low: float | None = None, high: float | None = None, whole: bool = False, above: bool = False) -> Rule:
    def fits(x: object) -> bool:
        if isinstance(x, bool) or not isinstance(x, int if whole else (int, float)):
            return False
        return (low is None or (x > low if above else x >= low)) and (high is None or x <= high)

    return Rule(fits, f"a{' whole' if whole else ''} number" + (f" {'above' if above else 'from'} {low}" if low is not None else "") + (f" to {high}" if high is not None else ""))


def names(allowed: tuple[str, ...] | None = None, least: int = 0) -> Rule:
    def fits(x: object) -> bool:
        return isinstance(x, list) and len(x) >= least and all(isinstance(v, str) and v and (allowed is None or v in allowed) for v in x) and len(set(x)) == len(x)

    return Rule(fits, f"a list of {least} or more different names" + (" of states" if allowed else ""))


@dataclass(frozen=True)
class QualityPolicy:
    """A versioned document of thresholds for a build, its evidence, the hold-out cohorts, states, purposes and an official
    sample; problems() says what is wrong with it."""

    document: dict
    sha256: str = ""
    version: str = field(init=False, default="")

    def __post_init__(self) -> None:
        object.__setattr__(self, "version", self.document.get("version", "") if isinstance(self.document, dict) else "")
        if found := self.problems():
            raise ValueError("unfit quality policy: " + "; ".join(found))

    def at(self, *path: str) -> object:
        value: object = self.document
        for name in path:
            value = value.get(name) if isinstance(value, dict) else None
        return value

    def problems(self) -> list[str]:
        states, share = tuple(STATES), number(0, 1)
        want: list[tuple[tuple[str, ...], Rule]] = [(("version",), Rule(lambda x: isinstance(x, str) and x != "", "a name"))]
        want += [(("brazil_bounds", f"{axis}_{end}"), number()) for axis in ("latitude", "longitude") for end in ("min", "max")]
        want += [(("build_thresholds", name), number()) for _, name in BUILD.values()]
        want += [(("build_thresholds", "allowed_precision_tiers"), names(least=1)), (("validation", "modulus"), number(2, whole=True)), (("validation", "remainder"), number(0, whole=True))]
        want += [(("validation", "osm_evidence", "maximum_outside_target_municipality_fraction"), share)]
        for cohort in COHORTS:
            own = ("validation", "cohorts", cohort)
            want += [((*own, n), number(0, whole=True)) for n in ("minimum_records", "minimum_ufs")] + [((*own, n), share) for n in FRACTIONS] + [((*own, "required_address_classes"), names())]
        in_cohort = Rule(lambda x: x in COHORTS, f"one of {', '.join(COHORTS)}")
        want += [(("validation", "per_uf", "cohort"), in_cohort), (("validation", "per_uf", "required_ufs"), names(states, 1))]
        for uf in self.at("validation", "per_uf", "thresholds") or ():
            own = ("validation", "per_uf", "thresholds", uf)
            want += [((*own, "minimum_samples"), number(1, whole=True)), ((*own, "maximum_p95_km"), number(0, above=True))]
        for purpose in self.at("validation", "purposes") or ():
            own = ("validation", "purposes", purpose)
            want += [((*own, "cohort"), in_cohort), ((*own, "allowed_precision_tiers"), names(least=1)), ((*own, "minimum_records"), number(1, whole=True)), ((*own, "maximum_p95_km"), number(0, above=True))]
            want += [((*own, "ufs"), names(states, 1))] if self.at(*own, "ufs") is not None else []
        own = ("validation", "official_pilot")
        want += [((*own, "minimum_records"), number(0, whole=True)), ((*own, "expected_ufs"), names(states, 1)), ((*own, "maximum_p95_km"), number(0, above=True)), *(((*own, n), share) for n in FRACTIONS)]
        out = [f"{'.'.join(path)} must be {rule.wants}" for path, rule in want if not rule.fits(self.at(*path))]
        if not out and self.at("validation", "remainder") >= self.at("validation", "modulus"):
            out.append("validation.remainder must be less than the modulus")
        if not out and set(self.at("validation", "cohorts")) != set(COHORTS):
            out.append("validation.cohorts must be exactly the known ones")
        if not out and set(self.at("validation", "per_uf", "thresholds") or ()) != set(self.at("validation", "per_uf", "required_ufs")):
            out.append("validation.per_uf.thresholds must cover the required states exactly")
        if not out and not self.at("validation", "purposes"):
            out.append("validation.purposes must not be empty")
        return out


def load_policy(path: str | Path) -> QualityPolicy:
    raw = Path(path).read_bytes()
    return QualityPolicy(json.loads(raw), hashlib.sha256(raw).hexdigest())
