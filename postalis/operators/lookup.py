"""Point and prefix lookups over the artifact, one at a time or in bulk."""

from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.functions import EARTH_KM
from postalis.operators.gates import GateError, require_empty

# Limits of a prefix group and of its estimate.
MOST_MEMBERS, LEAST_CANDIDATES, MOST_RADIUS_KM, MOST_SOURCES, MOST_SOURCE_BYTES = 1000, 3, 10.0, 16, 64
EXACT = ("observed_cep", "osm_postcode")
GROUP = ["prefix", "ibge", "dataset_version"]


def point(artifact: DataFrame, code: str) -> DataFrame:
    """The row of a code; on a table sorted by code, file statistics prune the scan."""
    return artifact.filter(F.col("cep") == code)


def prefix_members(artifact: DataFrame, code: str) -> DataFrame:
    """(cep, precision) of all codes with the same prefix, municipality and version; more than MOST_MEMBERS is an error. The
    prefix is a literal, so on a table sorted by code file statistics prune the scan."""
    group = [c for c in GROUP if c in artifact.columns]
    artifact = artifact.filter(F.col("prefix") == code[:5])
    own = artifact.filter(F.col("cep") == code).select(*group).limit(1)
    members = artifact.join(F.broadcast(own), group, "left_semi").select("cep", "precision")  # one row
    if members.limit(MOST_MEMBERS + 1).count() > MOST_MEMBERS:
        raise GateError(f"more than {MOST_MEMBERS} codes share the prefix of {code}")
    return members


FOUND = "cep string, prefix string, ibge string, dataset_version string, members long, candidates long, latitude double, longitude double, radius_km double, sources array<string>, evidence_digest string"


def without_each(values: np.ndarray) -> np.ndarray:
    """Median of the values without each of them in turn, nan for none."""
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    own, n = values[order], len(values) - 1
    if n < 1:
        return np.full(len(values), np.nan)
    at = lambda k: own[k + (rank <= k)]  # noqa: E731  place k of what is left
    return (at((n - 1) // 2) + at(n // 2)) / 2


def group_estimates(rows: pd.DataFrame) -> pd.DataFrame:
    """prefix_estimates of one group of at most MOST_MEMBERS codes."""
    rows = rows.sort_values("cep", kind="stable").reset_index(drop=True)
    usable = (rows["precision"].isin(EXACT) & rows["latitude"].notna() & rows["longitude"].notna()).to_numpy()
    near = rows[usable]
    lat, lon = near["latitude"].to_numpy(float), near["longitude"].to_numpy(float)
    named = Counter(s for sources in near["geo_source"] for s in set(sources))
    lines = [json.dumps([c, p, float(a).hex(), float(b).hex(), d], separators=(",", ":")) for c, p, a, b, d in zip(near["cep"], near["precision"], lat, lon, near["evidence_digest"], strict=True)]
    middles = {True: (without_each(lat), without_each(lon)), False: (np.median(lat) if len(lat) else np.nan, np.median(lon) if len(lon) else np.nan)}
    out, k = [], 0
    for i, own in enumerate(usable.tolist()):
        n = len(near) - own
        a, b = (x[k] for x in middles[True]) if own else middles[False]
        found = (None, None, None, None, None)
        if n >= LEAST_CANDIDATES:
            h = np.sin((np.radians(lat) - np.radians(a)) / 2) ** 2 + np.cos(np.radians(a)) * np.cos(np.radians(lat)) * np.sin(np.radians(lon - b) / 2) ** 2
            far = 2 * EARTH_KM * np.arcsin(np.sqrt(h))
            far = float(np.delete(far, k).max() if own else far.max())
            sources = sorted(s for s, m in named.items() if m > (own and s in set(near["geo_source"].iloc[k])))
            if far <= MOST_RADIUS_KM and 1 <= len(sources) <= MOST_SOURCES and all(1 <= len(s.encode()) <= MOST_SOURCE_BYTES for s in sources):
                text = "[" + ",".join(lines[:k] + lines[k + 1 :] if own else lines) + "]"
                found = (float(a), float(b), round(far, 3), sources, "sha256:" + hashlib.sha256(text.encode()).hexdigest())
        out.append((len(rows), n, *found))
        k += own
    columns = ["members", "candidates", "latitude", "longitude", "radius_km", "sources", "evidence_digest"]
    return pd.concat([rows[["cep", *GROUP]], pd.DataFrame(out, columns=columns)], axis=1)


def prefix_estimates(artifact: DataFrame) -> DataFrame:
    """(cep, prefix, ibge, dataset_version, members, candidates, latitude, longitude, radius_km, sources, evidence_digest)
    for every code, from the others of its prefix, municipality and version that rest on evidence of their own (artifact
    rows with geo_source as an array). The estimate is null unless enough of them lie close enough together (the radius
    isn't rounded for that) and name one to sixteen sources. A group of more than MOST_MEMBERS codes is an error, found
    first, so a group in a task is bounded."""
    sizes = artifact.groupBy(*GROUP).agg(F.count("*").alias("members"))
    require_empty(sizes.filter(F.col("members") > MOST_MEMBERS), f"groups of more than {MOST_MEMBERS} codes")
    rows = artifact.select("cep", *GROUP, "precision", "latitude", "longitude", "geo_source", "evidence_digest")
    return rows.groupBy(*GROUP).applyInPandas(group_estimates, FOUND)
