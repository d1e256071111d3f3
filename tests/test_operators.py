"""Resolver operators on small fixtures with known answers."""

import pytest
from pyspark.sql import functions as F

from postalis import functions as fn
from postalis.config import Thresholds
from postalis.operators import centroid, containment, evaluation, gates, lookup, refresh, tiers

ADDR = "cep string, ibge string, uf string, street string, neighborhood string"
EVIDENCE = "evidence_id string, cep string, ibge string, latitude double, longitude double, source string"
SP = "3550308"


def estimate(spark, first=(), osm=(), codes=("01001000",), **thresholds):
    addr = spark.createDataFrame([(c, SP, "SP", None, None) for c in codes], ADDR)
    local = spark.createDataFrame([(SP, "Cidade", -23.5505, -46.6333)], "ibge string, category string, latitude double, longitude double")
    frame = lambda rows: spark.createDataFrame(list(rows), EVIDENCE)
    found = tiers.resolve(addr, frame(first), frame(osm), tiers.municipality_reference(local), Thresholds(**thresholds))
    return {r.cep: r for r in found.collect()}


def test_exact_code_wins(spark):
    got = estimate(spark, [("a", "01001000", SP, -23.55, -46.63, "store:1")], [("b", "01001000", None, -23.56, -46.63, "openstreetmap:node/1")])
    assert got["01001000"].precision == "observed_cep" and got["01001000"].evidence_count == 1


def test_prefix_of_three_codes(spark):
    first = [(str(i), f"0100100{i}", SP, -23.55 + i / 1000, -46.63, "store:1") for i in (1, 2, 3)]
    got = estimate(spark, first, codes=["01001000"])
    assert got["01001000"].precision == "observed_cep_prefix" and got["01001000"].evidence_count == 3


def test_wide_prefix_and_far_osm_fall_to_municipality(spark):
    wide = [(str(i), f"0100100{i}", SP, lat, lon, "store:1") for i, (lat, lon) in enumerate([(-23.5, -46.6), (-22.9, -43.2), (-15.8, -47.9)], 1)]
    assert estimate(spark, wide)["01001000"].precision == "municipality"
    far = [("n", "01001000", None, -3.1, -60.0, "openstreetmap:node/1")]
    assert estimate(spark, osm=far, max_osm_municipality_distance_km=100.0)["01001000"].precision == "municipality"


def test_outlier_is_left_out_and_spread_pair_fails(spark):
    near = [(str(i), "01001000", SP, -23.55 + i / 10000, -46.63, "store:1") for i in range(3)]
    got = estimate(spark, [*near, ("x", "01001000", SP, -22.0, -46.63, "store:1")])
    assert (got["01001000"].precision, got["01001000"].evidence_count) == ("observed_cep", 3)
    spread = [("a", "01001000", SP, -23.5, -46.6, "s:1"), ("b", "01001000", SP, -23.9, -46.6, "s:1")]
    assert estimate(spark, spread)["01001000"].precision == "municipality"


def test_conflicts_and_gate(spark):
    same = spark.createDataFrame([("a", "1", SP, 1.0, 2.0, "s"), ("a", "1", SP, 1.0, 3.0, "s"), ("b", "1", SP, 1.0, 2.0, "s"), ("b", "1", SP, 1.0, 2.0, "s")], EVIDENCE)
    bad = centroid.evidence_conflicts(same)
    assert [r.evidence_id for r in bad.collect()] == ["a"]
    with pytest.raises(gates.GateError):
        gates.require_empty(bad, "conflicting evidence")


def test_polygon_with_hole_boundary_and_diamond(spark):
    def ring(*points):
        return [("1", *(int(v * 10**9) for v in (*a, *b))) for a, b in zip(points, points[1:] + points[:1], strict=True)]

    edges = ring((-47, -24), (-46, -24), (-46, -23), (-47, -23)) + ring((-46.6, -23.6), (-46.4, -23.6), (-46.4, -23.4), (-46.6, -23.4))
    frame = spark.createDataFrame(edges, "ibge string, x1 long, y1 long, x2 long, y2 long")
    points = [("in", "1", -23.2, -46.5), ("hole", "1", -23.5, -46.5), ("edge", "1", -23.5, -47.0), ("out", "1", -22.0, -46.5)]
    got = containment.classify(spark.createDataFrame(points, "evidence_id string, ibge string, latitude double, longitude double"), frame)
    assert dict(got.collect()) == {"in": "interior", "hole": "outside", "edge": "boundary", "out": "outside"}
    diamond = spark.createDataFrame(ring((0, 1), (1, 2), (2, 1), (1, 0)), "ibge string, x1 long, y1 long, x2 long, y2 long")
    two = spark.createDataFrame([("a", "1", 1.0, 1.0), ("b", "1", 1.0, 3.0)], "evidence_id string, ibge string, latitude double, longitude double")
    assert dict(containment.classify(two, diamond).collect()) == {"a": "interior", "b": "outside"}


def test_functions(spark):
    row = spark.sql("select '01001-000' a, '0100' b, concat(chr(160), ' x ') c, 'store : 1' d").select(fn.postal_code(F.col("a")), fn.postal_code(F.col("b")), fn.clean_text(F.col("c")), fn.source_category(F.col("d"))).first()
    assert tuple(row) == ("01001000", None, "x", "store")
    with pytest.raises(ValueError):
        Thresholds(min_prefix_samples=1)


STORED = "cep string, prefix string, ibge string, precision string, latitude double, longitude double, geo_source array<string>, evidence_digest string, dataset_version string"


def test_prefix_estimates_and_limits(spark):
    digest = lambda n: "sha256:" + str(n) * 64
    rows = [
        ("01001000", "01001", SP, "observed_cep", -23.5505, -46.6333, ["fixture"], digest(0), "v"), ("01001001", "01001", SP, "observed_cep", -23.551, -46.634, ["fixture"], digest(1), "v"),
        ("01001002", "01001", SP, "osm_postcode", -23.5495, -46.632, ["openstreetmap"], digest(2), "v"), ("01001003", "01001", SP, "municipality", -23.7, -46.8, ["ibge"], digest(3), "v"),
        ("01001004", "01001", "3304557", "observed_cep", -22.9068, -43.1729, ["fixture"], digest(4), "v"), ("01001005", "01001", SP, "observed_cep", -23.55, -46.63, ["fixture"], digest(5), "other"), ("99999999", "99999", "9999999", None, None, None, None, None, "v"),
    ]
    got = {r.cep: r for r in lookup.prefix_estimates(spark.createDataFrame(rows, STORED)).collect()}
    own = got["01001003"]
    assert (own.latitude, own.longitude, own.candidates, own.members, own.sources) == (-23.5505, -46.6333, 3, 4, ["fixture", "openstreetmap"])
    assert own.evidence_digest == "sha256:6c3c2e7d13365da1f1ca23e0a184a33c7ed0ac1065d5165c2b1a926722a73c71"  # fixed value of the public format
    assert got["01001000"].latitude is None and got["01001000"].candidates == 2 and got["01001004"].members == got["99999999"].members == got["01001005"].members == 1
    assert lookup.prefix_members(spark.createDataFrame(rows, STORED), "01001003").count() == 4
    far = [(*r[:4], -22.0, -44.0, *r[6:]) if r[0] == "01001002" else r for r in rows]
    assert all(r.latitude is None for r in lookup.prefix_estimates(spark.createDataFrame(far, STORED)).collect())


def test_prefix_groups_beyond_the_limit_are_errors(spark):
    rows = spark.range(1500).selectExpr("lpad(cast(id as string), 8, '0') cep", "'00000' prefix", "'1' ibge", "'observed_cep' precision", "1.0D latitude", "1.0D longitude", "array('a') geo_source", "'d' evidence_digest", "'v' dataset_version")
    for f in (lookup.prefix_estimates, lambda x: lookup.prefix_members(x, "00000001")):
        with pytest.raises(gates.GateError):
            f(rows)
    assert lookup.prefix_estimates(rows.limit(1000)).filter("members = 1000 and candidates = 999 and latitude = 1").count() == 1000


def test_compare_and_order(spark):
    a, b = spark.createDataFrame([("1", "x"), ("2", None)], "cep string, v string"), spark.createDataFrame([("2", None), ("3", "y")], "cep string, v string")
    assert set(map(tuple, refresh.compare(a, b).collect())) == {("1", "missing"), ("3", "extra")}
    bad = refresh.order_violations(spark.createDataFrame([(0, "a"), (1, "b"), (100_000, "b"), (100_001, "c")], "p long, cep string"), "p")
    assert [tuple(r) for r in bad.collect()] == [(100_000, "b")]
    gap = refresh.order_violations(spark.createDataFrame([(0, "z"), (250_000, "a"), (900_000, "b")], "p long, cep string"), "p")
    assert [tuple(r) for r in gap.collect()] == [(250_000, "a")]


def test_nearest_rank_percentiles(spark):
    samples = spark.createDataFrame([("SP", "u", "osm_postcode", float(i)) for i in range(1, 11)], "uf string, address_class string, precision string, error_km double")
    got = {r.metric: r for r in evaluation.group_metrics(samples).collect()}
    assert (got["overall"].p50_km, got["overall"].p90_km, got["overall"].p95_km) == (5.0, 9.0, 10.0)
    assert got["precision:municipality"].n == 0


def test_repeated_and_conflicting_evidence(spark):
    three = [("a", "01001000", SP, -23.55, -46.63, "store:1"), ("b", "01001000", SP, -23.5501, -46.63, "store:1"), ("c", "01001000", SP, -23.5502, -46.63, "store:1")]
    got = estimate(spark, [*three, three[0], three[0]])["01001000"]
    assert (got.evidence_count, got.latitude) == (3, -23.5501)
    addr = spark.createDataFrame([("01001000", SP, "SP", None, None)], ADDR)
    frame = lambda *rows: spark.createDataFrame(list(rows), EVIDENCE)
    sound, none = frame(*three, three[0]), frame()
    tiers.require_sound(addr, sound, none)
    bad = [
        (addr, frame(*three, ("a", "01001000", SP, -23.0, -46.63, "store:1")), none, "several places"), (addr, frame(("a", "01001000", "3304557", -23.55, -46.63, "s:1")), none, "another municipality"),
        (addr, frame(("a", "01001000", SP, -23.55, -46.63, "-x:1")), none, "categories"), (addr.unionByName(addr), sound, none, "stand twice"),
        (addr, frame(*((str(i), "01001000", SP, -23.55, -46.63, f"s{i}:1") for i in range(17))), none, "categories"), (addr, none, frame((None, "01001000", None, 1.0, 2.0, "o:1"), (None, "01001000", None, 1.5, 2.0, "o:1")), "several places"),
    ]
    for addresses, first, osm, message in bad:
        with pytest.raises(gates.GateError, match=message):
            tiers.require_sound(addresses, first, osm)


def test_production_exclusions_and_outcomes(spark):
    """Three near nodes and one far, a wide pair, a node of an unknown code, and one of a municipality without a city."""
    addr = spark.createDataFrame([("01001000", SP, "SP", "x", None), ("01001001", SP, "SP", "", ""), ("01001002", "3304557", "RJ", None, None)], ADDR)
    local = spark.createDataFrame([(SP, "Cidade", -23.5505, -46.6333)], "ibge string, category string, latitude double, longitude double")
    muni = tiers.municipality_reference(local)
    nodes = [("1", "01001000", -23.55, -46.63), ("2", "01001000", -23.5501, -46.63), ("3", "01001000", -23.5502, -46.63), ("4", "01001000", -23.7, -46.63), ("5", "01001001", -23.5, -46.6), ("6", "01001001", -23.9, -46.6), ("7", "99999999", -23.5, -46.6), ("8", "01001002", -22.9, -43.2)]
    osm = spark.createDataFrame([(i, c, None, lat, lon, f"openstreetmap:node/{i}") for i, c, lat, lon in nodes], EVIDENCE)
    judged = evaluation.production_eligible(osm, addr, muni)
    assert {r.evidence_id: r.exclusion_reason for r in judged.collect()} == {"1": None, "2": None, "3": None, "4": "robust_spatial_outlier", "5": "cep_group_radius_rejection", "6": "cep_group_radius_rejection", "7": None, "8": "outside_reference_distance_backstop"}
    assert dict(evaluation.exclusion_counts(judged).collect()) == {"robust_spatial_outlier": 1, "cep_group_radius_rejection": 2, "outside_reference_distance_backstop": 1, "retained": 4}
    assert dict(evaluation.exclusion_counts(judged.limit(0)).collect()) == {"robust_spatial_outlier": 0, "cep_group_radius_rejection": 0, "outside_reference_distance_backstop": 0, "retained": 0}
    parted = osm.withColumn("held_out", F.col("evidence_id").isin("3", "5", "7", "8"))
    got = {r.evidence_id: (r.outcome, r.precision, r.address_class) for r in evaluation.outcomes(parted, addr, muni).collect()}
    urban, rural = "urban_address_proxy", "rural_or_general_address_proxy"
    assert got == {"3": ("evaluated", "osm_postcode", urban), "5": ("evaluated", "osm_postcode", rural), "7": ("missing_cep", None, None), "8": ("prediction_failure", None, rural)}
    row = evaluation.cohort(evaluation.outcomes(parted, addr, muni)).first()
    assert (row.heldout_observations, row.evaluated, row.missing, row.failures, row.missing_fraction, row.ufs, len(row.missing_ufs.split(","))) == (4, 2, 1, 1, 0.25, "SP", 26)
    assert evaluation.cohort(evaluation.outcomes(parted, addr, muni).limit(0)).first().missing_fraction == 0.0


def test_refresh_fills_gaps_once_and_keeps_what_is_there(spark):
    rows = spark.createDataFrame([("1", SP, -23.5, -46.6, "osm_postcode", "m", 2, 0.1, ["openstreetmap"], "d"), ("2", SP, *[None] * 8), ("3", "2605459", *[None] * 8)], "cep string, ibge string, latitude double, longitude double, precision string, method string, evidence_count long, evidence_radius_km double, geo_source array<string>, evidence_digest string")
    kind = "ibge string, latitude double, longitude double, evidence_count long, radius_km double, geo_source string, evidence_digest string"
    muni = spark.createDataFrame([(SP, -23.55, -46.63, 3, 5.0, "ibge-localidades", "x")], kind)
    administrative = spark.createDataFrame([("2605459", -3.85, -32.42, 1, 0.0, "ibge-localidades-administrative", "y")], kind)
    got = {r.cep: r for r in refresh.fill_null_geo(rows, muni, administrative).collect()}
    assert [got[c].origin for c in "123"] == ["geo_inherited", "geo_filled_municipality", "geo_filled_administrative"]
    assert (got["1"].latitude, got["1"].method) == (-23.5, "m") and (got["2"].precision, got["2"].method, got["2"].geo_source) == ("municipality", "ibge_municipality_reference", ["ibge-localidades"]) and got["3"].evidence_digest == "y"
    assert [r.ibge for r in refresh.unreferenced(rows, muni).collect()] == ["2605459"]
    with pytest.raises(gates.GateError, match="no reference"):
        refresh.refreshed(rows, muni, administrative.limit(0))
    row = refresh.candidate_counts(rows).first()
    assert (row.candidate_rows, row.located_rows, row.unresolved_rows, row.osm_postcode, row.other_precisions) == (3, 1, 2, 1, 0)


def test_diff_rules(spark):
    sound = dict(candidate_included=True, cep="01001000", changed_fields=["uf"], classification="added", current_ibge=SP, geography_action="unresolved", previous_cep=None, previous_ibge=None, valid_until="2026")
    frame = lambda *rows: spark.createDataFrame([tuple(r[k.split()[0]] for k in refresh.DIFF.split(", ")) for r in rows], refresh.DIFF)
    refresh.require_diff(frame(sound))
    changes = [({"candidate_included": False}, "included"), ({"cep": "x"}, "cep"), ({"changed_fields": ["a", "a"]}, "changed_fields"), ({"changed_fields": [""]}, "changed_fields"), ({"classification": "renamed"}, "classification"), ({"geography_action": "preserved"}, "pair"), ({"geography_action": "fill"}, "action"), ({"current_ibge": "1"}, "current_ibge"), ({"previous_cep": "1"}, "previous_cep")]
    for change, rule in changes:
        assert rule in refresh.diff_problems(frame(sound | change)).first().failed
    for rows, message in (((), "no row"), ((sound, sound), "stand twice")):
        with pytest.raises(gates.GateError, match=message):
            refresh.require_diff(frame(*rows))


def test_administrative_references_need_places_in_bounds(spark):
    local = spark.createDataFrame([("2605459", "Distrito Estadual de Fernando de Noronha", -3.85, -32.42), ("2605459", "Povoado", 10.0, 10.0)], "ibge string, category string, latitude double, longitude double")
    codes = spark.createDataFrame([("2605459",)], "ibge string")
    with pytest.raises(gates.GateError, match="out of bounds"):
        tiers.administrative_reference(local, codes)
    assert tiers.administrative_reference(local.filter("latitude < 5"), codes).first().evidence_count == 1
    with pytest.raises(gates.GateError):
        tiers.require_references(tiers.municipality_reference(local))
