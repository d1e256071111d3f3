"""Builds from normalized rows: count identities, inheritance, filled gaps, manifests; exact rounding; identities of nodes."""

import copy
import random

import pytest
from pyspark.sql import functions as F

from postalis.config import QualityPolicy
from postalis.functions import round_exact
from postalis.operators import build, candidate, chain, containment, gates, identities, manifest, refresh
from postalis.plans.queries import POLICY
from postalis.sinks import FLAT

SCHEMA = ", ".join(f"{c} string" for c in FLAT[:11]) + ", latitude double, longitude double, precision string, method string, evidence_count long, evidence_radius_km double, geo_source array<string>, evidence_digest string, dataset_version string"
PLACES = [("3550308", "Cidade", -23.5505, -46.6333), ("3550308", "Povoado", -23.6, -46.7), ("2605459", "Distrito Estadual de Fernando de Noronha", -3.84, -32.41), ("3304557", "Cidade", -22.9111, -43.2057)]
GEO = (-23.55, -46.63, "osm_postcode", "earlier", 2, 0.1, ["openstreetmap"], "sha256:" + "0" * 64)


def row(cep, ibge="3550308", geo=GEO, street="Rua", uf="SP", version="2"):
    return (cep, cep[:5], street, None, None, None, "X", uf, None, None, ibge, *(geo or [None] * 8), version)


ROWS = [row("01001000"), row("01001001", geo=None), row("20010000", "3304557", None, uf="RJ"), row("53990000", "2605459", None, uf="PE"), row("53990001", "2605459", GEO, uf="PE")]
CLASSES = ["unchanged", "added", "ibge_changed", "missing_from_source", "address_changed"]
ACTIONS = ["preserved", "assigned_municipality", "reassigned_municipality", "retained_missing", "preserved"]


def counts():
    found = dict.fromkeys(identities.NAMES, 0)
    found |= {"candidate.rows": 5, "candidate.located": 2, "candidate.unresolved": 3, "current.rows": 4, "precision.osm_postcode": 2}
    found |= {f"classification.{c}": 1 for c in CLASSES} | {f"action.{a}": 1 for a in ACTIONS} | {"action.preserved": 2}
    found |= {"snapshot.records": 4, "snapshot.raw_records": 6, "snapshot.duplicate_records": 2, "snapshot.duplicate_groups": 1, "snapshot.source_total": 6, "snapshot.page_count": 3, "snapshot.page_size": 2}
    return found | {"type.1": 4, "raw_type.1": 5, "raw_type.2": 1, "validity.active": 4, "raw_validity.active": 6, "resolution.direct": 3, "resolution.unresolved": 1}


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    diff = spark.createDataFrame([(True, r[0], ["street"] if c == "address_changed" else [], c, r[10], a, None, None, None) for r, c, a in zip(ROWS, CLASSES, ACTIONS, strict=True)], refresh.DIFF)
    return rows.cache(), diff.cache(), spark.createDataFrame(PLACES, "ibge string, category string, latitude double, longitude double").cache()


def test_counts_add_up(spark, tables):
    rows, diff, _ = tables
    identities.require_counts(counts(), rows, diff)
    cases = [
        ({"classification.unchanged": 2}, "add up"), ({"snapshot.duplicate_records": 1}, "add up"), ({"snapshot.source_total": 7}, "add up"), ({"type.6": 1}, "add up"), ({"raw_validity.expired": 1}, "add up"), ({"resolution.direct": 4}, "add up"),
        ({"snapshot.duplicate_groups": 3}, "bounds"), ({"snapshot.page_count": 4}, "pages"), ({"snapshot.page_size": 0}, "pages"), ({"candidate.rows": True}, "no number"), ({"type.7": 0}, "unknown"), ({"current.rows": -1}, "no number"),
        ({"precision.osm_postcode": 1, "precision.municipality": 1}, "contradict"), ({"classification.unchanged": 0, "classification.source_link_conflict": 1}, "contradict"), ({"action.preserved": 1, "action.unresolved": 1}, "contradict"),
    ]
    for change, match in cases[:1] + cases[6:7] + cases[-1:]:
        with pytest.raises(gates.GateError, match=match):
            identities.require_counts(counts() | change, rows, diff)
    for change, match in cases:
        if match == "add up":  # the identities alone, without Spark
            found = counts() | change
            assert any(sum(c * found[n] for n, c in terms.items()) for terms in identities.IDENTITIES.values())
        elif match in ("no number", "unknown"):
            with pytest.raises(gates.GateError, match=match):
                identities.table(spark, counts() | change)
    assert not any(sum(c * counts()[n] for n, c in terms.items()) for terms in identities.IDENTITIES.values())


def test_chain_of_releases(spark, tables):
    rows, diff, _ = tables
    base = rows.filter("cep <> '01001001'").withColumn("dataset_version", F.lit("1"))
    recorded = manifest.rows_digest(base)
    assert recorded == manifest.rows_digest(base.repartition(3).orderBy(F.desc("cep")))
    chain.require_inherited(base, rows, diff, recorded)
    street, moved = (lambda cep: F.when(F.col("cep") == cep, "other").otherwise(F.col("street"))), (lambda cep: F.when(F.col("cep") == cep, F.col("latitude") + 1).otherwise(F.col("latitude")))
    cases = [
        (rows.withColumn("street", street("01001000")), {"01001000": "changed"}), (rows.withColumn("street", street("53990001")), {}), (rows.withColumn("latitude", moved("53990001")), {"53990001": "moved"}),
        (rows.filter("cep <> '53990000'"), {"53990000": "missing"}), (rows.unionByName(spark.createDataFrame([row("99999999")], SCHEMA)), {"99999999": "not added"}), (rows.withColumn("dataset_version", F.lit("9")), {}),
    ]
    for new, want in cases:
        assert dict(chain.inherited_problems(base, new, diff).collect()) == want
    columns = [c for c in FLAT if c != "dataset_version"]
    assert chain.differing(chain.range_digests(base, columns), chain.range_digests(cases[0][0], columns)) == ["010"]
    with pytest.raises(gates.GateError, match="its manifest records"):
        chain.require_inherited(base.withColumn("street", street("01001000")), rows, diff, recorded)


def test_problems_in_every_range(spark, tables):
    diff = tables[1].filter("false")
    for step in (1, 2):
        codes = [f"{n:03d}00000" for n in range(0, 1000, step)]
        base = spark.createDataFrame([row(c[:3] + end) for c in codes for end in ("00000", "99999")], SCHEMA)
        new = base.withColumn("street", F.when(F.col("cep").endswith("00000"), "another").otherwise(F.col("street")))
        new = new.unionByName(spark.createDataFrame([row("998A0000")], SCHEMA))  # behind all digits
        assert dict(chain.inherited_problems(base, new, diff).collect()) == dict.fromkeys(codes, "changed") | {"998A0000": "not added"}
        assert sorted(r.cep for r in chain.within(base, ["000", "998"]).collect()) == ["00000000", "00099999", "99800000", "99899999"]
        assert chain.within(base, []).isEmpty()


def policy(**more):
    document = copy.deepcopy(POLICY.document)
    document["build_thresholds"] |= {"minimum_records": 1, "minimum_coverage": 0.5, "allowed_precision_tiers": ["osm_postcode", "municipality"], **more}
    return QualityPolicy(document, "0" * 64)


def test_candidate_builds(spark, tables, tmp_path):
    rows, diff, places = tables
    filled = candidate.candidate_rows(rows, diff, places, counts())
    got = {r.cep: r for r in filled.collect()}
    assert [got[c]._origin for c in sorted(got)] == ["geo_inherited", "geo_filled_municipality", "geo_filled_municipality", "geo_filled_administrative", "geo_inherited"]
    assert got["53990000"].geo_source == ["ibge-localidades-administrative"] and got["53990000"].evidence_digest.startswith("sha256:") and got["01001001"].evidence_count == 2
    first = candidate.write_candidate(filled, places, str(tmp_path / "a"), "2", policy(), {"rows": "x"}, {"k": 1})
    again = candidate.write_candidate(candidate.candidate_rows(rows.repartition(3), diff, places), places, str(tmp_path / "b"), "2", policy(), {"rows": "x"}, {"k": 1})
    assert first == again and first["statistics"] == {
        "records": 5, "located": 5, "unresolved": 0, "tier_observed_cep": 0, "tier_osm_postcode": 2, "tier_observed_cep_prefix": 0, "tier_municipality": 3, "tier_unresolved": 0, "ibge_joined": 5, "ibge_join_rate": 1.0,
        "geo_inherited": 2, "geo_filled_municipality": 2, "geo_filled_administrative": 1,
    }
    assert candidate.verify_stored(spark, str(tmp_path / "a")) == first and build.read_artifact(spark, str(tmp_path / "a")).count() == 5
    spark.read.parquet(str(tmp_path / "b" / "rows")).withColumn("street", F.lit("x")).write.parquet(str(tmp_path / "c" / "rows"))
    (tmp_path / "b" / "manifest").rename(tmp_path / "c" / "manifest")
    with pytest.raises(gates.GateError, match="aren't those"):
        candidate.verify_stored(spark, str(tmp_path / "c"))
    with pytest.raises(gates.GateError, match="minimum_records"):
        candidate.write_candidate(filled, places, str(tmp_path / "d"), "2", policy(minimum_records=6), {}, {})
    assert not (tmp_path / "d" / "manifest").exists()
    with pytest.raises(gates.GateError, match="another version"):
        candidate.write_candidate(filled, places, str(tmp_path / "e"), "3", policy(), {}, {})


def test_candidates_that_break_a_rule_fail(spark, tables):
    rows, diff, places = tables
    cases = [
        (rows, diff.filter("cep <> '01001000'"), places, "diff lacks"), (rows.filter("cep <> '01001000'"), diff, places, "candidate lacks"), (rows, diff.unionByName(diff), places, "twice"),
        (rows.withColumn("precision", F.when(F.col("precision").isNotNull(), "observed_cep")), diff, places, "precisions"), (rows, diff, places.filter("ibge <> '2605459'"), "no reference fills"),
    ]
    for new, said, where, match in cases:
        with pytest.raises(gates.GateError, match=match):
            candidate.candidate_rows(new, said, where)


def test_rounding_is_exact(spark):
    rng = random.Random(7)
    values = [i / 10_000 for i in range(0, 20_000)] + [1.0005, 0.0625, 2.675, 0.5, 1.5, 1e-9, 0.0, 123456.0005, 1e12 + 0.0005] + [rng.uniform(-1e6, 1e6) for _ in range(5000)] + [-k / 2000 for k in range(3000)]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", *(round_exact(F.col("v"), d).alias(f"d{d}") for d in (0, 2, 3, 8))).collect()
    assert len(got) == len(values)
    for r in got:
        assert [r.d0, r.d2, r.d3, r.d8] == [float(round(values[r.i])), *(round(values[r.i], d) for d in (2, 3, 8))], values[r.i]


def test_a_repeated_node_keeps_its_place(spark):
    box = [(-47, -24), (-46, -24), (-46, -23), (-47, -23)]
    edges = spark.createDataFrame([("3550308", *(v * 10**9 for v in (*a, *b))) for a, b in zip(box, box[1:] + box[:1], strict=True)], "ibge string, x1 long, y1 long, x2 long, y2 long")
    node = ("n", "3550308", "01001000", -23.5, -46.5)
    points = spark.createDataFrame([node, node], "evidence_id string, ibge string, cep string, latitude double, longitude double")
    assert [tuple(r) for r in containment.classify(points, edges).collect()] == [("n", "interior")]
    addresses = spark.createDataFrame([("01001000", "3550308")], "cep string, ibge string")
    with pytest.raises(gates.GateError, match="repeated or missing identities"):
        containment.select(points, addresses, edges)
    far = spark.createDataFrame([node, ("m", "3550308", "01001000", -22.5, -46.5), ("u", None, "99999999", 0.0, 0.0)], points.schema)
    assert {r.evidence_id for r in build.polygon_eligible(far, addresses, edges).collect()} == {"n", "u"}
    with pytest.raises(gates.GateError, match="without a polygon"):
        build.polygon_eligible(far, spark.createDataFrame([("01001000", "3304557")], "cep string, ibge string"), edges)
