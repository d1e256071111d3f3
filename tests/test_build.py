"""From files to the artifact, its exports, the quality report and a release."""

import copy
import csv
import hashlib
import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from postalis import __main__ as command
from postalis import sinks
from postalis.config import QualityPolicy, load_policy
from postalis.operators import build, contract, dataset, gates, release, report
from postalis.plans.queries import POLICY
from postalis.sources import containers, lock, records
from test_ranges import POLYGONS, shape_members, shape_zip

PLACES = [("3550308", "Cidade", -23.5505, -46.6333), ("3550308", "Povoado", -23.6, -46.7), ("3304557", "Cidade", -22.9111, -43.2057)]
RECORDS = [
    {"cep": "01001-000", "logradouro": " Praça da Sé ", "complemento": "", "localidade": "São Paulo", "uf": "SP", "ibge": "3550308"}, {"cep": "01001001", "localidade": "São Paulo", "uf": "SP", "ibge": "3550308"},
    {"cep": "20010-000", "localidade": "Rio de Janeiro", "uf": "RJ", "ibge": "3304557"}, {"cep": "53990959", "localidade": "Fernando de Noronha", "uf": "PE", "ibge": "2605459"},
]
OBSERVED = [("01001000", "3550308", -23.55, -46.63, "test-store", "test-store:location/1"), ("01001000", "3550308", -23.5502, -46.63, "test-store", "test-store:location/2"), ("01001000", "3550308", -23.5501, -46.63, "survey:7", "é")]


def brute_digest(*rows):
    return "sha256:" + hashlib.sha256(json.dumps(sorted((i, a.hex(), b.hex()) for i, a, b in rows), separators=(",", ":")).encode()).hexdigest()


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    (folder / "v1").mkdir()
    for r in RECORDS:
        code = r["cep"].replace("-", "")
        (folder / "v1" / f"{code}.json").write_text(json.dumps(r), "utf-8")
    with (folder / "o.csv").open("w", encoding="utf-8", newline="") as f:
        csv.writer(f).writerows([("cep", "ibge", "latitude", "longitude", "source", "evidence_id"), *OBSERVED, OBSERVED[0]])
    rows = records.load_records(containers.directory_entries(spark, str(folder / "v1")))
    first = records.load_observations(spark, str(folder / "o.csv"))
    return rows, first, first.limit(0), spark.createDataFrame(PLACES, "ibge string, category string, latitude double, longitude double")


def test_files_to_rows(spark, inputs):
    got = {r.cep: r for r in build.build_rows(*inputs, "v1").collect()}
    one = got["01001000"]
    assert (one.street, one.complement, one.prefix, one.precision, one.method, one.evidence_count, one.latitude, one.geo_source, one.dataset_version) == ("Praça da Sé", None, "01001", "observed_cep", "robust_median_first_party", 3, -23.5501, ["survey", "test-store"], "v1")
    assert one.evidence_digest == brute_digest(*((i, a, b) for *_, a, b, _, i in OBSERVED))
    two = got["01001001"]  # three observations of one code are no three codes, but three pieces of evidence of a prefix
    assert (two.precision, two.evidence_count, two.evidence_digest) == ("observed_cep_prefix", 3, one.evidence_digest)
    rio = got["20010000"]
    assert (rio.precision, rio.method, rio.evidence_digest) == ("municipality", "ibge_city_reference_with_locality_dispersion", brute_digest(("ibge-localidades", -22.9111, -43.2057)))
    assert got["53990959"].precision is None and got["53990959"].evidence_digest is None
    assert contract.row_problems(build.build_rows(*inputs, "v1"), "v1").count() == 0


def test_broken_inputs_fail(spark, inputs):
    rows, first, osm, places = inputs
    bad = [
        (rows.withColumn("cep", F.lit("invalid")), "unfit records"), (rows.withColumn("ibge", F.lit("12")), "unfit records"), (rows.withColumn("uf", F.lit(" ")), "unfit records"),
        (rows.unionByName(rows), "stand twice"),
    ]
    for broken, message in bad:
        with pytest.raises(gates.GateError, match=message):
            build.build_rows(broken, first, osm, places, "v1")
    with pytest.raises(gates.GateError, match="no municipality"):
        build.build_rows(rows, first, osm, places.limit(0), "v1")


def test_artifact_and_exports(spark, inputs, tmp_path):
    rows = build.build_rows(*inputs, "v1")
    folder = str(tmp_path / "a")
    build.write_artifact(rows, folder, dataset_version="v1")
    stored = build.read_artifact(spark, folder)
    assert [r.cep for r in stored.collect()] == sorted(r.cep for r in rows.collect()) and build.read_metadata(spark, folder) == {"format": build.FORMAT, "dataset_version": "v1"}
    sinks.write_jsonl(stored, f"{folder}/j")
    assert sorted(map(str, sinks.read_jsonl(spark, f"{folder}/j").collect())) == sorted(map(str, stored.select(*sinks.FLAT).collect()))
    stats = build.build_statistics(stored, spark.createDataFrame([("3550308",), ("3304557",)], "ibge string")).first()
    assert (stats.input_records, stats.ibge_joined, stats.ibge_join_rate, stats.located, stats.tier_observed_cep_prefix, stats.tier_unresolved) == (4, 3, 0.75, 3, 1, 1)
    assert tuple(build.verify_artifact(stored, "v2").first()) == (4, 4, 3)
    spark.createDataFrame([("format", "other")], "key string, value string").write.mode("overwrite").parquet(f"{folder}/metadata")
    with pytest.raises(gates.GateError, match="not an artifact"):
        build.read_artifact(spark, folder)
    spark.createDataFrame([("format", build.FORMAT), ("dataset_version", "v2")], "key string, value string").write.mode("overwrite").parquet(f"{folder}/metadata")
    with pytest.raises(gates.GateError, match="another version"):
        build.read_artifact(spark, folder)


def test_broken_rows_are_not_stored(spark, inputs, tmp_path):
    rows = build.build_rows(*inputs, "v1")
    for column, value, rule in (("evidence_digest", F.lit("sha256:0"), "digest"), ("geo_source", F.array(F.lit("b"), F.lit("a")), "sources"), ("longitude", F.lit(None).cast("double"), "geo_whole"), ("latitude", F.lit(float("nan")), "bounds"), ("city", F.repeat(F.lit("é"), 300), "city_bytes")):
        broken = rows.withColumn(column, value)
        assert rule in contract.row_problems(broken).orderBy("cep").first().failed
        with pytest.raises(gates.GateError):
            build.write_artifact(broken, str(tmp_path / rule))


def changed(path, value):
    document = copy.deepcopy(POLICY.document)
    place = document
    for name in path[:-1]:
        place = place[name]
    place[path[-1]] = value
    return document


def test_policy(tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(POLICY.document))
    assert load_policy(tmp_path / "p.json").sha256 == hashlib.sha256((tmp_path / "p.json").read_bytes()).hexdigest()
    bad = [
        (("version",), ""), (("validation", "modulus"), True), (("validation", "remainder"), 5), (("validation", "cohorts", "unseen_cep", "maximum_missing_fraction"), 1.5), (("validation", "per_uf", "required_ufs"), ["AC"]),
        (("validation", "purposes"), {}), (("validation", "official_pilot", "expected_ufs"), ["XX"]), (("build_thresholds", "minimum_coverage"), "1"), (("validation", "per_uf", "thresholds", "AC", "maximum_p95_km"), 0), (("validation", "cohorts", "third"), {}),
    ]
    for path, value in bad:
        with pytest.raises(ValueError, match="unfit quality policy"):
            QualityPolicy(changed(path, value))


@pytest.fixture(scope="module")
def release_inputs(spark, inputs):
    """The build's rows, and a policy and evidence with which its report passes."""
    rows = build.build_rows(*inputs, "v1").cache()
    osm = spark.createDataFrame([(f"openstreetmap:node/{i}", "01001000", None, -23.55 + i / 1e5, -46.63, f"openstreetmap:node/{i}") for i in range(40)], "evidence_id string, cep string, ibge string, latitude double, longitude double, source string")
    box = [(-47, -24), (-46, -24), (-46, -23), (-47, -23)]
    edges = spark.createDataFrame([("3550308", *(v * 10**9 for v in (*a, *b))) for a, b in zip(box, box[1:] + box[:1], strict=True)], "ibge string, x1 long, y1 long, x2 long, y2 long")
    places = spark.createDataFrame([(x, a, b, 1, 0.0, "s") for x, _, a, b in (PLACES[0], PLACES[2])], "ibge string, latitude double, longitude double, evidence_count long, radius_km double, geo_source string")
    official = spark.createDataFrame([("01001000", -23.55, -46.63)], "cep string, latitude double, longitude double")
    document = copy.deepcopy(POLICY.document)
    document["build_thresholds"] |= {"minimum_records": 4, "minimum_coverage": 0.75, "allowed_precision_tiers": ["observed_cep", "observed_cep_prefix", "municipality"]}
    own = document["validation"]
    for c in own["cohorts"].values():
        c |= {"minimum_records": 0, "minimum_ufs": 0, "required_address_classes": []}
    own["per_uf"] = {"cohort": "leave_observation_out", "required_ufs": ["SP"], "thresholds": {"SP": {"minimum_samples": 1, "maximum_p95_km": 1.0}}}
    own["purposes"] = {"near": {"cohort": "leave_observation_out", "allowed_precision_tiers": ["osm_postcode"], "minimum_records": 1, "maximum_p95_km": 1.0}}
    own["official_pilot"] |= {"minimum_records": 1, "expected_ufs": ["SP"], "maximum_p95_km": 1.0}
    return report.Inputs(rows, osm, places, edges, official), QualityPolicy(document, "0" * 64)


def test_report_and_release(spark, release_inputs, tmp_path):
    inputs, policy = release_inputs
    found = report.quality_report(inputs, policy, "v1")
    assert found["status"] == "pass" and not report.report_problems(found, policy), found["failures"]
    assert found["evidence_selection"]["interior"] == 40 and found["evidence_selection"]["retained"] <= 40
    assert [c["name"] for c in found["checks"]] == report.check_names(policy) and report.markdown(found).startswith("# Quality of v1")
    assert "the checks aren't the policy's" in report.report_problems(found | {"checks": found["checks"][:-1]}, policy)
    strict = QualityPolicy(policy.document | {"build_thresholds": policy.document["build_thresholds"] | {"minimum_records": 5}})
    with pytest.raises(gates.GateError, match="minimum_records"):
        report.require_quality(inputs.artifact, strict)
    folder = str(tmp_path / "r")
    with pytest.raises(gates.GateError, match="only a sound report"):
        release.package(inputs.artifact, found | {"status": "fail"}, policy, folder, "IBGE")
    with pytest.raises(gates.GateError, match="doesn't name Atlas, IBGE"):
        release.package(inputs.artifact, found, policy, folder, "nobody", ("Atlas",))
    manifest = release.package(inputs.artifact, found, policy, folder, "Data of IBGE and the Atlas.", ("Atlas",))
    assert release.verify(spark, folder, policy) == json.loads(json.dumps(manifest)) and manifest["records"] == 4
    sums = next((tmp_path / "r" / "sums").glob("part-*"))
    whole = sums.read_text()
    for line in whole.split("\n")[:-1]:
        digest, place = line.split("  ")
        assert hashlib.sha256((tmp_path / "r" / place).read_bytes()).hexdigest() == digest
    (sums.parent / f".{sums.name}.crc").unlink()
    sums.write_text(whole.replace("0", "1"))
    with pytest.raises(gates.GateError, match="their sums"):
        release.verify(spark, folder, policy)
    sums.write_text(whole)
    part = next((tmp_path / "r" / "jsonl").glob("part-*"))
    part.write_text(part.read_text("utf-8").replace("Praça", "Praca"), "utf-8")
    (part.parent / f".{part.name}.crc").unlink()
    with pytest.raises(gates.GateError, match="parts differ"):
        release.verify(spark, folder, policy)
    assert release.export_problems(spark, folder).collect()[0].difference == "unequal"


def test_command_line(spark, inputs, tmp_path, capsys):
    folder = str(tmp_path / "a")
    build.write_artifact(build.build_rows(*inputs, "v1"), folder, dataset_version="v1")
    assert command.main(["lookup", folder, "01001-000"]) == 0
    assert json.loads(capsys.readouterr().out)["geo"]["coordinates"] == [-46.63, -23.5501]
    assert command.main(["lookup", folder, "01001000", "--prefix"]) == 0 and json.loads(capsys.readouterr().out)["members"] == 2
    assert command.main(["lookup", folder, "99999999"]) == 1 and command.main(["lookup", folder, "x"]) == 1
    with pytest.raises(SystemExit) as stop:
        command.main(["nonsense"])
    assert stop.value.code == 2


def test_source_lock(spark, tmp_path):
    data = tmp_path / "in"
    data.mkdir()
    (data / "a.bin").write_bytes(b"abc")
    source = {"id": "a", "filename": "a.bin", "role": "r", "version": "1", "required": True, "bytes": 3, "sha256": hashlib.sha256(b"abc").hexdigest(), "acquisition": "https", "url": "https://example.org/a", "retrieved_at": "x", "attribution": "x", "license_status": "x", "terms_status": "x"}

    def write(*sources, **more):
        (tmp_path / "lock.json").write_text(json.dumps({"format": "f", "release": "1", "publication_gate": "g", "sources": list(sources), **more}))
        return str(tmp_path / "lock.json")

    found = lock.load_lock(spark, write(source), "f")
    lock.verify_sources(spark, str(data), found)
    assert command.main(["sources", str(tmp_path / "lock.json"), "f", str(data)]) == 0
    optional = {**source, "id": "b", "filename": "b.bin", "required": False}
    both = lock.load_lock(spark, write(source, optional), "f")
    assert [s.id for s in lock.selected(both)] == ["a"] and len(lock.selected(both, optional=True)) == 2 and [s.id for s in lock.selected(both, ("b",))] == ["b"]
    assert dict(lock.lock_problems(spark, str(data), both).collect()) == {"b": "missing"}
    with pytest.raises(gates.GateError, match="unknown sources"):
        lock.selected(both, ("c",))
    bad = [{"filename": "../a"}, {"sha256": "A" * 64}, {"bytes": True}, {"url": "http://x"}, {"acquisition": "ftp"}, {"local_path": "x"}, {"required": 1}, {"members": {"a/b": {"bytes": 1, "sha256": "0" * 64}}}, {"attribution": " "}, {"acquisition": "repository", "url": None, "local_path": "../x"}]
    for change in bad:
        with pytest.raises(gates.GateError):
            lock.load_lock(spark, write({**source, **change}), "f")
    for path in (write(source, source), write(), write(source, format="other")):
        with pytest.raises(gates.GateError):
            lock.load_lock(spark, path, "f")
    for change, problem in (({"bytes": 4}, "size"), ({"sha256": "0" * 64}, "digest")):
        assert dict(lock.lock_problems(spark, str(data), lock.load_lock(spark, write({**source, **change}), "f")).collect()) == {"a": problem}
    entries = containers.directory_entries(spark, str(data), ".bin")
    assert lock.folder_digest(entries).first().bytes == 3


def test_dataset_handle(spark, inputs, tmp_path):
    folder = str(tmp_path / "a")
    written = build.write_artifact(build.build_rows(*inputs, "v1"), folder, dataset_version="v1")
    handle = dataset.open_dataset(spark, folder, "v1", written["rows"])
    assert (handle.records, handle.located) == (4, 3)
    assert handle.find("01001-000")["row"]["geo"]["precision"] == "observed_cep" and handle.find("53990959")["status"] == dataset.UNRESOLVED and handle.find("99999999")["status"] == dataset.UNKNOWN and handle.find("x")["status"] == dataset.INVALID
    assert handle.find_prefix("01001000")["estimate"]["members"] == 2 and handle.find_prefix("99999999")["status"] == dataset.UNKNOWN
    for version, rows in (("v2", None), ("v1", "4:0:0")):
        with pytest.raises(gates.GateError):
            dataset.open_dataset(spark, folder, version, rows)
    part = next((tmp_path / "a" / "rows").glob("part-*"))
    part.write_bytes(part.read_bytes() + b"x")
    with pytest.raises(gates.GateError, match="have changed"):
        handle.find("01001000")


def test_build_by_commands(spark, tmp_path, capsys):
    (tmp_path / "v1").mkdir()
    for r in RECORDS[:3]:
        (tmp_path / "v1" / f"{r['cep'].replace('-', '')}.json").write_text(json.dumps(r), "utf-8")
    with (tmp_path / "o.csv").open("w", encoding="utf-8", newline="") as f:
        csv.writer(f).writerows([("cep", "ibge", "latitude", "longitude", "source", "evidence_id"), *OBSERVED])
    nodes = [("20010000", "", -22.9, -43.2, "openstreetmap:node/1"), ("20010000", "", -24.5, -43.2, "openstreetmap:node/2")]  # the second lies elsewhere
    with (tmp_path / "n.csv").open("w", encoding="utf-8", newline="") as f:
        csv.writer(f).writerows([("cep", "ibge", "latitude", "longitude", "source"), *nodes])
    db = sqlite3.connect(tmp_path / "l.gpkg")
    db.execute("create table gpkg_contents (table_name text, data_type text)")
    db.execute("create table l (CD_MUN text, CT_LOCALIDADE text, LAT_LOCALIDADE real, LONG_LOCALIDADE real)")
    db.execute("insert into gpkg_contents values ('l', 'features')")
    db.executemany("insert into l values (?, ?, ?, ?)", PLACES)
    db.commit()
    db.close()
    shape_zip(tmp_path / "b.zip", shape_members(POLYGONS))
    document = copy.deepcopy(POLICY.document)
    document["build_thresholds"] |= {"minimum_records": 3, "minimum_coverage": 1.0, "allowed_precision_tiers": ["observed_cep", "observed_cep_prefix", "osm_postcode"]}
    (tmp_path / "p.json").write_text(json.dumps(document))
    path = lambda name: str(tmp_path / name)
    build_call = ["build", "--records", path("v1"), "--observations", path("o.csv"), "--osm", path("n.csv"), "--localities", path("l.gpkg"), "--boundaries", path("b.zip"), "--policy", path("p.json"), "--version", "7"]
    assert command.main([*build_call, "--output", path("one")]) == 0
    first = json.loads(capsys.readouterr().out)
    assert first["statistics"]["tier_osm_postcode"] == 1 and first["inputs"]["observations"]["files"] == 1 and first["inputs"]["records"]["files"] == 3
    assert command.main(["lookup", path("one"), "20010-000", "--version", "7"]) == 0
    assert json.loads(capsys.readouterr().out)["geo"]["coordinates"] == [-43.2, -22.9]
    assert command.main(["lookup", path("one"), "20010-000", "--version", "8"]) == 1
    source = {"role": "r", "version": "1", "required": True, "acquisition": "https", "url": "https://example.org/a", "retrieved_at": "x", "attribution": "Atlas", "license_status": "x", "terms_status": "x"}
    known = [{**source, "id": n, "filename": n, "bytes": (tmp_path / n).stat().st_size, "sha256": hashlib.sha256((tmp_path / n).read_bytes()).hexdigest()} for n in ("l.gpkg", "b.zip")]
    for name, sources in (("lock.json", known), ("less.json", known[:1])):
        (tmp_path / name).write_text(json.dumps({"format": "f", "release": "7", "publication_gate": "g", "sources": sources}))
    assert command.main([*build_call, "--output", path("four"), "--lock", path("lock.json"), "--lock-format", "f"]) == 0
    made = json.loads(capsys.readouterr().out)
    assert [x["input"] for x in made["settings"]["sources"]] == ["boundaries", "localities"] and made["rows"] == first["rows"] and made["settings"]["source_lock"]["publication_gate"] == "g"
    assert command.main([*build_call, "--output", path("five"), "--lock", path("less.json"), "--lock-format", "f"]) == 1 and "isn't a file of the lock" in capsys.readouterr().err
    policy = load_policy(path("p.json"))
    own = {"dataset_version": "7", "artifact": {"record_count": 3, "located": 3, "unresolved": 0, **{k: v for k, v in first["statistics"].items() if k.startswith("tier_")}}}
    assert not report.binding_problems(report.bound(own, first), first, policy)
    assert report.binding_problems(report.bound(own, made), first, policy) == ["the report is about another build"]
    assert report.binding_problems(report.bound(own, first) | {"dataset_version": "8"}, first, QualityPolicy(policy.document, "1" * 64)) == ["the versions differ", "the build was gated by another policy"]
    assert command.main([*build_call[:-2], "--version", "8", "--policy", path("missing.json"), "--output", path("three")]) == 1
