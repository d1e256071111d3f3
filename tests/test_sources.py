"""Readers and exports on small hand-built files."""

import hashlib
import json
import sqlite3
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from postalis import sinks
from postalis.functions import float_hex
from postalis.operators import centroid, gates, refresh
from postalis.sources import archives, containers, pbf, records

RECORD = {"cep": "01001-000", "logradouro": "Praça da Sé", "localidade": "São Paulo", "uf": "SP", "ibge": "3550308"}


def zipped(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), data)
    return str(path)


def test_records_of_zip_and_folder_agree(spark, tmp_path):
    one, two = json.dumps(RECORD), "﻿" + json.dumps({**RECORD, "cep": "20010-000"})
    path = zipped(tmp_path / "a.zip", v1__01001000_dot_json=one, v1__20010000_dot_JSON=two, notes_dot_txt="x")
    folder = tmp_path / "d" / "v1"
    folder.mkdir(parents=True)
    (folder / "01001000.json").write_text(one, "utf-8")
    (folder / "20010000.json").write_text(two, "utf-8")
    a = {r.member.lower(): (r.sha256, r.cep) for r in records.load_records(archives.zip_entries(spark, path)).collect()}
    b = {r.member.lower(): (r.sha256, r.cep) for r in records.load_records(containers.directory_entries(spark, str(tmp_path / "d"))).collect()}
    assert a == b and a["v1/01001000.json"] == (hashlib.sha256(one.encode()).hexdigest(), "01001-000") and len(a) == 2


def test_corrections(spark, tmp_path):
    text = json.dumps({**RECORD, "cep": "70864-040"})
    path = zipped(tmp_path / "a.zip", v1__69310188_dot_json=text)
    fix = {"member": "v1/69310188.json", "source_sha256": hashlib.sha256(text.encode()).hexdigest(), "field": "cep", "from": "70864-040", "to": "69310-188", "reason": "name"}
    (tmp_path / "c.json").write_text(json.dumps({"format": "x", "corrections": [fix]}))
    entries = archives.zip_entries(spark, path)
    with pytest.raises(gates.GateError):
        records.load_records(entries)
    assert records.load_records(entries, records.load_corrections(spark, str(tmp_path / "c.json"))).first().cep == "69310-188"
    (tmp_path / "s.json").write_text(json.dumps({"corrections": [{**fix, "source_sha256": "0" * 64}, {**fix, "member": "other"}]}))
    stale = records.correction_violations(records.records(entries), records.load_corrections(spark, str(tmp_path / "s.json")))
    assert dict(stale.collect()) == {"v1/69310188.json": "stale", "other": "unused"}


def test_unsafe_archives_and_bad_json_fail(spark, tmp_path):
    for i, members in enumerate([{"..__x_dot_json": "{}"}, {"x_dot_json": "[1]"}, {"x_dot_json": "{"}]):
        with pytest.raises(Exception, match="unsafe|not a JSON object|MALFORMED|alformed"):
            records.records(archives.zip_entries(spark, zipped(tmp_path / f"{i}.zip", **members))).collect()


def test_observations(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("﻿cep,ibge,latitude,longitude,source\n01001000,3550308,-23.55,-46.63,shop\n01001000,3550308,-23.55,-46.63,shop\n01001-001,,-23.5,-46.6,openstreetmap:node/1\n", "utf-8")
    got = {r.source: r for r in records.load_observations(spark, str(path)).collect()}
    payload = "|".join(("shop", "01001000", "3550308", (-23.55).hex(), (-46.63).hex()))
    assert got["shop"].evidence_id == "sha256:" + hashlib.sha256(payload.encode()).hexdigest()
    assert got["openstreetmap:node/1"].evidence_id == "openstreetmap:node/1" and len(got) == 2
    path.write_text("cep,latitude,longitude,source,evidence_id\n01001000,-23.55,-46.63,s,a\n01001000,-23.56,-46.63,s,a\n")
    with pytest.raises(gates.GateError, match="several places"):
        records.load_observations(spark, str(path))
    path.write_text("cep,latitude,longitude,source\n01001000,nan,-46.63,s\n")
    with pytest.raises(gates.GateError, match="invalid place"):
        records.load_observations(spark, str(path))


def test_geopackage(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "l.gpkg")
    db.execute("create table gpkg_contents (table_name text, data_type text)")
    db.execute("create table localities (CD_MUN text, CT_LOCALIDADE text, LAT_LOCALIDADE real, LONG_LOCALIDADE real)")
    db.execute("insert into gpkg_contents values ('localities', 'features')")
    db.executemany("insert into localities values (?, ?, ?, ?)", [("3550308", "Cidade", -23.5505, -46.6333), ("3550308", "Povoado", -23.6, -46.7), ("3304557", "Cidade", None, 1.0)])
    db.commit()
    db.close()
    rows = {tuple(r) for r in containers.geopackage_localities(spark, str(tmp_path / "l.gpkg")).collect()}
    assert rows == {("3550308", "Cidade", -23.5505, -46.6333), ("3550308", "Povoado", -23.6, -46.7)}
    packed = zipped(tmp_path / "l.zip", l_dot_gpkg=(tmp_path / "l.gpkg").read_bytes())
    assert containers.geopackage_localities(spark, packed).count() == 2


def number(value):
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def field(n, value):
    return number(n << 3) + number(value) if isinstance(value, int) else number(n << 3 | 2) + number(len(value)) + value


def deltas(*values):
    return b"".join(number((d << 1) ^ (d >> 63)) for d in (b - a for a, b in zip((0, *values), values)))


def pbf_file(path, raw, declared=None, blobs=2):
    blob = field(2, len(raw) if declared is None else declared) + field(3, zlib.compress(raw))
    parts = [(b"OSMHeader", field(1, b"")), *[(b"OSMData", blob)] * blobs]
    path.write_bytes(b"".join(len(h).to_bytes(4, "big") + h + b for k, b in parts for h in [field(1, k) + field(3, len(b))]))
    return str(path)


def test_pbf(spark, tmp_path):
    table = b"".join(field(1, s) for s in (b"", b"addr:postcode", b"01001-000", b"postal_code", b"12"))
    dense = field(1, deltas(1, 2, 5)) + field(8, deltas(-235500000, -235600000, 0)) + field(9, deltas(-466300000, -466400000, 0)) + field(10, bytes([1, 2, 0, 1, 0, 3, 4, 0, 0]))
    plain = b"".join([number(1 << 3) + number(14), field(2, bytes([3])), field(3, bytes([2])), number(8 << 3) + number(4 * 10**9), number(9 << 3) + number(2)])
    raw = field(1, table) + field(2, field(2, dense)) + field(2, field(1, plain))
    found = pbf.nodes(spark, pbf_file(tmp_path / "a.pbf", raw))
    rows = sorted({(r.id, r.latitude, r.longitude, tuple(sorted(r.tags.items()))) for r in found.collect()})
    assert rows == [(1, -23.55, -46.63, (("addr:postcode", "01001-000"),)), (2, -23.56, -46.64, (("addr:postcode", ""), ("postal_code", "12"))), (5, 0.0, 0.0, ()), (7, 200.0, 1e-7, (("postal_code", "01001-000"),))]
    judged = pbf.judged_postcodes(found)
    assert tuple(pbf.counters(judged).first()) == (8, 6, 2, 2, 2)
    assert {r.source for r in pbf.evidence(judged).collect()} == {"openstreetmap:node/1"}
    with pytest.raises(gates.GateError, match="stand twice"):
        pbf.extract(spark, str(tmp_path / "a.pbf"), str(tmp_path / "twice"))
    once = pbf_file(tmp_path / "once.pbf", raw, blobs=1)
    assert pbf.extract(spark, once, str(tmp_path / "once")) == {"scanned": 4, "tagged": 3, "accepted": 1, "invalid_postcode": 1, "invalid_coordinate": 1}
    assert next((tmp_path / "once" / "csv").glob("part-*")).read_text() == "cep,ibge,latitude,longitude,source\n01001000,,-23.55,-46.63,openstreetmap:node/1\n"
    assert records.load_observations(spark, str(tmp_path / "once" / "csv"), map_nodes=True).count() == 1
    with pytest.raises(Exception, match="declares"):
        pbf.nodes(spark, pbf_file(tmp_path / "b.pbf", raw, len(raw) - 1)).collect()


def test_float_hex_and_digests(spark):
    values = [0.0, -0.0, 1.0, -23.55, 1e-7, 3.5e300, 5e-324, 0.1]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", float_hex(F.col("v")).alias("h")).collect()
    assert [r.h for r in got] == [v.hex() for v in values]
    points = [("é", "1", -23.55, -46.63, "s"), ("b", "1", 0.5, 1.0, "s"), ("b", "1", 0.5, 1.0, "s"), (None, "2", 0.0, 1.0, "t:1")]
    found = dict(centroid.evidence_digests(spark.createDataFrame(points, "evidence_id string, cep string, latitude double, longitude double, source string"), ["cep"]).collect())
    brute = lambda *rows: "sha256:" + hashlib.sha256(json.dumps(sorted((i, a.hex(), b.hex()) for i, a, b in rows), separators=(",", ":")).encode()).hexdigest()
    assert found == {"1": brute(("é", -23.55, -46.63), ("b", 0.5, 1.0)), "2": brute(("t:1", 0.0, 1.0))}


def test_exports_round_trip(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in sinks.FLAT[:11]) + ", latitude double, longitude double, precision string, method string, evidence_count long, evidence_radius_km double, geo_source array<string>, evidence_digest string, dataset_version string"
    one = ("01001001", "01001", "Praça", None, None, None, "São Paulo", "SP", None, None, "3550308", -23.55, -46.63, "observed_cep", "m", 1, 0.0001, ["a", "b"], "sha256:" + "0" * 64, "1")
    none = ("01001000", "01001", None, None, None, None, "X", "SP", None, None, "3550308", *[None] * 8, "1")
    flat = spark.createDataFrame([one, none], schema)
    sinks.write_jsonl(flat, str(tmp_path / "j"))
    lines = [line for p in sorted((tmp_path / "j").glob("part-*")) for line in p.read_text("utf-8").splitlines()]
    assert [json.loads(x)["cep"] for x in lines] == ["01001000", "01001001"] and '"coordinates":[-46.63,-23.55]' in lines[1] and '"evidence_radius_km":0.0001' in lines[1] and "Praça" in lines[1]
    assert {tuple(r) for r in map(str, sinks.read_jsonl(spark, str(tmp_path / "j")).collect())} == {tuple(r) for r in map(str, flat.collect())}
    sinks.write_csv(flat, str(tmp_path / "c"))
    rows = [line for p in sorted((tmp_path / "c").glob("part-*")) for line in p.read_text("utf-8").splitlines()]
    assert rows[0].split(",")[:2] == ["cep", "prefix"] and sum(r.startswith("0100100") for r in rows) == 2
    assert sinks.part_digests(spark, str(tmp_path / "j")).count() >= 1
    bad = spark.createDataFrame([(lines[1].replace(":", ": ", 1),), ("{}",), ("{",), (lines[0],)], "value string")
    assert sorted(r.problem for r in sinks.line_problems(bad).collect()) == ["no JSON", "not canonical", "other keys"]


def test_exports_that_break_a_rule_fail(spark, tmp_path):
    geo = {"type": "Point", "coordinates": [-46.63, -23.55], "precision": "observed_cep", "method": "m", "evidence_count": 1, "evidence_radius_km": 0.0, "source": ["a"], "evidence_digest": "sha256:" + "0" * 64}
    row = dict.fromkeys(sinks.TEXT) | {"cep": "01001000", "prefix": "01001", "city": "X", "uf": "SP", "ibge": "3550308", "dataset_version": "1", "geo": geo}
    line = lambda **more: sinks.canonical(row | more) + "\n"
    two = line(cep="01001001")
    path = tmp_path / "x.jsonl"

    def read(text, **more):
        path.write_text(text, "utf-8")
        return sinks.read_jsonl(spark, str(path), **more)

    fine = line() + two
    size, digest = len(fine.encode()), hashlib.sha256(fine.encode()).hexdigest()
    assert read(fine, version="1", expected={"x.jsonl": (size, digest)}).count() == 2
    cases = {
        "out of order": two + line(), "twice": line() + line(), "line feed": (line() + two)[:-1], "keys or kinds": line(geo=geo | {"colour": "red"}) + two, "canonical": line().replace(":", ": ", 1) + two,
        "against the contract": line(geo=geo | {"coordinates": [200.0, 95.0]}), "kind of": line(ibge=3550308), "point of two": line(geo=geo | {"coordinates": [1.0, 2.0, 3.0]}), "has lines": "", "longer than": line(street="x" * 70_000),
    }
    for match, text in cases.items():
        with pytest.raises(Exception, match={"has lines": "no file|has lines", "longer than": "longer than|too long"}.get(match, match)):
            read(text)
    with pytest.raises(gates.GateError, match="expected"):
        read(fine, expected={"x.jsonl": (size, "0" * 64)})
    with pytest.raises(gates.GateError, match="version"):
        read(fine, version="2")


def test_diff_files(spark, tmp_path):
    row = {"candidate_included": True, "cep": "01001000", "changed_fields": [], "classification": "unchanged", "current_ibge": "3550308", "geography_action": "preserved", "previous_cep": None, "previous_ibge": None, "valid_until": None}
    path = tmp_path / "d.jsonl"

    def read(*rows):
        path.write_text("".join(json.dumps(r) + "\n" for r in rows))
        return refresh.read_diff(spark, str(path)).collect()

    assert [r.cep for r in read(row, row | {"cep": "01001001", "changed_fields": ["street"], "classification": "address_changed"})] == ["01001000", "01001001"]
    cases = {"keys or kinds": [row | {"colour": "red"}], "kind of": [row | {"cep": 1001000}], "keys of": [{k: v for k, v in row.items() if k != "valid_until"}], "unfit": [row | {"geography_action": "unresolved"}], "out of order": [row | {"cep": "01001001"}, row]}
    for match, rows in cases.items():
        with pytest.raises(gates.GateError, match=match):
            read(*rows)
