"""Readers by range: ZIP members, shapes by record index, lines with their place, digests and identities of files."""

import hashlib
import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from postalis.operators import containment, gates
from postalis.sources import archives, containers, lines, records, shapefile, store


def test_ten_thousand_members_by_many_tasks(spark, tmp_path):
    folder = tmp_path / "d"
    folder.mkdir()
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(10_000):
            text = json.dumps({"cep": f"{i:08d}", "localidade": "x" * (i % 50)})
            z.writestr(zipfile.ZipInfo(f"v1/{i:08d}.json") if i % 3 else f"v1/{i:08d}.JSON", text)
            if i % 25 == 0:
                (folder / f"{i:08d}.json").write_text(text)
        z.writestr("v1/", "")
        z.writestr("notes.txt", "x")
    found = archives.zip_entries(spark, str(tmp_path / "a.zip"), partition_members=700)
    rows = records.load_records(found)
    assert rows.count() == 10_000 and found.rdd.getNumPartitions() == 15
    part = {r.cep: r.sha256 for r in rows.filter("cast(cep as int) % 25 = 0").collect()}
    assert part == {r.cep: r.sha256 for r in records.records(containers.directory_entries(spark, str(folder))).collect()} and len(part) == 400
    assert min(archives.zip_members(spark, str(tmp_path / "a.zip"), partition_members=700).groupBy(F.spark_partition_id()).count().toPandas()["count"]) > 100


def test_damaged_archives_fail(spark, tmp_path):
    def made(name, change=lambda z: None, method=zipfile.ZIP_STORED):
        with zipfile.ZipFile(tmp_path / name, "w", method) as z:
            z.writestr("a.json", '{"cep": "01001000"}')
            z.writestr("b.json", '{"cep": "01001001"}')
            change(z)
        return tmp_path / name

    read = lambda path: archives.zip_entries(spark, str(path)).collect()
    assert len(read(made("fine.zip"))) == 2
    with pytest.raises(gates.GateError, match="repeated"), pytest.warns(UserWarning):
        read(made("twice.zip", lambda z: z.writestr("a.json", "{}")))
    with pytest.raises(Exception, match="bomb"):
        read(made("bomb.zip", lambda z: z.writestr("c.json", "0" * 200_000), zipfile.ZIP_DEFLATED))
    for name, old, new, match in [("sum.zip", b"01001001", b"01001002", "corrupt"), ("cut.zip", b"PK\x05\x06", b"PK\x05\x07", "not a ZIP"), ("place.zip", b"PK\x03\x04", b"PK\x03\x05", "isn't where")]:
        path = made(name)
        path.write_bytes(path.read_bytes().replace(old, new, 1))
        with pytest.raises(Exception, match=match):
            read(path)
    locked = bytearray(made("locked.zip").read_bytes())
    locked[locked.index(b"PK\x01\x02") + 8] |= 1
    (tmp_path / "locked.zip").write_bytes(locked)
    with pytest.raises(Exception, match="encrypted"):
        read(tmp_path / "locked.zip")


def square(x, y, side=1.0):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def shape_members(polygons, stem="m"):
    """The five members of a shapefile of polygons (code, rings)."""
    shapes, index, at = b"", b"", 50
    boxes = []
    for number, (_, rings) in enumerate(polygons, 1):
        points = [p for ring in rings for p in ring]
        xs, ys = zip(*points)
        boxes.append((min(xs), min(ys), max(xs), max(ys)))
        starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
        body = struct.pack("<i4dii", 5, *boxes[-1], len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<dd", *p) for p in points)
        shapes += struct.pack(">ii", number, len(body) // 2) + body
        index += struct.pack(">ii", at, len(body) // 2)
        at += 4 + len(body) // 2
    x0, y0, x1, y1 = zip(*boxes)
    head = lambda size: struct.pack(">i20xi", 9994, (100 + size) // 2) + struct.pack("<ii8d", 1000, 5, min(x0), min(y0), max(x1), max(y1), *[0.0] * 4)
    table = struct.pack("<4BIHH20x", 3, 24, 1, 1, len(polygons), 65, 8) + b"CD_MUN".ljust(11, b"\0") + b"C" + bytes(4) + bytes([7]) + bytes(15) + b"\r" + b"".join(b" " + code.encode() for code, _ in polygons) + b"\x1a"
    return {f"{stem}.shp": head(len(shapes)) + shapes, f"{stem}.shx": head(len(index)) + index, f"{stem}.dbf": table, f"{stem}.prj": shapefile.SYSTEM, f"{stem}.cpg": b"UTF-8"}


def shape_zip(path, members, method=zipfile.ZIP_STORED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return str(path)


POLYGONS = [("3550308", [square(-47, -24), square(-46.6, -23.6, 0.2)]), ("3304557", [square(-44, -23)]), ("5300108", [square(-48, -16, 0.5)])]


def test_shapes_by_record_index_feed_containment(spark, tmp_path):
    one = shapefile.polygon_edges(spark, shape_zip(tmp_path / "a.zip", shape_members(POLYGONS)), partition_bytes=100)
    assert one.rdd.getNumPartitions() == 3 and one.count() == 16
    packed = shapefile.polygon_edges(spark, shape_zip(tmp_path / "b.zip", shape_members(POLYGONS), zipfile.ZIP_DEFLATED), partition_bytes=100)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, one.collect()))
    points = spark.createDataFrame([("in", "3550308", -23.2, -46.5), ("hole", "3550308", -23.5, -46.5), ("edge", "3304557", -23.0, -43.5)], "evidence_id string, ibge string, latitude double, longitude double")
    assert dict(containment.classify(points, one).collect()) == {"in": "interior", "hole": "outside", "edge": "boundary"}


def test_shape_archives_of_another_form_fail(spark, tmp_path):
    whole = shape_members(POLYGONS)

    def read(name, members, official=False, expected=None):
        """The reader's rows, without Spark around it."""
        options = {"paths": shape_zip(tmp_path / f"{name}.zip", members), "official": str(official).lower(), "expected": "\n".join(f"{n}\t{a}\t{b}" for n, (a, b) in (expected or {}).items())}
        reader = shapefile.ShapeReader(options)
        return sum(batch.num_rows for part in reader.partitions() for batch in reader.read(part))

    locked = {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in whole.items()}
    assert read("locked", whole, expected=locked) == 16

    def changed(name, at, data):
        member = bytearray(whole[name])
        member[at : at + len(data)] = data
        return whole | {name: bytes(member)}

    second = 100 + 8 + 44 + 8 + 160  # the second shape's header
    cases = {
        "path": ({**{n: d for n, d in whole.items() if n != "m.cpg"}, "../m.cpg": b"UTF-8"}, "unsafe"),
        "more": ({**whole, "README.txt": b"x"}, "one shapefile"),
        "stem": ({**{n: d for n, d in whole.items() if n != "m.cpg"}, "n.cpg": b"UTF-8"}, "names differ"),
        "system": (whole | {"m.prj": b'GEOGCS["WGS 84"]'}, "SIRGAS"),
        "encoding": (whole | {"m.cpg": b"LATIN1"}, "UTF-8"),
        "index": (changed("m.shx", 100, struct.pack(">I", 51)), "aligned"),
        "deleted": (changed("m.dbf", 65, b"*"), "deleted"),
        "code": (changed("m.dbf", 66, b"x"), "malformed"),
        "dimensions": (changed("m.dbf", 4, struct.pack("<I", 2)), "dimensions"),
        "trailing": (changed("m.dbf", len(whole["m.dbf"]) - 1, b"x"), "bytes behind"),
        "file code": (changed("m.shp", 0, struct.pack(">I", 9995)), "file code"),
        "number": (changed("m.shp", second, struct.pack(">I", 9)), "aligned"),
        "parts": (changed("m.shp", 152, struct.pack("<I", 1)), "part indexes"),
        "open": (changed("m.shp", 160 + 4 * 16, struct.pack("<d", -46.75)), "closed"),
        "box": (changed("m.shp", 112, struct.pack("<d", -47.5)), "bounds"),
        "repeats": (changed("m.shp", 160 + 16, struct.pack("<dd", -47.0, -24.0)), "repeats a point"),
        "kind": (changed("m.shp", 108, struct.pack("<i", 3)), "no polygon"),
    }
    for name, (members, match) in cases.items():
        with pytest.raises(Exception, match=match):
            read(name, members)
    for name, identity in {"m.shp": (len(whole["m.shp"]), "0" * 64), "other": (1, "0" * 64)}.items():
        with pytest.raises(Exception, match="locked"):
            read("lock", whole, expected={**locked, name: identity})
    with pytest.raises(Exception, match="official"):
        read("official", whole, official=True)
    with pytest.raises(gates.GateError, match="repeated municipality"):
        shapefile.polygon_edges(spark, shape_zip(tmp_path / "repeated.zip", changed("m.dbf", 66 + 8, b"3550308")))
    wide = shape_members([*POLYGONS, ("1100205", [square(-50, -30)])])
    with pytest.raises(gates.GateError, match="header's bounds"):
        shapefile.polygon_edges(spark, shape_zip(tmp_path / "wide.zip", {**wide, **{n: wide[n][:36] + struct.pack("<d", -51.0) + wide[n][44:] for n in ("m.shp", "m.shx")}}))
    flipped = tmp_path / "sum.zip"
    shape_zip(flipped, whole)
    flipped.write_bytes(flipped.read_bytes().replace(b"UTF-8", b"UTF-9", 1))
    with pytest.raises(Exception, match="corrupt"):
        shapefile.ShapeReader({"paths": str(flipped)}).partitions()


def test_lines_know_their_place(spark, tmp_path):
    texts = [f"{i}:" + "é" * (i * 7 % 90) for i in range(3000)]
    (tmp_path / "f").mkdir()
    one, two = "\n".join(texts[:2000]) + "\n", "\n".join(texts[2000:])
    (tmp_path / "f" / "part-0").write_text(one, "utf-8")
    (tmp_path / "f" / "part-1").write_text(two, "utf-8")
    found = lines.placed_lines(spark, str(tmp_path / "f"), partition_bytes=1000).orderBy("position").collect()
    assert [r.value for r in found] == texts and [r.ended for r in found] == [True] * 2999 + [False]
    whole = (one + two).encode()
    assert all(whole[r.position :].startswith(r.value.encode()) for r in found[::97]) and found[2000].offset == 0 and found[2000].file == "part-1"
    assert lines.placed_lines(spark, str(tmp_path / "f"), partition_bytes=5000).count() == 3000
    (tmp_path / "long").write_text("x" * 3_000_000 + "\n")
    with pytest.raises(Exception, match="longer than"):
        lines.placed_lines(spark, str(tmp_path / "long"), most=65_536).count()


def test_digests_and_unchanged_inputs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, size in (("b", 3), ("c", 5_000_000)):
        (tmp_path / "in" / name).write_bytes(b"ab\n" * (size // 3))
    found = {r.path.rsplit("/", 1)[-1]: (r.bytes, r.sha256) for r in store.digests(spark, str(tmp_path / "in")).collect()}
    assert found == {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in (tmp_path / "in").iterdir()}
    with store.unchanged(spark, str(tmp_path / "in"), content=True) as before:
        spark.read.text(str(tmp_path / "in")).count()
    assert before[str(tmp_path / "in")][:2] == (2, 4_999_998 + 3)
    with pytest.raises(gates.GateError, match="changed while"), store.unchanged(spark, str(tmp_path / "in")):
        (tmp_path / "in" / "b").write_bytes(b"abcd")
    with pytest.raises(gates.GateError, match="changed while"), store.unchanged(spark, str(tmp_path / "in")):
        (tmp_path / "in" / "d").write_bytes(b"x")


def test_lines_of_any_range():
    whole = b"ab\n\ncdefg\nh"
    for size in range(1, 14):
        found = [x for i in range(0, len(whole), size) for some in lines.lines_of(io.BytesIO(whole), i, min(len(whole), i + size), 100) for x in some]
        assert found == [(0, b"ab", True), (3, b"", True), (4, b"cdefg", True), (10, b"h", False)]
