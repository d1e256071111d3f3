"""GeoPackages and folders of records. A GeoPackage is a database file that one library opens as a whole: a task a file, of
2 GiB at most; archives and shapefiles are read by range (archives.py, shapefile.py)."""

from __future__ import annotations

import io
import re
import sqlite3
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.operators.gates import GateError

MOST_RATIO = 100
LOCALITY = ["CD_MUN", "CT_LOCALIDADE", "LAT_LOCALIDADE", "LONG_LOCALIDADE"]


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def safe_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """Members that are files, by name. Repeated names, paths that leave the archive, encryption, and sizes or
    compression ratios of a bomb are errors."""
    found = sorted((m for m in archive.infolist() if not m.is_dir()), key=lambda m: m.filename)
    names = [m.filename for m in found]
    if len(set(names)) < len(names):
        raise GateError("an archive member's name is repeated")
    for m in found:
        if m.filename.startswith("/") or ".." in m.filename.split("/") or m.flag_bits & 1 or m.file_size > MOST_RATIO * max(m.compress_size, 1):
            raise GateError(f"unsafe archive member {m.filename}")
    return found


def geopackage_localities(spark: SparkSession, path: str) -> DataFrame:
    """(ibge, category, latitude, longitude) of the first feature layer that has the locality columns, from GeoPackages
    or ZIPs that hold exactly one. Rows without coordinates are left out; a code that isn't seven digits is an error."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for content in frame["content"]:
                yield from localities_of(content)

    return files(spark, path).select("content").mapInPandas(load, "ibge string, category string, latitude double, longitude double")


def localities_of(content: bytes, batch: int = 10_000) -> Iterator[pd.DataFrame]:
    if content[:4] == b"PK\x03\x04":
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            inner = [m for m in safe_members(archive) if m.filename.lower().endswith(".gpkg")]
            if len(inner) != 1:
                raise GateError("the archive must hold one GeoPackage")
            content = archive.read(inner[0])
    quoted = lambda name: '"' + name.replace('"', '""') + '"'
    db = sqlite3.connect(":memory:")
    try:
        db.deserialize(content)
        layers = [r[0] for r in db.execute("select table_name from gpkg_contents where data_type = 'features' order by table_name")]
        fitting = [t for t in layers if set(LOCALITY) <= {r[1] for r in db.execute(f"pragma table_info({quoted(t)})")}]
        if not fitting:
            raise GateError("no layer holds localities")
        rows = db.execute(f"select {', '.join(LOCALITY)} from {quoted(fitting[0])} where LAT_LOCALIDADE is not null and LONG_LOCALIDADE is not null")
        while some := rows.fetchmany(batch):
            out = pd.DataFrame(some, columns=["ibge", "category", "latitude", "longitude"])
            out["ibge"] = out["ibge"].astype(str).str.replace(r"\D", "", regex=True)
            if (out["ibge"].str.len() != 7).any():
                raise GateError("a locality's municipality code isn't seven digits")
            yield out
    finally:
        db.close()


def directory_entries(spark: SparkSession, folder: str, suffix: str = ".json") -> DataFrame:
    """(member, content) of a folder's files, named by their path below it."""
    root = re.sub(r"^[a-z]+:/*", "/", folder).rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.filter(F.lower("path").endswith(suffix)).select(F.expr("substring(path, instr(path, {r}) + length({r}))".replace("{r}", repr(root))).alias("member"), "content")
