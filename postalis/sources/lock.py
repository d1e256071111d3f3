"""Locked inputs: a document names each source file with its size and digest; Spark digests the files and compares."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postalis.operators.gates import GateError, require_empty
from postalis.sources import store

SHA256 = re.compile("[0-9a-f]{64}")
# Text fields that every source has, and how a source may be had.
TEXTS = ("id", "filename", "role", "version", "retrieved_at", "attribution", "license_status", "terms_status")
ACQUISITIONS = {"https": "url", "repository": "local_path"}


@dataclass(frozen=True)
class Source:
    id: str
    filename: str
    required: bool
    bytes: int
    sha256: str
    acquisition: str
    place: str  # the URL, or the path in the repository
    members: dict[str, tuple[int, str]]
    texts: dict[str, str]

    @property
    def metadata(self) -> dict:
        """What a build's manifest says of a source it used."""
        return {**self.texts, "bytes": self.bytes, "sha256": self.sha256, "acquisition": self.acquisition, ACQUISITIONS[self.acquisition]: self.place}


@dataclass(frozen=True)
class Lock:
    """A lock with its own identity, which a build's manifest names."""

    release: str
    publication_gate: str
    sha256: str
    sources: tuple[Source, ...]

    @property
    def metadata(self) -> dict:
        return {"release": self.release, "publication_gate": self.publication_gate, "sha256": self.sha256}


def source_problems(raw: dict) -> list[str]:
    """What is wrong with one source of a lock."""
    text = lambda x: isinstance(x, str) and bool(x.strip())
    size = lambda x, low: isinstance(x, int) and not isinstance(x, bool) and x >= low
    digest = lambda x: isinstance(x, str) and bool(SHA256.fullmatch(x))
    if not isinstance(raw, dict):
        return ["a source is no object"]
    out = [f"{n} must be text" for n in TEXTS if not text(raw.get(n))]
    if text(raw.get("filename")) and ("/" in raw["filename"] or raw["filename"] in (".", "..")):
        out.append("filename must be a bare name")
    if not isinstance(raw.get("required"), bool):
        out.append("required must be true or false")
    if not size(raw.get("bytes"), 0) or not digest(raw.get("sha256")):
        out.append("bytes and sha256 must be a size and a digest")
    own = ACQUISITIONS.get(raw.get("acquisition"))
    if own is None:
        out.append(f"acquisition must be one of {', '.join(ACQUISITIONS)}")
    else:
        place = raw.get(own)
        if not text(place) or any(raw.get(other) is not None for other in ACQUISITIONS.values() if other != own):
            out.append(f"{raw['acquisition']} needs {own} and nothing else")
        elif (own == "url" and not place.startswith("https://")) or (own == "local_path" and (place.startswith("/") or ".." in place.split("/"))):
            out.append(f"{own} must be a secure address or a path inside the repository")
    members = raw.get("members")
    if members is not None:
        sound = isinstance(members, dict) and members and all(n and "/" not in n and "\\" not in n and isinstance(v, dict) and set(v) == {"bytes", "sha256"} and size(v["bytes"], 1) and digest(v["sha256"]) for n, v in members.items())
        if not sound or len({n.casefold() for n in members}) < len(members):
            out.append("members must be different bare names, each with bytes and sha256")
    return out


def load_lock(spark: SparkSession, path: str, kind: str) -> tuple[Source, ...]:
    """The sources of a lock of the given format."""
    return whole_lock(spark, path, kind).sources


def whole_lock(spark: SparkSession, path: str, kind: str) -> Lock:
    """A lock of the given format."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one document
    try:
        document = json.loads(text)
    except ValueError as error:
        raise GateError(f"the lock is no JSON: {error}") from error
    if not isinstance(document, dict) or document.get("format") != kind or not document.get("release") or not document.get("publication_gate"):
        raise GateError("a lock has a known format, a release and a publication gate")
    raw = document.get("sources")
    if not isinstance(raw, list) or not raw:
        raise GateError("a lock has sources")
    problems = [f"source {i}: {p}" for i, r in enumerate(raw) for p in source_problems(r)]
    for name in ("id", "filename"):
        found = [r.get(name) for r in raw if isinstance(r, dict)]
        problems += [f"{name} {x} stands twice" for x in sorted({str(x) for x in found if found.count(x) > 1})]
    if problems:
        raise GateError("; ".join(problems))
    sources = tuple(
        Source(r["id"], r["filename"], r["required"], r["bytes"], r["sha256"], r["acquisition"], r[ACQUISITIONS[r["acquisition"]]], {n: (m["bytes"], m["sha256"]) for n, m in (r.get("members") or {}).items()}, {n: r[n] for n in TEXTS})
        for r in raw
    )
    return Lock(document["release"], document["publication_gate"], hashlib.sha256(text.encode()).hexdigest(), sources)


def locked_inputs(spark: SparkSession, lock: Lock, inputs: dict[str, str]) -> list[dict]:
    """Metadata of the locked sources that inputs (name -> path of one file) are, by size and digest; an input that isn't in
    the lock, and two inputs that are the same source, are errors."""
    found = []
    for name, path in sorted(inputs.items()):
        files = store.digests(spark, path).select(store.file_name(F.col("path")).alias("file"), "bytes", "sha256").take(2)
        own = [s for s in lock.sources if len(files) == 1 and (s.filename, s.bytes, s.sha256) == tuple(files[0])]
        if not own:
            raise GateError(f"{name} isn't a file of the lock: {[tuple(f)[:2] for f in files]}")
        found.append({"input": name, **own[0].metadata})
    if len({f["id"] for f in found}) < len(found):
        raise GateError("two inputs are the same locked source")
    return found


def selected(sources: tuple[Source, ...], ids: tuple[str, ...] = (), optional: bool = False) -> tuple[Source, ...]:
    """The named sources, or all required ones, with optional also those that aren't."""
    if unknown := set(ids) - {s.id for s in sources}:
        raise GateError(f"unknown sources: {sorted(unknown)}")
    return tuple(s for s in sources if (s.id in ids if ids else s.required or optional))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, bytes, sha256) of a folder's files, of any size."""
    return store.digests(spark, folder).select(store.file_name(F.col("path")).alias("filename"), "bytes", "sha256")


def lock_problems(spark: SparkSession, folder: str, sources: tuple[Source, ...]) -> DataFrame:
    """(id, problem): locked files that are missing from the folder, or of another size or digest."""
    want = spark.createDataFrame([(s.id, s.filename, s.bytes, s.sha256) for s in sources], "id string, filename string, _bytes long, _sha256 string")
    both = want.join(digests(spark, folder), "filename", "left")
    problem = F.when(F.col("bytes").isNull(), "missing").when(F.col("bytes") != F.col("_bytes"), "size").when(F.col("sha256") != F.col("_sha256"), "digest")
    return both.select("id", problem.alias("problem")).filter("problem is not null")


def verify_sources(spark: SparkSession, folder: str, sources: tuple[Source, ...]) -> None:
    require_empty(lock_problems(spark, folder, sources), "inputs against their lock")


def folder_digest(entries: DataFrame) -> DataFrame:
    """(bytes, sha256) of a folder's entries (member, content): the digest of their names and digests in order of names,
    so that files are digested apart and only a line a file comes together."""
    rows = entries.select("member", F.length("content").cast("long").alias("n"), F.sha2("content", 256).alias("own"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("member", "own"))), lambda x: F.concat_ws("\t", x["member"], x["own"])), "\n")  # a line a file
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"), F.sha2(lines, 256).alias("sha256"))
