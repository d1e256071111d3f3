"""Quality rules: per-document counts and cross-document line frequency.

Lines are normalised and hashed with their host (the source); a line that stands in too many different documents of
its host is boilerplate and is removed; a document left with too little of its words is rejected. Copies of a document
count once, by the hash of their whole normalised text: mass copies are for deduplication to judge, not boilerplate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import SPACE, durable, map_arrow, raw

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    least_words: int = 10
    most_repeated: int = 20  # per cent of words in repeated 5-word windows
    line_docs: int = 20  # a line in more different documents of one host than this,
    line_share: float = 0.005  # and in more than this share of the host's different documents,
    line_most: int = 100  # or in more than this many however large the host, is removed
    least_left: float = 0.3  # share of its words that a document must keep
    broadcast_lines: int = 500_000  # removed lines that are sent to all executors; beyond, they are joined


def line_keys(text: bytes, host: bytes) -> list[tuple[int, bytes]]:
    """(64-bit key of host and normalised line, line) of each line with a word."""
    from xxhash import xxh3_64_intdigest

    out = []
    for line in text.split(b"\n"):
        if words := line.split():
            out.append((xxh3_64_intdigest(host + b"\0" + b" ".join(words).lower()) - (1 << 63), line))
    return out


def host_bytes(source: bytes | None) -> bytes:
    return b"\1" if source is None else b"\2" + source


def removed_lines(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(line long): keys of the lines above the limits, from all documents."""

    def make():
        from xxhash import xxh3_64_intdigest

        def step(batch: pa.RecordBatch):
            lines, texts, hosts = [], [], []
            for text, source in zip(raw(batch.column(0)), raw(batch.column(1)), strict=True):
                host = host_bytes(source)
                keys = np.array([k for k, _ in line_keys(text or b"", host)], np.int64)
                key = xxh3_64_intdigest(host + b"\0") - (1 << 63)
                seen = dict.fromkeys([key, *keys.tolist()])
                lines += seen
                texts += [xxh3_64_intdigest(keys.tobytes()) - (1 << 63)] * len(seen)
                hosts += [key] * len(seen)
            yield {"line": lines, "text": texts, "host": hosts}

        return step

    rows = map_arrow(docs.select(F.col("text").cast("string"), F.col("source").cast("string")), make, "line long, text long, host long")
    # each text also has its host's empty line, which counts the host's different texts
    counts = durable(rows.distinct().groupBy("line", "host").agg(F.count("*").alias("n")).filter((F.col("line") == F.col("host")) | (F.col("n") > rules.line_docs)))
    hosts = counts.filter("line = host").select("host", F.col("n").alias("docs"))
    limit = F.greatest(F.lit(rules.line_docs), F.least(rules.line_share * F.col("docs"), F.lit(rules.line_most)))
    return counts.filter("line <> host").join(hosts, "host").filter(F.col("n") > limit).select("line")


def repeated_words(words: list[bytes]) -> int:
    """Words in 5-word windows that stand twice or more in the text."""
    n = len(words)
    if n < 6:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = len(number)
    if base < 6000:  # base ** 5 < 2 ** 63
        window = (((ids[:-4] * base + ids[1:-3]) * base + ids[2:-2]) * base + ids[3:-1]) * base + ids[4:]
    else:  # number the pairs, then pairs of pairs
        pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
        fours = np.unique(pairs[:-2] * n + pairs[2:], return_inverse=True)[1]
        window = fours[:-1] * base + ids[4:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.subtract.at(edge, at + 5, 1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = text.split()
    data = np.frombuffer(text, np.uint8)
    chars = int(((data & 0xC0) != 0x80).sum() - SPACE[data].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, int(SYMBOLS[data].sum()), len(lines) - len(set(lines)), repeated_words(words)


def judge(docs: DataFrame, rules: Rules = Rules(), carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_lines, clean_text, and carried columns).

    docs needs doc_id, text and source; other columns, whatever their names, are left aside unless carried. Null or empty
    text has no word and fails; a null source is a host of its own; very long texts are judged whole; a line at a limit
    stays, one above it goes; repeated rows get the same verdict; an empty table gives an empty result. clean_text is the text without the
    removed lines (null for null text); ask for it or not, an unused column costs little.
    """
    spark, lines = docs.sparkSession, durable(removed_lines(docs, rules))
    names = ["doc_id", "text", "source", *carry]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"), *carry)
    if (n := lines.count()) <= rules.broadcast_lines:
        known = spark.sparkContext.broadcast(np.array(sorted(r[0] for r in lines.collect()), np.int64) if n else np.zeros(0, np.int64))
    else:
        known = None
        mark = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("mark")

        def listed():
            def step(batch: pa.RecordBatch):
                out = {"doc_id": [], "mark": [], "line": []}
                for key, mark, text, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2)), raw(batch.column(3)), strict=True):
                    own = {k for k, _ in line_keys(text or b"", host_bytes(source))}
                    out["doc_id"] += [key] * len(own)
                    out["mark"] += [mark] * len(own)
                    out["line"] += own
                yield out

            return step

        own = map_arrow(rows.select("doc_id", mark, "text", "source"), listed, "doc_id long, mark long, line long")
        bad = own.join(lines, "line").groupBy(F.col("doc_id").alias("_d"), F.col("mark").alias("_m")).agg(F.collect_set("line").alias("bad"))  # a document's own lines
        rows = rows.withColumn("mark", mark).join(bad, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")), "left").select(*names, "bad")

    def make():
        table = None if known is None else known.value

        def step(batch: pa.RecordBatch):
            found = []
            bads = None if table is not None else batch.column(batch.num_columns - 1).to_pylist()
            for i, (text, source) in enumerate(zip(raw(batch.column(1)), raw(batch.column(2)), strict=True)):
                whole = text or b""
                row = counts(whole)
                keys = line_keys(whole, host_bytes(source)) if len(table if table is not None else bads[i] or ()) else []
                if keys and table is not None:
                    own = np.fromiter((k for k, _ in keys), np.int64, len(keys))
                    hit = table[np.minimum(np.searchsorted(table, own), len(table) - 1)] == own
                else:
                    hit = [k in (bads[i] or ()) for k, _ in keys] if keys else []
                gone = sum(len(line.split()) for (_, line), h in zip(keys, hit, strict=True) if h)
                failed = row[0] < rules.least_words or 100 * row[4] > rules.most_repeated * row[0]
                clean = text
                if gone:
                    bad_lines = {line for (_, line), h in zip(keys, hit, strict=True) if h}
                    clean = b"\n".join(x for x in whole.split(b"\n") if x not in bad_lines)
                left = row[0] - gone
                found.append((*row, failed, not failed and left >= max(rules.least_words, rules.least_left * row[0]), int(np.sum(hit)), clean))
            columns = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines", "clean_text"), zip(*found, strict=True) if found else [[]] * 9, strict=True))
            columns["clean_text"] = pa.array(columns["clean_text"], pa.binary()).cast(pa.string())
            yield columns | {"doc_id": batch.column(0), **{c: batch.column(3 + k) for k, c in enumerate(carry)}}

        return step

    extra = "".join(f", {f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in docs.select(*carry).schema) if carry else ""
    return map_arrow(rows, make, f"doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_removed_lines long, clean_text string{extra}")
