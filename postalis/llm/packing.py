"""Best-fit packing of token sequences by large-item matching.

Lengths are whole numbers up to the capacity, so a packing is decided on the histogram of lengths, whose size is the
capacity and not the corpus. The plan is a list of events "items rank..rank+n of this length go to bins from b on";
executors look their pieces up in it by length and rank. Ranks come from counts per partition and length, so no
length, however common, meets in one task.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right, insort
from struct import Struct
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postalis.llm.common import durable, map_arrow, raw

CAPACITY = 4096
END_ID = 1


#: Letters below U+0250 that are their own lower case and composed form, and ASCII marks but the apostrophe (which may
#: start a contraction): between such runs the pre-tokenizer always cuts, and within them never.
LETTERS = "".join(c for c in map(chr, range(0x61, 0x250)) if c.isalpha() and c == c.lower() == normalize("NFC", c))
MARKS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
RUN = re.compile(f"[{LETTERS}]+|[{re.escape(MARKS)}]+")
RUNS = re.compile(f"(?:{RUN.pattern})+")
#: The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for the characters from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
ALPHABET = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}


PACKS = [Struct(f"<{n}I").pack for n in range(64)]


def packed(ids: list[int]) -> bytes:
    return PACKS[len(ids)](*ids) if len(ids) < len(PACKS) else Struct(f"<{len(ids)}I").pack(*ids)


class TokenIds(dict):
    """White-space delimited chunk -> its ids as little-endian uint32 bytes. The pre-tokenizer never joins chunks across
    ASCII white space, so a text's ids are its chunks' ids in turn. One per task, of about `most` chunks; beyond,
    the earliest, which are the common ones, stay.

    Chunks of letters and marks go to the tokenizer's model run by run, which spares them its normalizer and
    pre-tokenizer; a tokenizer whose own rules give other ids for samples of such chunks gets every chunk whole.
    """

    def __init__(self, path: str, most: int = 250_000) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most, self.by_runs = Tokenizer.from_file(path), most, True
        self.tokenize = self.tokenizer.model.tokenize
        samples = [x + y for x in (*LETTERS, "letters", "été", LETTERS) for y in ("", ".", "...", "$$$", ",word", "-", MARKS.replace("<", ""))]
        self.by_runs = all(self[x.encode()] == packed(found.ids) for x, found in zip(samples, self.tokenizer.encode_batch_fast(samples, add_special_tokens=False), strict=True))
        if not self.by_runs:
            self.clear()

    def __missing__(self, chunk: bytes) -> bytes:
        if self.by_runs and chunk.isalpha() and chunk.islower():  # ASCII, which the byte-level alphabet leaves as it is
            ids = packed([x.id for x in self.tokenize(chunk.decode())])
        elif self.by_runs and RUNS.fullmatch(text := chunk.decode()) and "<|" not in text:
            runs = RUN.findall(text)
            if len(runs) == 1:
                ids = packed([x.id for x in self.tokenize(chunk.decode("latin-1").translate(ALPHABET))])
            else:
                ids = b"".join([self[run.encode()] for run in runs])
        else:
            ids = packed(self.tokenizer.encode_batch_fast([chunk.decode()], add_special_tokens=False)[0].ids)
        self[chunk] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > self.most:
            for chunk in list(self)[self.most * 2 // 5 :]:
                del self[chunk]
        # The tokenizer lowers case itself; only its special tokens, "<|...|>", are told apart by case before.
        return [b"".join(map(self.__getitem__, (t if b"<|" in t else t.lower()).split())) for t in texts]


def token_ids(path: str) -> TokenIds:
    """One for a task, so that its memory goes with the task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return TokenIds(path)


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Events (length, first rank, first bin, items a bin, offset), sorted by length and rank.

    Items over a third of the capacity, of which a bin holds two at most, are matched greedily: the longest with the
    longest that still fits. Shorter ones follow in falling length, each into the smallest gap that takes it, as often
    as it fits. Each full use of a gap at least halves it, so the list is bounded by about capacity * log2(capacity).
    """
    left, rank = [int(x) for x in histogram], [0] * (capacity + 1)
    events: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int, int]]] = {}
    order: list[int] = []
    bins, third = 0, capacity // 3

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        events.append((length, rank[length], first, each, offset))
        rank[length] += n
        left[length] -= n

    def leave(gap: int, first: int, n: int, offset: int) -> None:
        if gap and n:
            if gap not in gaps:
                insort(order, gap)
            gaps.setdefault(gap, []).append((first, n, offset))

    large = [x for x in range(third + 1, capacity + 1) if left[x]]
    while large:
        length = large[-1]
        k = bisect_right(large, capacity - length) - 1
        partner = large[k] if k >= 0 else 0
        if partner == length and left[length] == 1:
            partner = large[k - 1] if k else 0
        if not partner:
            n = left[length]
        else:
            n = left[length] // 2 if partner == length else min(left[length], left[partner])
        put(length, n, bins, 1, 0)
        if partner:
            put(partner, n, bins, 1, length)
        leave(capacity - length - partner, bins, n, length + partner)
        bins += n
        for x in {length, partner} - {0}:
            if not left[x]:
                large.remove(x)
    for length in range(third, 0, -1):
        while left[length]:
            k = bisect_right(order, length - 1)
            if k == len(order):
                n = -(-left[length] // (capacity // length))
                leave(capacity, bins, n, 0)
                bins += n
                continue
            gap = order[k]
            first, n, offset = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(k)
            each = gap // length
            full = min(n, left[length] // each)
            if full:
                put(length, full * each, first, each, offset)
                leave(gap - each * length, first, full, offset + each * length)
            rest = left[length] if full < n else 0
            if rest:
                put(length, rest, first + full, rest, offset)
                leave(gap - rest * length, first + full, 1, offset + rest * length)
            leave(gap, first + full + bool(rest), n - full - bool(rest), offset)
    return np.array(sorted(events), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): nth numbers the pieces of one length within a partition."""

    def cut():
        ids, part, seen = token_ids(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)

        def step(batch: pa.RecordBatch):
            found = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "nth")}
            texts, keys = raw(batch.column(1)), batch.column(0).to_pylist()
            for at in range(0, len(texts), 256):
                for doc, got in zip(keys[at : at + 256], ids.encode([t or b"" for t in texts[at : at + 256]]), strict=True):
                    got += END_ID.to_bytes(4, "little")
                    for k, start in enumerate(range(0, len(got), 4 * capacity)):
                        own = got[start : start + 4 * capacity]
                        length = len(own) // 4
                        for name, x in (("doc_id", doc), ("piece", k), ("start", start // 4), ("length", length), ("ids_crc32", zlib.crc32(own)), ("nth", seen[length])):
                            found[name].append(x)
                        seen[length] += 1
            yield found | {"part": np.full(len(found["piece"]), part)}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    docs needs doc_id and text; other columns, whatever their names, are left aside. Null text is empty and packs as the
    end id alone; documents longer than the capacity are cut into full pieces and a rest. Repeated rows are packed one by
    one, pieces of equal length in any order. An empty table gives an empty result.
    """
    cut = durable(pieces(docs, tokenizer, capacity))
    counts = durable(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the corpus
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # capacity rows at most
        histogram[length] = n
    events = cut.sparkSession.sparkContext.broadcast(plan(histogram, capacity))  # bounded by the capacity, see plan()

    def placed():
        table = events.value
        keys = (table[:, 0] << 44) + table[:, 1]

        def step(batch: pa.RecordBatch):
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length, rank = columns["length"].to_numpy(), columns["nth"].to_numpy() + columns["first"].to_numpy()
            at = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1] if len(length) else np.zeros((0, 5), np.int64)
            nth, each = rank - at[:, 1], np.maximum(at[:, 3], 1)
            yield columns | {"sequence_id": at[:, 2] + nth // each, "offset": at[:, 4] + nth % each * length}

        return step

    return map_arrow(cut.join(first, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "first"), placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
