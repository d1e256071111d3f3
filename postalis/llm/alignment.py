"""Cross-tokenizer alignment by external spill counting.

Texts are cut where both tokenizers cut (before white space that follows another character); such a unit is encoded once a task. Links
become records (pair of ids, document), which each task sorts and radix-partitions by the id of side B into zstd runs.
Heap merges over at most FAN_IN runs at a time, major by side B, sum each pair over the corpus, in as many levels as there are
runs; then the sums meet the runs once more, and each run's share of its documents' figures streams back to them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import Scratch, map_arrow, packed, steps, unpacked

#: Buckets of side B's ids; a bucket's pairs with their sums are held by a task.
BUCKETS = 64
#: Links a task buffers before it writes a run, and documents of a run.
RUN_LINKS, RUN_DOCS = 1_000_000, 60_000
#: Runs of one heap merge; more are merged by levels.
FAN_IN = 256
#: Bytes of packed records that meet a bucket's sums in one task.
PART_BYTES = 8 << 20
#: Pairs of a block of a run, which is unpacked alone.
BLOCK = 4096
#: Letters of a text encoded at once, and units and links remembered by a task.
PORTION, MOST_UNITS, MOST_LINKS = 1 << 20, 300_000, 4_000_000
#: Units encoded at once, and letters of a unit that is encoded alone.
TOGETHER, LONG_UNIT = 4000, 10_000

# Fixed value: how byte-level tokenizers cut texts before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What side B's pieces have for a space.
PIECE_SPACE = "▁"
#: The Unicode property White_Space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space before other characters, which a carriage return may continue: pieces of side B end with one.
UNIT = re.compile(rf"[{SPACE}]*[^{SPACE}]+(?:\r[{SPACE}]*(?:[^{SPACE}]+|\Z))*|[{SPACE}]+")

FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
ROWS = "run long, at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, bucket int, head binary, body binary, size long"


def to_head(keys: np.ndarray, sums: np.ndarray) -> bytes:
    """Sorted pairs with their sums, in blocks that can be unpacked one by one."""
    out = []
    for i in range(0, len(keys), BLOCK):
        k = keys[i : i + BLOCK]
        block = packed(steps(k), sums[i : i + BLOCK].astype(np.int64))
        out += [len(k).to_bytes(4, "little"), len(block).to_bytes(4, "little"), block]
    return b"".join(out)


def blocks_of(head: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(head):
        n, size = (int.from_bytes(head[i : i + 4], "little") for i in (at, at + 4))
        keys, sums = unpacked(head[at + 8 : at + 8 + size], (n, "u4"), (n, "i8"))
        yield np.cumsum(keys, dtype=np.uint32), sums
        at += 8 + size


def by_side(head: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(id of side B, pairs, sums); an id that goes on in the next block comes again."""
    for keys, sums in blocks_of(head):
        side = keys >> np.uint32(16)
        at = [0, *(np.flatnonzero(side[1:] != side[:-1]) + 1).tolist(), len(side)]
        for i, j in zip(at, at[1:]):
            yield int(side[i]), keys[i:j], sums[i:j]


def merged(heads: list[bytes]) -> bytes:
    """One head of all pairs of several: a heap over the heads' cursors, one id of side B at a time."""
    keys, sums = [], []
    for _, found in groupby(heapq.merge(*map(by_side, heads), key=lambda x: x[0]), key=lambda x: x[0]):
        own = list(found)
        pair, place = np.unique(np.concatenate([x[1] for x in own]), return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, place, np.concatenate([x[2] for x in own]))
        keys.append(pair)
        sums.append(total)
    return to_head(np.concatenate(keys), np.concatenate(sums)) if keys else b""


def to_body(keys: np.ndarray, at: np.ndarray, n: np.ndarray) -> bytes:
    """Records sorted by pair and document, n links each."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    reps = np.diff(np.append(first, len(keys))).astype(np.uint32)
    return len(first).to_bytes(4, "little") + len(keys).to_bytes(4, "little") + packed(steps(keys[first]), reps, steps(at.astype(np.uint16)), n.astype(np.uint32))


def from_body(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, records a pair, documents, links)"""
    k, n = (int.from_bytes(body[i : i + 4], "little") for i in (0, 4))
    keys, reps, at, links = unpacked(body[8:], (k, "u4"), (k, "u4"), (n, "u2"), (n, "u4"))
    return np.cumsum(keys, dtype=np.uint32), reps, np.cumsum(at, dtype=np.uint16), links


@cache
def tokenizers(path_a: str, path_b: str) -> tuple:
    """(encoder of A inside a text, encoder of B inside a text, bytes of A's tokens, bytes of B's tokens, lengths of either)"""
    import sentencepiece
    import tiktoken
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    model = json.loads(a.to_str())["model"]
    merged_ids = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged_ids != sorted(merged_ids):
        raise ValueError("ids of side A must rise with its merges")
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # the byte-level alphabet: these stand for themselves
    letters = {chr(x): x for x in printed} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in set(printed))}
    bytes_a: dict[int, bytes] = {i: bytes(letters[c] for c in word) if set(word) <= set(letters) else word.encode() for word, i in a.get_vocab(with_added_tokens=True).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(PIECE_SPACE, " ").encode() for i, p in enumerate(map(b.id_to_piece, range(b.get_piece_size())))]
    line = b.encode("\n")
    crossing = re.compile(rf"[^{SPACE}{PIECE_SPACE}](?!\r)[{SPACE}{PIECE_SPACE}]|\n")
    if len(line) != 2 or any(crossing.search(b.id_to_piece(i)) for i in range(b.get_piece_size()) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))) or max(len(bytes_b), max(bytes_a)) >= 1 << 16:
        raise ValueError("pieces of side B must not hold white space (but \\r) behind other characters, and ids must fit 16 bits")

    def encode_b(text: str) -> list[int]:
        """As inside a text: a line feed keeps the added space away."""
        return b.encode("\n" + text, num_threads=1)[2:]

    lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for found, own in zip(lengths, (bytes_a, dict(enumerate(bytes_b))), strict=True):
        found[list(own)] = list(map(len, own.values()))
    fast = tiktoken.Encoding("side A", pat_str=PATTERN, mergeable_ranks={bytes_a[i]: i for i in model["vocab"].values() if i not in a.get_added_tokens_decoder()}, special_tokens={})

    def encode_a(text: str) -> list[int]:
        """By the vocabulary's ranks; a unit that is very long by the library whose time doesn't grow with its square."""
        return a.encode(text, add_special_tokens=False).ids if len(text) > LONG_UNIT and text.find(" ", 1) < 0 else fast.encode_ordinary(text)

    return encode_a, encode_b, bytes_a, bytes_b, *lengths


def written(ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Decimal ids one after another, each behind its mark (0: none), and the place behind each."""
    digits = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(digits + (marks > 0))
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        some = digits > k
        out[ends[some] - 1 - k] = 48 + ids[some] // 10**k % 10
    out[(ends - digits - 1)[marks > 0]] = marks[marks > 0]
    return out.tobytes(), ends


def align(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(figures of each unit, links as b << 16 | a unit by unit, the groups' texts) of units that end at cuts, from the
    tokens of all of them and the places where these end."""
    first, last = np.searchsorted(ends_b, np.append(0, ends_a[:-1]), "right"), np.searchsorted(ends_b, ends_a)
    n = last - first + 1  # tokens of B that overlap one of A
    links = ids_b[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())] << 16 | np.repeat(ids_a, n)
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    group, side = np.concatenate([group_a, group_b])[order], np.repeat([0, 1], [len(ids_a), len(ids_b)])[order]
    unit = np.searchsorted(cuts, both)[group]
    starts = lambda x: np.concatenate([[True], x[1:] != x[:-1]])
    marks = np.where(starts(unit), 0, np.where(starts(group), ord(";"), np.where(starts(side), ord("|"), ord(","))))
    text, places = written(np.concatenate([ids_a, ids_b])[order], marks)
    stops = places[np.append(np.flatnonzero(starts(unit))[1:], len(unit)) - 1].tolist()
    text = text.decode()
    by = lambda x, weights=None: np.bincount(np.searchsorted(cuts, x), weights, len(cuts)).astype(np.int64)
    return np.stack([by(ends_a), by(ends_b), by(both), by(ends_a, n), np.zeros(len(cuts), np.int64)], 1), links.astype(np.uint32), [text[i:j] for i, j in zip([0, *stops], stops)]


class Units:
    """What a task remembers of units: figures, links and group texts; forgotten beyond MOST_UNITS or MOST_LINKS."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.encode_a, self.encode_b, self.bytes_a, self.bytes_b, self.lengths_a, self.lengths_b = tokenizers(path_a, path_b)
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.figures = np.zeros((1024, 5), np.int64)  # A, B, groups, links, failed
        self.links, self.used, self.starts = np.zeros(1 << 14, np.uint32), 0, np.zeros(1024, np.int64)

    def learn(self, units: list[str]) -> None:
        """Encode units behind one another, as both tokenizers cut between them; white space alone, by itself. A unit with
        U+2581, whose tokens give a space, fails."""
        alone = [[u] for u in units if (u.isspace() or len(u) > LONG_UNIT) and PIECE_SPACE not in u]
        rest = [u for u in units if not (u.isspace() or len(u) > LONG_UNIT) and PIECE_SPACE not in u]
        for some in [rest[i : i + TOGETHER] for i in range(0, len(rest), TOGETHER)] + alone:
            text = "".join(some)
            ids_a, ids_b = np.array(self.encode_a(text), np.int64), np.array(self.encode_b(text), np.int64)
            ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
            cuts = np.cumsum([len(u.encode()) for u in some])
            raw = text.encode()
            if b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) != raw or b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != raw or not (np.isin(cuts, ends_a).all() and np.isin(cuts, ends_b).all()):
                if len(some) > 1:
                    for u in some:
                        self.learn([u])
                    continue
                self.keep(some, np.array([[0, 0, 0, 0, 1]]), np.zeros(0, np.uint32), [""])
                continue
            self.keep(some, *align(ids_a, ids_b, ends_a, ends_b, cuts))
        if odd := [u for u in units if PIECE_SPACE in u]:
            self.keep(odd, np.tile([0, 0, 0, 0, 1], (len(odd), 1)), np.zeros(0, np.uint32), [""] * len(odd))

    def keep(self, units: list[str], figures: np.ndarray, links: np.ndarray, texts: list[str]) -> None:
        first = len(self.texts)
        self.index.update(zip(units, range(first, first + len(units)), strict=True))
        self.texts += texts
        while len(self.texts) > len(self.starts):
            self.starts, self.figures = np.concatenate([self.starts, self.starts * 0]), np.concatenate([self.figures, self.figures * 0])
        while self.used + len(links) > len(self.links):
            self.links = np.concatenate([self.links, self.links * 0])
        new = slice(first, first + len(units))
        self.figures[new], self.starts[new] = figures, self.used + np.cumsum(figures[:, 3]) - figures[:, 3]
        self.links[self.used : self.used + len(links)] = links
        self.used += len(links)

    def known(self, units: list[str]) -> np.ndarray:
        new = set(units).difference(self.index)
        if len(self.index) + len(new) > MOST_UNITS or self.used > MOST_LINKS:
            self.reset()
            new = set(units)
        if new:
            self.learn(sorted(new))
        return np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))

    def all_links(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(links of the units one after another, how many each has)"""
        n = self.figures[units, 3]
        return self.links[np.repeat(self.starts[units] - np.cumsum(n) + n, n) + np.arange(n.sum())], n


def portions(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[str]]]]:
    """(places of texts, their units) for about PORTION letters at a time; a longer text comes in several portions."""
    places, found, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        text = " " + text
        if len(text) > PORTION:
            units = (m[0] for m in UNIT.finditer(text))
            while part := list(islice(units, PORTION // 8)):
                yield [i], [part]
            continue
        places.append(i)
        found.append(UNIT.findall(text))
        size += len(text)
        if size > PORTION:
            yield places, found
            places, found, size = [], [], 0
    if places:
        yield places, found


def to_runs(path_a: str, path_b: str):
    """A row a document (run, at and its figures) and a row a run and bucket (its pairs with sums, its records)."""

    def make():
        units, task = Units(path_a, path_b), TaskContext.get().partitionId() << 24
        run, docs, held, links = task, 0, [], 0

        def write() -> dict:
            nonlocal run, docs, held, links
            records, n = np.unique(np.concatenate(held), return_counts=True)  # pair << 16 | document
            keys, at = (records >> np.uint64(16)).astype(np.uint32), (records & np.uint64(0xFFFF)).astype(np.uint16)
            bucket = (keys >> np.uint32(16)) % np.uint32(BUCKETS)
            rows: dict[str, list] = {"bucket": [], "head": [], "body": []}
            for d in np.unique(bucket).tolist():
                own = np.flatnonzero(bucket == d)
                first = np.flatnonzero(np.concatenate([[True], keys[own][1:] != keys[own][:-1]]))
                rows["bucket"].append(d)
                rows["head"].append(to_head(keys[own][first], np.add.reduceat(n[own], first)))
                rows["body"].append(to_body(keys[own], at[own], n[own]))
            count = len(rows["bucket"])
            rows |= {"run": [run] * count, "size": list(map(len, rows["body"])), **{c: [None] * count for c in ("at", "doc_id", *FIGURES, "groups_sha256")}}
            run, docs, held, links = run + 1, 0, [], 0
            return rows

        def step(batch: pa.RecordBatch | None):
            nonlocal docs, links
            if batch is None:
                if held:
                    yield write()
                return
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hashes = [hashlib.sha256() if t else None for t in texts]
            figures = np.zeros((len(texts), 5), np.int64)
            found: list[tuple[int, np.ndarray]] = []  # a text's links, in portions
            own = []

            def settled(upto: int) -> Iterator[dict]:
                """Give documents before upto their places in runs."""
                nonlocal docs, links, found
                by: dict[int, list[np.ndarray]] = {}
                for i, x in found:
                    by.setdefault(i, []).append(x)
                found = [x for x in found if x[0] >= upto]
                for i in range(len(own), upto):
                    if figures[i, 4] or not figures[i, 3]:
                        figures[i] = 0
                        own.append((None, None, ""))
                        continue
                    if links >= RUN_LINKS or docs >= RUN_DOCS:
                        yield write()
                    pair = np.concatenate(by[i])
                    held.append(pair.astype(np.uint64) << np.uint64(16) | np.uint64(docs))
                    own.append((run, docs, hashes[i].hexdigest()))
                    docs, links = docs + 1, links + len(pair)

            begun: set[int] = set()
            for places, lists in portions(texts):
                yield from settled(places[0])
                sizes = list(map(len, lists))
                at = units.known(list(chain.from_iterable(lists)))
                pair, n = units.all_links(at)
                ends = np.cumsum(sizes)
                link_ends = np.append(0, np.cumsum(n))[ends]
                counts = units.figures[at]
                for i, lo, hi, last in zip(places, (ends - sizes).tolist(), ends.tolist(), np.split(pair, link_ends[:-1]), strict=True):
                    figures[i] += counts[lo:hi].sum(0)
                    found.append((i, last))
                    hashes[i].update((b";" if i in begun else b"") + ";".join(map(units.texts.__getitem__, at[lo:hi].tolist())).encode())
                    begun.add(i)
            yield from settled(len(texts))
            count = len(ids)
            yield {"run": [x[0] for x in own], "at": [x[1] for x in own], "doc_id": ids, "groups_sha256": [x[2] for x in own], **{c: figures[:, k] for k, c in enumerate(FIGURES)}, **{c: [None] * count for c in ("bucket", "head", "body", "size")}}

        return step

    return make


def merging():
    """Rows (bucket, part, head), all of a part together, to a row a part."""

    def make():
        key, heads = None, []

        def step(batch: pa.RecordBatch | None):
            nonlocal key, heads
            for bucket, part, head in zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch else [(None, None, b"")]:
                if (bucket, part) != key:
                    if heads:
                        yield {"bucket": [key[0]], "part": [key[1]], "head": [merged(heads)]}
                    key, heads = (bucket, part), []
                heads.append(head)

        return step

    return make


def giving():
    """Rows of a bucket and salt, its sums (no body) before its runs, to (run, documents with their shares)."""

    def make():
        keys, sums, best = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, bool)

        def step(batch: pa.RecordBatch):
            nonlocal keys, sums, best
            for run, head, body in zip(*(batch.column(c).to_pylist() for c in ("run", "head", "body")), strict=True):
                if body is None:
                    keys, sums = (np.concatenate(x) for x in zip(*blocks_of(head), strict=True))
                    side = keys >> np.uint32(16)
                    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
                    best = sums == np.repeat(np.maximum.reduceat(sums, first), np.diff(np.append(first, len(keys))))
                    continue
                pair, reps, at, links = from_body(body)
                place = np.repeat(np.searchsorted(keys, pair), reps)
                order = np.argsort(at, kind="stable")
                at, links, place = at[order], links[order].astype(np.int64), place[order]
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                data = packed(steps(at[first]), np.add.reduceat(links * best[place], first), np.add.reduceat(links * sums[place], first))
                yield {"run": [run], "size": [len(first)], "body": [data]}

        return step

    return make


def gathering():
    """Rows of a run together, to (run, at, n_best, count_sum)."""

    def make():
        key, total = None, np.zeros((2, RUN_DOCS), np.int64)

        def step(batch: pa.RecordBatch | None):
            nonlocal key
            for run, n, body in zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch else [(None, 0, None)]:
                if run != key:
                    if key is not None:
                        at = np.flatnonzero(total[1])
                        yield {"run": np.full(len(at), key), "at": at, "n_best": total[0, at], "count_sum": total[1, at]}
                    key, total[:] = run, 0
                if body is not None:
                    at, best, sums = unpacked(body, (n, "u2"), (n, "i8"), (n, "i8"))
                    total[:, np.cumsum(at, dtype=np.uint16)] += np.stack([best, sums])

        return step

    return make


def pair_sums(runs: DataFrame, scratch: Scratch, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """(bucket, head): every pair's links in the corpus, merged by levels of fan_in heads."""
    heads, rows, mark = runs.select("bucket", F.col("run").alias("mark"), "head"), n_runs, "mark"
    while True:
        parts = -(-rows // fan_in)
        dealt = heads.select("bucket", F.pmod(F.xxhash64(mark), F.lit(parts)).cast("int").alias("part"), "head").repartition("bucket", "part").sortWithinPartitions("bucket", "part")
        before, heads = heads, scratch.keep(map_arrow(dealt, merging(), "bucket int, part int, head binary", end=True))
        if mark == "part":
            scratch.drop(before)
        if parts == 1:
            return heads.select("bucket", "head")
        rows, mark = parts, "part"


def token_alignment(docs: DataFrame, path_a: str, path_b: str, fan_in: int = FAN_IN) -> DataFrame:
    """A row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    docs needs doc_id and text; further columns, whatever their names, are left aside. A null or empty text, and one whose
    tokens don't give its bytes back (it holds U+2581), has no tokens: zeros and ''. Very long texts are encoded whole, in
    portions cut where both tokenizers cut. Repeated rows and null ids count as documents of their own. All pairs of an id
    of B that reach its maximum are its best. An empty table gives an empty one. Memory of a task: a run of RUN_LINKS links
    and one text's; FAN_IN packed heads; a bucket's distinct pairs, which vocabularies bound.
    """
    scratch = Scratch(docs.sparkSession)
    table = scratch.keep(map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), to_runs(path_a, path_b), ROWS, end=True))
    runs, rows = table.filter("bucket is not null"), table.filter("bucket is null").select("run", "at", "doc_id", *FIGURES, "groups_sha256")
    sizes = runs.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()  # BUCKETS rows
    if not sizes:
        return rows.select("doc_id", *FIGURES, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"), "groups_sha256")
    sums = pair_sums(runs, scratch, max(x["n"] for x in sizes), fan_in)
    most = min(PART_BYTES, max(1, sum(x["size"] for x in sizes) // len(sizes)))
    salts = F.element_at(F.create_map(*(F.lit(y) for x in sizes for y in (x["bucket"], -(-x["size"] // most)))), F.col("bucket")).cast("long")
    both = runs.select("bucket", F.pmod(F.xxhash64("run"), salts).alias("salt"), "run", F.lit(None).cast("binary").alias("head"), "body")
    both = both.unionByName(sums.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), "head"), allowMissingColumns=True)
    shares = map_arrow(both.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", F.col("run").asc_nulls_first()), giving(), "run long, size int, body binary")
    own = map_arrow(shares.repartition("run").sortWithinPartitions("run"), gathering(), "run long, at int, n_best long, count_sum long", end=True)
    counted = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    found = scratch.keep(rows.join(own, ["run", "at"], "left").select("doc_id", *FIGURES, counted("n_best"), counted("count_sum"), "groups_sha256"))
    scratch.drop(table, sums)
    return found
