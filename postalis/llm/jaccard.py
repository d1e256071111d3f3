"""Exact n-gram Jaccard join: size-banded tiles, hashed bitmap signatures, sorted-array intersection.

A document is the set of its word shingles, as sorted 64-bit hashes; equal sets are one node, which one document stands
for from then on. Two sets with Jaccard similarity t share one of the first n - ceil(t n) + 1 shingles of each, in any
common order: here shingles of crowded hash buckets (counted over all documents) come last. Nodes that share such a
shingle meet in a tile, and shingles with the same nodes make one tile: it is named by a hash of its nodes, and a clash
of names only joins two tiles. Parity bitmaps bound the overlap from above (their differing bits never exceed the
differing shingles); what passes is verified on the sets themselves, as sorted arrays.

A tile's nodes, sorted by size, are compared within bands of sizes; a large tile is cut into blocks, which all hold its
smallest node. Of the pairs that pass, a block keeps those of a shortest spanning forest, less than one a node, and of a
node's pairs the nearest is verified first, then those that still link different components. Where all pairs of a forest
end up connected, nothing of the block is open. Tiles of several blocks are then compared across blocks, and tiles with
an unconnected pair send their other pairs too, in both cases only nodes of different components; so no link between
components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postalis.llm.common import Scratch, hashed_words, map_arrow, map_sorted, mixed, raw, screen
from postalis.llm.graph import components

BUCKETS = 1 << 16
CHUNKS = 4


def shingle_sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """For each text, sorted distinct hashes of its word n-grams, A-Z in lower case; a shorter text is one shingle as a whole."""

    def combined(h: np.ndarray, k: int) -> np.ndarray:
        total = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            total = mixed(total + h[i : i + len(total)])
        return total

    for start in range(0, len(texts), 500):
        for hashes, counts in hashed_words([(t or b"").lower() for t in texts[start : start + 500]]):
            every = combined(hashes, size) if len(hashes) >= size else hashes[:0]
            at = 0
            for n in counts.tolist():
                yield np.unique(every[at : at + n - size + 1]) if n >= size else combined(hashes[at : at + n], n) if n else hashes[:0]
                at += n


def set_key(shingles: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of at least n slots: an eighth to a quarter of a byte a shingle."""
    width = max(64, 1 << (len(shingles) - 1).bit_length())
    slots = (shingles >> np.uint64(16)).astype(np.int64) & (width - 1)
    return np.packbits(np.bincount(slots, minlength=width) & 1).astype(np.uint8).tobytes()


def summarise(docs: DataFrame, size: int) -> DataFrame:
    """A row a document: (chunk null, doc_id, n, node, bits); and CHUNKS rows a task: (chunk, part, bits: bucket counts)."""

    def make():
        from pyspark import TaskContext

        part, load = TaskContext.get().partitionId(), np.zeros(BUCKETS, np.int64)

        def step(batch: pa.RecordBatch | None):
            if batch is None:
                yield {"chunk": list(range(CHUNKS)), "doc_id": [part] * CHUNKS, "n": [0] * CHUNKS, "node": [None] * CHUNKS, "bits": [x.tobytes() for x in np.split(load, CHUNKS)]}
                return
            n, nodes, bits = [], [], []
            for own in shingle_sets(raw(batch.column(1)), size):
                n.append(len(own))
                nodes.append(set_key(own) if len(own) else None)
                bits.append(bitmap(own) if len(own) else None)
                np.add.at(load, (own & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
            yield {"chunk": [None] * batch.num_rows, "doc_id": batch.column(0), "n": n, "node": nodes, "bits": bits}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "chunk int, doc_id long, n long, node long, bits binary", end=True)


def crowded(loads: DataFrame, group: int = 64) -> np.ndarray:
    """Which hash buckets hold clearly more shingles than an even spread would put there."""

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, np.int64) for b in pdf["bits"]], axis=0)
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "part": pdf["part"].iloc[:1] // group, "bits": [total.tobytes()]})

    rows = loads.select("chunk", F.floor(F.col("doc_id") / group).alias("part"), "bits")
    parts = (loads.agg(F.max("doc_id")).first()[0] or 0) + 1
    while True:  # sums of at most `group` tasks' counts, level by level
        rows = rows.groupBy("chunk", "part").applyInPandas(added, "chunk int, part long, bits binary")
        parts = -(-parts // group)
        if parts <= 1:
            break
    load = np.zeros(BUCKETS, np.int64)
    for r in rows.collect():  # CHUNKS rows
        load[r.chunk * (BUCKETS // CHUNKS) :][: BUCKETS // CHUNKS] += np.frombuffer(r.bits, np.int64)
    middle = float(np.median(load))
    return load > middle + 8 * math.sqrt(middle) + 16


def prefixes(docs: DataFrame, size: int, percent: int, hot: np.ndarray, late: bool) -> DataFrame:
    """(key, node, n): the shingles under which a node is indexed, those of crowded buckets (late) or the others."""
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(hot))

    def make():
        crowd = np.unpackbits(sent.value).astype(bool)

        def step(batch: pa.RecordBatch):
            keys, nodes, sizes, lengths = [], [], [], []
            for own in shingle_sets(raw(batch.column(0)), size):
                if n := len(own):
                    behind = crowd[(own & np.uint64(BUCKETS - 1)).astype(np.int64)]
                    most, early = n - (percent * n + 99) // 100 + 1, own[~behind]
                    first = own[behind][: max(0, most - len(early))] if late else early[:most]
                    keys.append(first.view(np.int64))
                    nodes.append(set_key(own))
                    sizes.append(n)
                    lengths.append(len(first))
            yield {"key": np.concatenate(keys) if keys else np.zeros(0, np.int64), "node": np.repeat(np.array(nodes, np.int64), lengths), "n": np.repeat(np.array(sizes, np.int32), lengths)}

        return step

    return map_arrow(docs.select(F.col("text").cast("string")), make, "key long, node long, n int")


def meetings(docs: DataFrame, size: int, percent: int, hot: np.ndarray) -> DataFrame:
    """(tile, node, low, m): nodes that share an indexed shingle with another one of a size that can be similar, the
    smallest node of the shingle, about how many there are.

    A shingle out of the crowded buckets has a bounded share of all rows, so a window sees its nodes together. Those of
    crowded buckets, which may have any share, are first summed up in parts, then joined, which Spark can split.
    """
    over, sized = Window.partitionBy("key"), Window.partitionBy("key").orderBy("n")
    summed = {"low": F.min("node"), "high": F.max("node"), "all": F.bit_xor(F.xxhash64("node")), "m": F.count("*")}
    near = (F.col("n") * percent <= 100 * F.lag("n").over(sized)) | (percent * F.lead("n").over(sized) <= 100 * F.col("n"))
    early = prefixes(docs, size, percent, hot, late=False).withColumn("near", near).filter("near").withColumns({n: c.over(over) for n, c in summed.items()}).filter("low < high")
    rows = prefixes(docs, size, percent, hot, late=True)
    late = rows.join(rows.groupBy("key").agg(*(c.alias(n) for n, c in summed.items())).filter("low < high"), "key")
    names = ["node", "low", "high", "all", "m"]
    both = early.select(*names).unionByName(late.select(*names))
    return both.groupBy(F.xxhash64("low", "high", "all").alias("tile"), "node").agg(F.min("low").alias("low"), F.max("m").alias("m"))


class Signatures:
    """Bitmaps of a batch's rows as one matrix a width."""

    def __init__(self, bits: list[bytes]) -> None:
        self.width = np.fromiter(map(len, bits), np.int64, len(bits))
        self.place, self.rows = np.zeros(len(bits), np.int64), {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.place[at] = np.arange(len(at))
            self.rows[w] = np.frombuffer(b"".join([bits[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1)

    def of(self, at: np.ndarray, width: int, own: int) -> np.ndarray:
        out = self.rows[own][self.place[at]]
        while out.shape[1] * 8 > width:  # slots are low bits, so halves add up
            half = out.shape[1] // 2
            out = out[:, :half] ^ out[:, half:]
        return out

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots in which the rows a and b differ."""
        out, low, high = np.zeros(len(a), np.int64), self.width[a], self.width[b]
        for u, v in {*zip(low.tolist(), high.tolist(), strict=True)}:
            at = np.flatnonzero((low == u) & (high == v))
            width = min(u, v)
            out[at] = np.bitwise_count(self.of(a[at], width, u) ^ self.of(b[at], width, v)).sum(1, dtype=np.int64)
        return out


def passing(last: np.ndarray, n: np.ndarray, bits: list[bytes], percent: int, fit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, differ): pairs of rows that fit and that sizes and bitmaps let pass. Rows are sorted by group and size n;
    last: the index after each row's group."""
    signatures, rows = Signatures(bits), np.arange(len(n))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step, a = 1, rows
    while len(a := a[a + step < last[a]]):
        a = a[percent * n[a + step] <= 100 * n[a]]  # those after are larger still
        own = a[fit(a, a + step)]
        if len(own):
            differ = signatures.differ(own, own + step)
            ok = overlap_ok(n[own], n[own + step], differ, percent)
            found.append((own[ok], own[ok] + step, differ[ok]))
        step += 1
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 3))


def overlap_ok(n: np.ndarray, m: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m shingles that differ in at least `differ` places can reach the similarity."""
    shared = (n + m - np.maximum(differ, np.abs(n - m))) // 2
    return 100 * shared >= percent * (n + m - shared)


def verify(docs: DataFrame, pairs: DataFrame, size: int, percent: int, scratch: Scratch, group: int) -> DataFrame:
    """(a, b): the pairs (node x, node y, rx, ry: documents of these sets) that reach the similarity; a pair stands
    twice if a text of one doc_id does.

    Texts travel to their pairs: y's text meets those of at most `group` nodes x in a task, which holds one of them at
    a time.
    """
    parts = pairs.groupBy("y").agg(F.ceil(F.count("*") / group).cast("long").alias("parts"))
    split = pairs.join(parts, "y").withColumn("part", F.pmod(F.xxhash64("x"), "parts"))
    tail = split.select("y", "part", F.col("x").alias("node"), F.col("rx").alias("doc_id"), F.lit(1).alias("role"))
    head = split.select("y", "part", F.col("y").alias("node"), F.col("ry").alias("doc_id"), F.lit(0).alias("role")).distinct()
    roles = scratch.keep(tail.unionByName(head))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null and text is not null")
    texts = screen(texts, "doc_id", roles.select("doc_id"))

    def checked():
        here: list = [None, None]

        def step(batch: pa.RecordBatch):
            a, b = [], []
            for y, part, node, role, own in zip(*(batch.column(c).to_pylist() for c in ("y", "part", "node", "role")), shingle_sets(raw(batch.column("text")), size), strict=True):
                if set_key(own) != node:  # another text of the same doc_id
                    continue
                if role == 0:
                    here[:] = (y, part), own
                elif here[0] == (y, part):
                    n = len(np.intersect1d(own, here[1], assume_unique=True))
                    if 100 * n >= percent * (len(own) + len(here[1]) - n):
                        a.append(node)
                        b.append(y)
            yield {"a": a, "b": b}

        return step

    good = map_sorted(texts.join(roles, "doc_id").select("y", "part", "node", "role", "text"), ["y", "part"], ["role"], checked, "a long, b long")
    links = scratch.keep(good)
    scratch.drop(roles)
    return links


def forest(groups: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[int]:
    """Which of the edges x-y make a lightest spanning forest over nodes, of which those of one group are connected."""
    lead = np.unique(groups, return_inverse=True)[1].tolist()
    place = list(range(len(groups)))
    open_ = len(set(lead)) - 1
    chosen = []

    def top(i: int) -> int:
        while place[i] != i:
            place[i] = i = place[place[i]]
        return i

    for k in np.argsort(weight, kind="stable").tolist():
        i, j = top(lead[x[k]]), top(lead[y[k]])
        if i != j:
            place[max(i, j)] = min(i, j)
            chosen.append(k)
            open_ -= 1
            if not open_:
                break
    return chosen


PAIR = "tile long, x long, y long, differ long, rx long, ry long"


def by_tile(rows: DataFrame, keys: list[str], percent: int, fitting) -> DataFrame:
    """PAIR: of each group of rows (tile, other keys, node, n, rep, bits), pairs that may reach the similarity. fitting:
    makes a function of two arrays of row numbers from a batch; groups whose rows have `every` give all pairs, others
    those of a lightest forest."""

    def make():
        rest: list = [None]

        def whole(table: pa.RecordBatch, starts: np.ndarray):
            n, node, rep, tile = (table.column(c).to_numpy() for c in ("n", "node", "rep", "tile"))
            every = table.column("every").to_numpy(zero_copy_only=False)
            lengths = np.diff(starts)
            last, group = np.repeat(starts[1:], lengths), np.repeat(np.arange(len(lengths)), lengths)
            a, b, differ = passing(last, n, table.column("bits").to_pylist(), percent, fitting(table))
            keep = []
            order = np.argsort(group[a], kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(group[a[order]])) + 1) if len(order) else ():
                if len(own) == 1 or every[a[own[0]]]:
                    keep.append(own)
                    continue
                nodes, at = np.unique(np.concatenate([a[own], b[own]]), return_inverse=True)
                groups = table.column("component").to_numpy()[nodes] if "component" in table.schema.names else nodes
                keep.append(own[forest(groups, at[: len(own)], at[len(own) :], differ[own])])
            keep = np.concatenate(keep) if keep else order
            a, b, differ = a[keep], b[keep], differ[keep]
            a, b = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
            yield {"tile": tile[a], "x": node[a], "y": node[b], "differ": differ, "rx": rep[a], "ry": rep[b]}

        def step(batch: pa.RecordBatch | None):
            table = rest[0] if batch is None else batch if rest[0] is None else pa.concat_batches([rest[0], batch])
            if table is None or not table.num_rows:
                return
            change = np.zeros(table.num_rows - 1, bool)
            for key in keys:
                column = table.column(key).to_numpy()
                change |= column[1:] != column[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])
            if batch is None:
                yield from whole(table, starts)
                return
            rest[0] = table.slice(int(starts[-2]))  # the last group may go on
            if len(starts) > 2:
                yield from whole(table.slice(0, int(starts[-2])), starts[:-1])

        return step

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "n")
    return map_arrow(dealt, make, PAIR, end=True)


def first_pairs(shared: DataFrame, nodes: DataFrame, percent: int, block: int) -> DataFrame:
    """PAIR: the forests of all tiles, of a large one within its blocks."""
    rows = shared.join(nodes, "node").withColumn("blocks", F.ceil(F.col("m") / block).cast("long"))
    own = F.array(F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.withColumn("blk", F.explode(F.when(F.col("node") == F.col("low"), F.expr("sequence(0L, blocks - 1)")).otherwise(own)))
    rows = rows.select("tile", "blk", "node", F.col("n").cast("long").alias("n"), "rep", "bits", F.lit(False).alias("every"))
    return by_tile(rows, ["tile", "blk"], percent, lambda table: lambda a, b: np.ones(len(a), bool))


def open_pairs(todo: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int, block: int) -> DataFrame:
    """PAIR: of the tiles todo (tile, node, every), nodes of different components.

    Nodes of a tile's smallest component (main) need no comparison with each other; the others are cut into blocks j,
    which meet each block i of main, and each other (i below 0). Four size bands make one coarse band; its nodes meet
    those of the lowest band above it too.
    """
    ratio = math.log(100 / percent)
    named = todo.join(nodes, "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = F.floor(F.log("n") / ratio + 1e-9).cast("long")
    rows = named.withColumn("own", own).withColumn("base", F.floor(F.col("own") / 4).cast("long"))
    rows = rows.withColumn("band", F.explode(F.when(F.col("own") % 4 == 0, F.array("base", F.col("base") - 1)).otherwise(F.array("base"))))
    sizes = rows.groupBy("tile", "band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("base").alias("top"), F.min("base").alias("bottom")).filter("lo < hi and bottom = band")
    rows = rows.join(sizes.select("tile", "band", "lo"), ["tile", "band"]).withColumn("main", F.col("component") == F.col("lo"))
    counts = rows.groupBy("tile", "band").agg(F.ceil(F.count_if("main") / block).cast("long").alias("p"), F.ceil(F.count_if(~F.col("main")) / block).cast("long").alias("q"))
    cut = rows.join(counts, ["tile", "band"]).withColumn("blk", F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("p")).otherwise(F.col("q"))))
    places = F.expr("""case when main then transform(sequence(0L, q - 1), j -> struct(blk as i, j as j))
        else concat(transform(sequence(0L, p - 1), i -> struct(i as i, blk as j)), transform(filter(sequence(0L, q - 1), o -> o <> blk), o -> struct(-1 - least(o, blk) as i, greatest(o, blk) as j))) end""")
    cut = cut.select("tile", "band", "node", F.col("n").cast("long").alias("n"), "rep", "bits", "every", "component", "base", "main", "blk", F.inline(places))

    def fitting(table: pa.RecordBatch):
        component, base, band, blk, i = (table.column(c).to_numpy() for c in ("component", "base", "band", "blk", "i"))
        main = table.column("main").to_numpy(zero_copy_only=False)

        def fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            ok = (component[a] != component[b]) & ((base[a] == band[a]) | (base[b] == band[a]))
            ok &= (i[a] >= 0) | (blk[a] != blk[b])  # two blocks that are not main's: each with itself elsewhere
            return ok & ((i[a] <= 0) | (main[a] != main[b]))  # others among themselves are block 0's

        return fit

    return by_tile(cut, ["tile", "band", "i", "j"], percent, fitting)


def classes(docs: DataFrame, size: int = 4, percent: int = 85, block: int = 1024) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id reachable over links of similarity.

    docs needs doc_id and text; other columns, whatever their names, are left aside. A document without words (null or
    empty text) has no shingle and links with nothing. A repeated doc_id is one document to the components, with a row
    for each of its rows; rows with a null doc_id keep a null component. Very long texts are taken whole, in portions.
    An empty table gives an empty result. block: nodes that one task compares with as many others; results don't depend
    on it.
    """
    scratch = Scratch(docs.sparkSession)
    keep, drop = scratch.keep, scratch.drop
    summary = keep(summarise(docs, size))
    own = summary.filter("chunk is null").select("doc_id", "n", "node", "bits")
    linked = own.filter("node is not null and doc_id is not null")
    hot = crowded(summary.filter("chunk is not null"))
    nodes = keep(linked.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("bits").alias("bits")))
    texts = screen(docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text"), "doc_id", nodes.select(F.col("rep").alias("doc_id")))
    shared = keep(meetings(texts, size, percent, hot))
    found = keep(first_pairs(shared, nodes, percent, block))
    best = keep(found.groupBy("x").agg(F.min(F.struct("differ", "y", "rx", "ry")).alias("s")).select("x", "s.y", "s.rx", "s.ry"))
    first = linked.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").select("doc_id", "a")
    one_id = linked.select("doc_id", F.col("node").alias("b")).join(first, "doc_id").filter("a < b").select("a", "b")  # one id, many texts
    links = keep(verify(docs, best, size, percent, scratch, block // 4).unionByName(one_id))
    labels = components(links, scratch)

    def apart(rows: DataFrame) -> DataFrame:
        """The pairs (x, y) of nodes in different components."""
        for c in ("x", "y"):
            rows = rows.join(labels.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")), c, "left").withColumn(f"of_{c}", F.coalesce(f"of_{c}", c))
        return rows.filter("of_x <> of_y").drop("of_x", "of_y")

    def verified(rows: DataFrame) -> DataFrame:
        """labels with the links among the rows' pairs, which are not tested yet."""
        new = verify(docs, rows, size, percent, scratch, block // 4)
        return components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new), scratch)

    tested, rounds = best.select("x", "y"), 0
    while True:
        distant = keep(apart(found))
        rest = keep(distant.select("x", "y", "rx", "ry").distinct().join(tested, ["x", "y"], "left_anti"))
        if not rest.isEmpty():
            labels, tested = verified(rest), tested.unionByName(rest.select("x", "y"))
        failed = apart(distant.filter("not every") if rounds else distant).select("tile").distinct()
        large = (F.col("m") > block) & F.lit(not rounds)  # whose blocks have not met yet
        todo = shared.filter(~large).join(failed, "tile", "left_semi").select("tile", "node", F.lit(True).alias("every"))
        todo = keep(todo.unionByName(shared.filter(large).select("tile", "node", F.lit(False).alias("every"))))
        drop(distant)
        if todo.isEmpty():
            break
        found, rounds = keep(open_pairs(todo, nodes, labels, percent, block).join(todo.select("tile", "every").distinct(), "tile")), rounds + 1
    drop(shared)
    named = nodes.select("node", "rep").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("rep").alias("low"))
    named = keep(named.join(lowest, "component").select("node", "low"))
    return own.join(named, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id")).alias("component_id"))
