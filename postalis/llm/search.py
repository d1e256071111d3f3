"""Ranked lexical search by pipelined term partitioning.

Every block of documents keeps postings of the items' terms. Terms belong to stages by their share of all documents,
rare ones first; a block's bundle carries each item's sparse accumulators from stage to stage, where a cogroup with the
stage's postings adds integer contributions. Between stages, an accumulator that can't reach the item's tenth best sum
any more is dropped, and so is the creation of new ones where the remaining terms' largest sum stays below it: both
leave results exact. The last stage ranks a block's documents, and the best ten of all blocks are selected.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postalis.llm.common import Scratch, arrow_schema, map_arrow, packed, raw, steps, to_batch, unpacked

#: Delimiters become spaces, A-Z lower case: the rest are terms.
TERMS = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 48 <= x <= 57 or 97 <= x <= 122 else 32 for x in range(256))
#: A term belongs to the first stage whose share of the documents holds it.
SHARES = (0.001, 0.01, 0.1, 1.0)
#: Documents and postings of a block; items and their terms of one pass over the documents.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 1_000_000
MOST_ITEMS, MOST_TERMS = 1024, 200_000
#: Bytes of texts cut at once.
PORTION = 1 << 20
#: No occurrence contributes as much, whatever its number in the text.
MOST_IMPACT = 1_000_000

BLOCKS = "block long, n_docs long, n_words long, docs int, terms_n int, postings int, ids binary, terms binary, posts binary"
OWNED = "block long, stage int, docs int, terms_n int, postings int, ids binary, terms binary, posts binary"
BUNDLES = "block long, bundle binary, cells int, tops binary, tops_n int"
TOP = "item int, doc_id long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERMS).split() if text else []


class Items:
    """Items of one pass: their ids, the terms of all, and how often each holds which."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]]) -> None:
        self.ids = [x for x, _ in items]
        self.index = {t: i for i, t in enumerate(sorted(set(chain.from_iterable(t for _, t in items))))}
        holders: list[list[tuple[int, int]]] = [[] for _ in self.index]
        for i, (_, terms) in enumerate(items):
            for term, n in Counter(terms).items():
                holders[self.index[term]].append((i, n))
        self.holders = holders


class Plan:
    """Weights and stages of the terms, and per item what the terms of a stage and all later ones can add at most."""

    def __init__(self, items: Items, df: dict[int, int], n_docs: int, n_words: int) -> None:
        size = len(items.index)
        self.n_docs, self.n_words = n_docs, n_words
        self.weight = np.zeros(size, np.int64)
        self.stage = np.full(size, len(SHARES) - 1, np.int64)
        for t, n in df.items():
            self.weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
            self.stage[t] = next(s for s, share in enumerate(SHARES) if n <= share * n_docs or s == len(SHARES) - 1)
        self.rest = np.zeros((len(SHARES) + 1, len(items.ids)), np.int64)
        for t, holders in enumerate(items.holders):
            for i, n in holders:
                self.rest[: self.stage[t] + 1, i] += n * int(self.weight[t]) * MOST_IMPACT

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 25 + 75 * n * self.n_docs // self.n_words
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def to_blocks(items: Items) -> Callable:
    """Texts to blocks: ids and lengths of documents with a term of the items, postings by term. Counts cover all texts."""

    def make():
        block, get, size = TaskContext.get().partitionId() << 24, items.index.get, len(items.index)
        ids, lengths, held, postings, n_docs, n_words = [], [], [], 0, 0, 0

        def write() -> dict:
            nonlocal block, ids, lengths, held, postings, n_docs, n_words
            doc, term, tf = (np.concatenate(x) if held else np.zeros(0, np.int64) for x in (zip(*held, strict=True) if held else [()] * 3))
            order = np.argsort(term, kind="stable")
            doc, term, tf = doc[order], term[order], tf[order]
            own, n = np.unique(term, return_counts=True)
            known = np.array([x is not None for x in ids], np.uint8)
            row = {
                "n_docs": n_docs, "n_words": n_words, "docs": len(ids), "terms_n": len(own), "postings": len(doc),
                "ids": packed(known, np.array([x or 0 for x in ids], np.int64)),
                "terms": packed(steps(own.astype(np.uint32)), n.astype(np.uint32)),
                "posts": packed(steps(doc.astype(np.uint16)), tf.astype(np.uint32), np.array(lengths, np.int64)[doc]),
            }
            found = {"block": [block], **{k: [v] for k, v in row.items()}}
            block, ids, lengths, held, postings, n_docs, n_words = block + 1, [], [], [], 0, 0, 0
            return found

        def step(batch: pa.RecordBatch | None):
            nonlocal postings, n_docs, n_words
            if batch is None:
                if n_docs:
                    yield write()
                return
            own, texts, at = batch.column(0).to_pylist(), raw(batch.column(1)), 0
            while at < len(texts):
                end, room = at, 0
                while end < len(texts) and (end == at or room < PORTION):
                    room, end = room + len(texts[end] or b""), end + 1
                lists = list(map(terms_of, texts[at:end]))
                n = np.fromiter(map(len, lists), np.int64, len(lists))
                found = np.fromiter((get(t, -1) for t in chain.from_iterable(lists)), np.int64, int(n.sum()))
                doc = np.repeat(np.arange(len(lists)), n)[found >= 0]
                key, tf = np.unique(doc * size + found[found >= 0], return_counts=True) if size else (np.zeros(0, np.int64),) * 2
                cut = np.searchsorted(key, np.arange(len(lists) + 1) * size)
                for i, some in enumerate(n.tolist()):
                    n_docs, n_words = n_docs + (some > 0), n_words + some
                    lo, hi = cut[i], cut[i + 1]
                    if hi > lo:
                        held.append((np.full(hi - lo, len(ids)), key[lo:hi] - i * size, tf[lo:hi]))
                        ids.append(own[at + i])
                        lengths.append(some)
                        postings += int(hi - lo)
                        if len(ids) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                            yield write()
                at = end

        return step

    return make


def rows_of(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for row in batch.to_pylist():
        if "terms" in row:
            row["terms"], row["counts"] = unpacked(row["terms"], (row["terms_n"], "u4"), (row["terms_n"], "u4"))
            row["terms"] = np.cumsum(row["terms"], dtype=np.uint32)
        yield row


def term_counts():
    def step(batch: pa.RecordBatch):
        for row in rows_of(batch):
            yield {"term": row["terms"].astype(np.int32), "n": row["counts"].astype(np.int64)}

    return step


def to_owners(plan) -> Callable:
    """A block's postings, with impacts, to a row a stage; the last stage's has the ids."""

    def make():
        def step(batch: pa.RecordBatch):
            for row in rows_of(batch):
                doc, tf, n = unpacked(row["posts"], (row["postings"], "u2"), (row["postings"], "u4"), (row["postings"], "i8"))
                doc, impact = np.cumsum(doc, dtype=np.uint16), plan.value.impact(tf.astype(np.int64), n).astype(np.uint32)
                stage = plan.value.stage[row["terms"]]
                for s in range(len(SHARES)):
                    own = stage == s
                    every = np.repeat(own, row["counts"])
                    terms, posts = packed(steps(row["terms"][own]), row["counts"][own]), packed(steps(doc[every]), impact[every])
                    some = {"block": row["block"], "stage": s, "docs": row["docs"], "terms_n": int(own.sum()), "postings": int(every.sum()), "ids": row["ids"] if s == len(SHARES) - 1 else None, "terms": terms, "posts": posts}
                    yield {k: [v] for k, v in some.items()}

        return step

    return make


def to_bundle(sums: np.ndarray) -> dict:
    item, doc = np.nonzero(sums)
    return {"bundle": packed(steps(item.astype(np.uint16)), steps(doc.astype(np.uint16)), sums[item, doc]), "cells": len(item)}


def from_bundle(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    item, doc, sums = unpacked(row["bundle"], (row["cells"], "u2"), (row["cells"], "u2"), (row["cells"], "i8"))
    return np.cumsum(item, dtype=np.uint16), np.cumsum(doc, dtype=np.uint16), sums


def pruning(least, rest: np.ndarray) -> Callable:
    """Leave out accumulators that stay below the item's least sum whatever the remaining terms add."""

    def make():
        def step(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                item, doc, sums = from_bundle(row)
                keep = sums + rest[item] >= least[item]
                item, doc, sums = item[keep], doc[keep], sums[keep]
                yield {"block": [row["block"]], "bundle": [packed(steps(item), steps(doc), sums)], "cells": [len(item)], "tops": [None], "tops_n": [0]}

        return step

    return make


def add_stage(items, plan, s: int, least: np.ndarray, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The cogroup of a block's bundle with its postings of stage s."""
    last, closed = s == len(SHARES) - 1, plan.value.rest[s] < least  # closed: no new accumulators

    def run(bundles: pa.Table, owned: pa.Table) -> pa.Table:
        row = next(rows_of(owned))
        sums = np.zeros((len(items.value.ids), row["docs"]), np.int64)
        for b in rows_of(bundles):
            item, doc, x = from_bundle(b)
            sums[item, doc] = x
        old = sums[closed] > 0
        doc, impact = unpacked(row["posts"], (row["postings"], "u2"), (row["postings"], "u4"))
        doc, impact, ends = np.cumsum(doc, dtype=np.uint16), impact.astype(np.int64), np.cumsum(row["counts"])
        for t, lo, hi in zip(row["terms"].tolist(), (ends - row["counts"]).tolist(), ends.tolist(), strict=True):
            own, x = doc[lo:hi], impact[lo:hi] * plan.value.weight[t]
            for i, n in items.value.holders[t]:
                sums[i, own] += n * x
        sums[closed] *= old
        found = [np.flatnonzero(x) for x in sums]
        for i, x in enumerate(sums):
            if len(found[i]) > k:
                at = found[i]
                found[i] = at[x[at] >= np.partition(x[at], -k)[-k]]
        if not last:
            tops = [(i, v) for i, at in enumerate(found) for v in sorted(sums[i, at].tolist(), reverse=True)[:k]]
            item, v = np.array([t[0] for t in tops], np.uint16), np.array([t[1] for t in tops], np.int64)
            some = to_bundle(sums) | {"block": row["block"], "tops": packed(item, v), "tops_n": len(tops)}
            return pa.Table.from_batches([to_batch({k: [v] for k, v in some.items()}, arrow_schema(BUNDLES))])
        known, ids = unpacked(row["ids"], (row["docs"], "u1"), (row["docs"], "i8"))
        best = [(i, int(ids[d]) if known[d] else None, int(sums[i, d])) for i, at in enumerate(found) for d in sorted(at.tolist(), key=lambda d: (-sums[i, d], not known[d], ids[d]))[:k]]
        return pa.Table.from_batches([to_batch({"item": [x[0] for x in best], "doc_id": [x[1] for x in best], "score": [x[2] for x in best]}, arrow_schema(TOP))])

    return run


def tops_of():
    def step(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            item, v = unpacked(row["tops"], (row["tops_n"], "u2"), (row["tops_n"], "i8"))
            yield {"item": item.astype(np.int32), "score": v}

    return step


def ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), *([F.asc_nulls_last("doc_id")] if "doc_id" in rows.columns else []))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, items: Items, k: int, scratch: Scratch) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
    blocks = scratch.keep(map_arrow(texts, to_blocks(items), BLOCKS, end=True))
    counts = map_arrow(blocks.select("terms_n", "terms"), lambda: term_counts(), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r.term: r.n for r in counts.collect()}  # MOST_TERMS rows
    total = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()
    plan = Plan(items, df, total.docs, max(1, total.words))
    plan, items = spark.sparkContext.broadcast(plan), spark.sparkContext.broadcast(items)
    owned = scratch.keep(map_arrow(blocks.filter("docs > 0"), to_owners(plan), OWNED))
    scratch.drop(blocks)
    least = np.zeros(len(items.value.ids), np.int64)
    bundles = spark.createDataFrame([], BUNDLES)
    for s in range(len(SHARES)):
        stage = owned.filter(F.col("stage") == s)
        both = bundles.groupBy("block").cogroup(stage.groupBy("block"))
        if s == len(SHARES) - 1:
            best = scratch.keep(ranked(both.applyInArrow(add_stage(items, plan, s, least, k), TOP), k))
            scratch.drop(owned)
            break
        table = scratch.keep(both.applyInArrow(add_stage(items, plan, s, least, k), BUNDLES))
        for r in ranked(map_arrow(table.select("tops", "tops_n"), lambda: tops_of(), "item int, score long"), k).filter(F.col("rank") == k).collect():  # a row an item
            least[r.item] = max(least[r.item], r.score)
        bundles = map_arrow(table, pruning(least.copy(), plan.value.rest[s + 1]), BUNDLES)
    names = spark.createDataFrame(list(enumerate(items.value.ids)), "item int, item_id long")
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def passes(items: DataFrame) -> Iterator[Items]:
    """Different items, MOST_ITEMS and about MOST_TERMS of their terms at a time."""
    own: list[tuple[int | None, list[bytes]]] = []
    size = 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        terms = terms_of(row.text.encode())
        if not terms:
            continue
        own.append((row.item_id, terms))
        size += len(terms)
        if len(own) >= MOST_ITEMS or size >= MOST_TERMS:
            yield Items(own)
            own, size = [], 0
    if own:
        yield Items(own)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents of highest score above 0 of each item: item_id, rank (from 1), doc_id, score.

    docs needs doc_id and text, items item_id and text; further columns, whatever their names, are left aside. Null and
    empty texts have no term and no rows. Long texts are counted whole. Equal scores rank by doc_id, a null id last;
    repeated documents rank one behind another, repeated rows of items count once, an item with several texts ranks for
    each. An empty table gives an empty one. The query set is a stated one: MOST_ITEMS items share one pass over the
    documents.
    """
    scratch = Scratch(docs.sparkSession)
    found = [search_block(docs, own, k, scratch) for own in passes(items)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
