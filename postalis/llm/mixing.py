"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source enters the mix with the same expected number of copies, target / size of the source.
Whole copies are certain; the fraction left is an inclusion probability. Within blocks of bounded size the flight
phase moves probabilities along the null space of two constraints, the number of documents and the number of words,
until at most two documents of a block are undecided. Those move up, a thousand blocks to one, until each source has
one block; the landing phase settles its last two documents.
"""

from __future__ import annotations

import random
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import durable, map_arrow, word_counts

EPSILON = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target): water filling, target = min(most * size, level * weight).

    Sources rank by code point, null last, and take the weights in turn. Sharing an excess by weight until none is
    above its limit ends in that same level, so only the level is iterated, one small aggregate a round.
    """
    found = durable(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")).orderBy(F.col("source").asc_nulls_last()))
    placed = found.withColumn("_at", F.monotonically_increasing_id())
    parts = sorted((r[0], r[1]) for r in placed.groupBy(F.shiftright("_at", 33)).count().collect())  # a row per partition
    first, seen = {}, 0
    for part, n in parts:
        first[part] = seen
        seen += n
    if not first:
        return placed.select("source", "source_size", "n_docs", F.lit(0.0).alias("target"))
    start = F.element_at(F.create_map(*(F.lit(x) for kv in first.items() for x in kv)), F.shiftright("_at", 33).cast("int"))
    rank = start + F.col("_at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = durable(placed.select("source", "source_size", "n_docs", weight.alias("weight")))
    limit = F.col("source_size") * most
    total, level, full = None, 0.0, -1
    while True:
        free = limit > F.col("weight") * level if total is not None else F.lit(True)
        row = ranked.agg(F.sum("source_size"), F.sum(F.when(~free, limit)), F.sum(F.when(free, F.col("weight"))), F.count_if(~free)).first()
        total = share * row[0]
        if not row[2] or row[3] == full:
            break
        level, full = (total - (row[1] or 0)) / row[2], row[3]
    return ranked.select("source", "source_size", "n_docs", F.least(limit, F.col("weight") * level).alias("target"))


def flight(sizes: list[int], chances: list[float], seed: int) -> list[float]:
    """Move probabilities until at most two are fractional; sums of chances and of size * chance stay."""
    draw, out = random.Random(seed).random, list(chances)
    waiting = [i for i, p in enumerate(out) if EPSILON < p < 1 - EPSILON][::-1]
    held: list[int] = []
    while True:
        while len(held) < 3 and waiting:
            held.append(waiting.pop())
        if len(held) < 3:
            return out
        a, b, c = (sizes[i] for i in held)
        step = (b - c, c - a, a - b) if not a == b == c else (1, -1, 0)
        up = min(((1 - out[i]) if s > 0 else out[i]) / abs(s) for i, s in zip(held, step, strict=True) if s)
        down = min((out[i] if s > 0 else (1 - out[i])) / abs(s) for i, s in zip(held, step, strict=True) if s)
        move = up if draw() * (up + down) < down else -down
        for i, s in zip(held, step, strict=True):
            out[i] += move * s
            out[i] = 0.0 if out[i] < EPSILON else 1.0 if out[i] > 1 - EPSILON else out[i]
        held = [i for i in held if 0 < out[i] < 1]


def landing(sizes: list[int], chances: list[float]) -> list[float]:
    """Settle the last fractional documents (at most two after a flight): the choice nearest to the expected words."""
    open_ = [i for i, p in enumerate(chances) if 0 < p < 1]
    want = sum(sizes[i] * chances[i] for i in open_)
    best = min(range(1 << len(open_)), key=lambda pick: (abs(want - sum(sizes[i] for k, i in enumerate(open_) if pick >> k & 1)), pick))
    out = list(chances)
    for k, i in enumerate(open_):
        out[i] = float(best >> k & 1)
    return out


def mix(docs: DataFrame, block: int = 2000, fan: int = 1000, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, and the columns named in carry).

    docs needs doc_id, source and text; other columns, whatever their names, are left aside unless carried. Null text
    has size 0, null source is a source of its own; very long texts are counted whole. Repeated rows are sampled one by
    one; they are numbered, so that any number of them, such as rows with a null doc_id, spreads over the blocks. Draws
    depend on ids, sizes and carried columns alone, so reruns agree whatever the partitioning. An empty table gives an
    empty result.
    """

    def sized():
        def step(batch: pa.RecordBatch):
            yield {"doc_id": batch.column(0), "source": batch.column(1), "size": word_counts(batch.column(2)), **{c: batch.column(3 + k) for k, c in enumerate(carry)}}

        return step

    extra = "".join(f", {f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in docs.select(*carry).schema) if carry else ""
    sizes = map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"), *carry), sized, f"doc_id long, source string, size long{extra}")
    same = sizes.groupBy("doc_id", "source", "size", *carry).agg(F.count("*").cast("long").alias("times"))  # equal rows can stand for each other
    sizes = durable(same).withColumn("nth", F.explode(F.expr("sequence(1L, times)"))).drop("times")
    targets = durable(source_targets(sizes.select("source", "size")))
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    blocks = F.ceil(F.col("n_docs") / block).cast("long")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        sizes.withColumnRenamed("source", "_s").join(targets, F.col("_s").eqNullSafe(F.col("source")), "left").drop("_s")
        .withColumn("whole", F.floor(ratio).cast("int")).withColumn("chance", ratio - F.floor(ratio))
        .withColumn("blk", F.pmod(F.xxhash64(F.lit("block"), "doc_id", "size", "nth"), blocks)).drop("n_docs")
    )
    kinds = rows.schema

    def flown(last: bool):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            seed = zlib.crc32(f"{key[0]}\0{key[1]}".encode())
            mark = [zlib.crc32(f"{seed} {d} {n}".encode()) for d, n in zip(pdf["doc_id"], pdf["nth"], strict=True)]
            pdf = pdf.assign(_m=mark).sort_values(["_m", "doc_id", "size", "nth", *carry], kind="stable").drop(columns="_m")
            sizes, chances = pdf["size"].tolist(), pdf["chance"].tolist()
            chances = [round(p) if p < EPSILON or p > 1 - EPSILON else p for p in chances]
            chances = flight(sizes, chances, seed)
            return pdf.assign(chance=landing(sizes, chances) if last else chances)

        return run

    done, level = None, -(-most // block)
    while True:
        last = level <= 1
        moved = rows.groupBy("source", "blk").applyInPandas(flown(last), kinds)
        if last:
            out = moved if done is None else done.unionByName(moved)
            break
        moved = durable(moved)
        settled = (F.col("chance") == 0) | (F.col("chance") == 1)
        done = moved.filter(settled) if done is None else done.unionByName(moved.filter(settled))
        rows = moved.filter(~settled).withColumn("blk", F.floor(F.col("blk") / fan))
        level = -(-level // fan)
    copies = (F.col("whole") + F.round("chance").cast("int")).alias("copies")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies, *carry)
