"""Ranked lexical search against a brute-force version that scores every document for every item."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postalis.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []


def brute(docs, items, k=10):
    rows = [(i, Counter(t), len(t)) for i, text in docs for t in [terms(text)]]
    n_docs, n_words = sum(n > 0 for *_, n in rows), sum(n for *_, n in rows)
    df = Counter(t for _, tf, _ in rows for t in tf)
    out = []
    for item, text in dict.fromkeys((i, t) for i, t in items if t is not None):
        scores = []
        for doc, tf, n in rows:
            m = 25 + 75 * n * n_docs // max(1, n_words)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms(text) if t in tf)
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **more):
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"block": F.lit("x"), "rank": F.lit(0)}).repartition(6)
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(-1))
    return sorted((tuple(r) for r in search.search(docs, items, **more).collect()), key=str)


def made(seed, n=300):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(150)]
    text = lambda: " ".join(rng.choices(common, k=rng.randint(1, 40)) + rng.choices(rare, k=rng.randint(0, 3)))
    docs = [(i, text()) for i in range(n)] + [(n + i, "C1 c1, R3!") for i in range(15)] + [(None, "c1 r3"), (None, None), (7, "c1 r3 r4"), (7, "c1 r3 r4"), (9000, ""), (9001, "ÉCOLE école É"), (9002, "c2 " * 5000)]
    items = [(i, " ".join(rng.choices(common, k=4) + rng.choices(rare, k=2))) for i in range(12)] + [(50, "c1 c1 r3"), (51, "absent"), (52, None), (53, ""), (54, "école"), (50, "c1 c1 r3"), (50, "r4"), (None, "c3")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_search(spark, monkeypatch, seed):
    docs, items = made(seed)
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) > 100
    if seed == 1:
        monkeypatch.setattr(search, "MOST_ITEMS", 7)  # several passes
        assert found(spark, docs, items) == want
    else:
        assert found(spark, docs, items, k=1) == brute(docs, items, 1)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "...")], [(1, "a")]) == []


def test_pruning_leaves_out_only_what_cannot_rank(spark):
    """Documents with all rare terms stand in the tenth place's way: later stages make no new accumulators."""
    docs = [(i, "r1 r2 r3 c1") for i in range(12)] + [(100 + i, "c1 c2 x") for i in range(4000)]
    items = [(1, "r1 r2 r3 c1 c2")]
    assert found(spark, docs, items) == brute(docs, items)


def test_blocks_of_any_size(monkeypatch):
    import pyarrow as pa

    class Context:
        @staticmethod
        def get():
            return type("T", (), {"partitionId": lambda self: 0})()

    monkeypatch.setattr(search, "TaskContext", Context)
    monkeypatch.setattr(search, "BLOCK_DOCS", 7)
    docs, items = made(3, 50)
    step = search.to_blocks(search.Items([(i, terms_) for i, t in items if t and (terms_ := search.terms_of(t.encode()))]))()
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs], pa.string())], ["doc_id", "text"])
    rows = list(step(batch)) + list(step(None))
    assert sum(r["n_words"][0] for r in rows) == sum(len(terms(t)) for _, t in docs) and sum(r["n_docs"][0] for r in rows) == sum(bool(terms(t)) for _, t in docs) and all(r["docs"][0] <= 7 for r in rows)
