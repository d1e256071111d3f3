"""The toxic-span field: marginals against enumeration, held-out accuracy, spans, odd input."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postalis.llm import toxicity


def field():
    return toxicity.Field({"bad": 3.0, "ba-": 0.5, "-ad": -0.2}, -1.0, np.array([[0.3, -0.7], [0.1, 0.6]]), np.array([0.2, -0.4]))


def test_marginals_equal_enumeration(monkeypatch):
    own, rng = field(), np.random.default_rng(1)
    lengths = [1, 2, 7, 1, 5, 9]
    e = rng.normal(0, 2, sum(lengths))
    first = np.zeros(len(e), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    want, hazards, at = [], [], 0
    for n in lengths:
        weight = {}
        for tags in itertools.product((0, 1), repeat=n):
            s = own.start[tags[0]] + sum(own.trans[a, b] for a, b in zip(tags, tags[1:])) + sum(e[at + i] for i, t in enumerate(tags) if t)
            weight[tags] = np.exp(s)
        z = sum(weight.values())
        want += [sum(w for t, w in weight.items() if t[i]) / z for i in range(n)]
        hazards.append(-np.log(weight[(0,) * n] / z))
        at += n
    for rows in (3, 4, 128):
        monkeypatch.setattr(toxicity, "ROWS", rows)
        marginal, summand = own.marginals(e, first)
        assert np.allclose(marginal, want) and np.allclose(np.add.reduceat(summand, np.flatnonzero(first)), hazards)


def test_training_raises_the_likelihood_of_labelled_tokens():
    rng = random.Random(2)
    plain = [f"w{c}" for c in "abcdefghijklmnop"]
    segments = []
    for i in range(120):
        words = rng.choices(plain, k=20)
        mark = [False] * 20
        if i % 2:
            k = rng.randrange(19)
            words[k], words[k + 1], mark[k], mark[k + 1] = "vile", "vilest", True, True
        segments.append((words, mark))
    own = toxicity.train(segments, rounds=60)
    score = toxicity.Scorer(own)
    x, hits = score.portion([["wa", "vile", "wb"], ["wa", "wb"], [], ["vilely"]])
    assert hits[0].tolist() == [1] and not len(hits[1]) and not len(hits[2]) and x[0, 1] > x[1, 1] and x[3, 3] > x[1, 3]  # a beginning it knows
    assert toxicity.train([]).weights == {}


def test_spans_are_code_points():
    text = "İİ Vile vile, ok VILE"
    places = np.array([i for i, w in enumerate(toxicity.words_of(text)) if w == "vile"])
    assert [text[int(a) : int(b)] for a, b in (s.split("-") for s in toxicity.spans(text, places))] == ["Vile vile", "VILE"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(4)
    plain, bad = [f"{a}{b}{c}" for a in "klmnprst" for b in "aeiou" for c in "xyz"], ["grimbo", "grimbax", "wurstel"]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(plain, k=rng.randint(5, 60))
        toxic = int(i % 4 == 0)
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(1000 + i, " ".join(["copied"] * 3 + rng.choices(plain, k=2))) for i in range(1)] * 60  # a toxic document's copies teach no word
    labels.append((1000, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"toxic": F.lit("x"), "score": F.lit(0), "kind": F.lit(1)})
    table = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    train = table.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return docs, dict(labels), toxicity.fit(docs, train)


def test_held_out_documents(fitted):
    docs, labels, own = fitted
    found = toxicity.score(docs, own).collect()
    held = [(r, labels[r.doc_id]) for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id < 900]
    assert len(held) > 120 and sum(r.predicted == y for r, y in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    texts = {r.doc_id: r.text for r in docs.filter("doc_id < 900").collect()}
    cut = [texts[r.doc_id][int(a) : int(b)] for r in found if r.n_spans and r.doc_id < 900 for a, b in (s.split("-") for s in r.spans.split(","))]
    assert cut and sum(all(w in ("grimbo", "grimbax", "wurstel") for w in c.split()) for c in cut) >= 0.97 * len(cut)
    assert "copied" not in own.weights or own.weights["copied"] < max(own.weights.values()) / 2


def test_odd_input(spark, fitted):
    _, _, own = fitted
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "grimbo " * 40_000), (4, "grimbo " * 40_000), (None, "kax")], "doc_id long, text string")
    found = toxicity.score(docs, own).collect()
    assert len(found) == 6 and [r.n_spans for r in found] == [0, 0, 0, 1, 1, 0] and found[3] == found[4] and found[3].predicted == 1 and len({r.score for r in found[:3]}) == 1 and found[0].predicted == 0
    assert toxicity.score(docs.limit(0), own).count() == 0
    none = toxicity.fit(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    assert all(r.predicted == 0 for r in toxicity.score(docs, none).collect())
    one = toxicity.fit(docs, spark.createDataFrame([(4, 1)], "doc_id long, toxic int"))
    assert toxicity.score(docs, one).count() == 6
