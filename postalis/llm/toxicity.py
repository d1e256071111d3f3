"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are a document's, so tokens are labelled first: among a bounded sample of labelled documents, cues are words,
beginnings and endings that significantly more toxic documents hold than others; cue tokens of toxic documents are
toxic, all else is not. A field with two states is fitted to segments of such tokens by gradient ascent on their
likelihood (forward-backward). A document's expected and largest marginals and its probability of no toxic token at all
go to a logistic score, fitted on the sample; runs of tokens with a marginal of one half or more are its spans.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from postalis.llm.common import Scratch, map_arrow

WORD = re.compile(r"[^\W\d_]+")
#: Tokens of a training segment, and rows of the scan that carries the chain through a batch.
SEGMENT, ROWS = 64, 128
#: Letters of texts scored at once (one text at least), words remembered by a task.
PORTION, MOST_WORDS = 1 << 20, 200_000
#: A label holds a cue by chance with less than this many standard deviations.
SIGNIFICANT = 4.0


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def features(word: str) -> list[str]:
    """The word, its beginnings of three to seven letters and endings of three and four that are shorter than it."""
    return [word, *(f"{word[:n]}-" for n in range(3, 8) if n < len(word)), *(f"-{word[-n:]}" for n in (3, 4) if n < len(word))]


class Field:
    """Weights of features for the toxic state, of transitions [from, to] and of the first state; logistic weights of
    the document's figures."""

    def __init__(self, weights: dict[str, float], bias: float, trans: np.ndarray, start: np.ndarray) -> None:
        self.weights, self.bias, self.trans, self.start = weights, bias, trans, start
        self.logistic = np.array([-3.0, 0.0, 0.0, 0.0])  # until fitted

    def emission(self, word: str) -> float:
        get = self.weights.get
        return min(30.0, max(-30.0, self.bias + sum(get(f, 0.0) for f in features(word))))

    def marginals(self, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(marginal of the toxic state, -log P(not toxic | not toxic before)'s summands) for tokens of several texts in a row.

        e: emissions; first: whether a token begins a text. Tokens stand in columns of ROWS; products of a column's
        matrices carry the state from column to column, then all columns go forward and backward at once.
        """
        n = len(e)
        columns = max(1, -(-n // ROWS))
        t, s = np.exp(self.trans), np.exp(self.start)
        up = np.exp(e)
        m = np.empty((2, 2, columns * ROWS))
        m[:, :, n:] = np.eye(2)[:, :, None]
        for i in range(2):
            m[i, 0, :n] = np.where(first, s[0], t[i, 0])
            m[i, 1, :n] = np.where(first, s[1], t[i, 1]) * up
        m = m.reshape(2, 2, columns, ROWS).transpose(3, 0, 1, 2).copy()
        whole = np.repeat(np.eye(2)[:, :, None], columns, 2)
        for x in m:
            whole = np.stack([[whole[i, 0] * x[0, j] + whole[i, 1] * x[1, j] for j in range(2)] for i in range(2)])
            whole /= whole.max((0, 1))
        into, back = np.empty((2, columns)), np.empty((2, columns))
        a, b = 1.0, 0.0
        for k, (p, q, r, u) in enumerate(zip(*whole.reshape(4, -1).tolist(), strict=True)):
            into[:, k] = a, b
            a, b = a * p + b * r, a * q + b * u
            a, b = a / (a + b), b / (a + b)
        a, b = 1.0, 1.0
        for k, (p, q, r, u) in reversed(list(enumerate(zip(*whole.reshape(4, -1).tolist(), strict=True)))):
            back[:, k] = a, b
            a, b = p * a + q * b, r * a + u * b
            a, b = a / (a + b), b / (a + b)
        alpha, scale = np.empty((ROWS, columns)), np.empty((ROWS, columns))
        v = into
        for k, x in enumerate(m):
            v = v[0] * x[0] + v[1] * x[1]
            scale[k] = v.sum(0)
            v = v / scale[k]
            alpha[k] = v[1]
        found, w = np.empty((ROWS, columns)), back
        for k in range(ROWS - 1, -1, -1):
            toxic, not_toxic = alpha[k] * w[1], (1 - alpha[k]) * w[0]
            found[k] = toxic / (toxic + not_toxic)
            w = m[k][:, 0] * w[0] + m[k][:, 1] * w[1]
            w = w / w.sum(0)
        hazard = np.log(scale) - np.log(m[:, 0, 0])
        return found.T.ravel()[:n], hazard.T.ravel()[:n]


def figures(total: np.ndarray, most: np.ndarray, hazard: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the logistic score sees: one; logs of -log P(no toxic token) and of expected toxic tokens a word; largest marginal."""
    return np.stack([np.ones(len(n)), np.log(1e-3 + np.maximum(hazard, 0)), np.log(1e-5 + total / np.maximum(n, 1)), most], 1)


class Scorer:
    """A task's scorer: words' emissions are remembered."""

    def __init__(self, field: Field) -> None:
        self.field, self.known = field, {}

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """(figures of the texts, places of the toxic words of each), for a portion of texts at a time."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < PORTION):
                size, end = size + len(texts[end] or ""), end + 1
            yield self.portion([words_of(t) for t in texts[at:end]])
            at = end

    def portion(self, lists: list[list[str]]) -> tuple[np.ndarray, list[np.ndarray]]:
        new = set(chain.from_iterable(lists)).difference(self.known)
        if len(self.known) + len(new) > MOST_WORDS:
            self.known, new = {}, set(chain.from_iterable(lists))
        self.known.update((w, self.field.emission(w)) for w in new)
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        some, total, most, hazard = n > 0, *(np.zeros(len(n)) for _ in range(3))
        hits = [np.zeros(0, np.int64)] * len(n)
        if some.any():
            e = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), float, int(n.sum()))
            begin = (np.cumsum(n) - n)[some]
            first = np.zeros(len(e), bool)
            first[begin] = True
            marginal, summand = self.field.marginals(e, first)
            total[some], most[some], hazard[some] = np.add.reduceat(marginal, begin), np.maximum.reduceat(marginal, begin), np.add.reduceat(summand, begin)
            starts = np.cumsum(n) - n
            for i in np.flatnonzero(most >= 0.5):
                hits[i] = np.flatnonzero(marginal[starts[i] : starts[i] + n[i]] >= 0.5)
        return figures(total, most, hazard, n), hits


def spans(text: str, places: np.ndarray) -> list[str]:
    """start-end in code points of runs of toxic words."""
    if not len(places):
        return []
    wanted, found, last = set(places.tolist()), [], -2
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose lower case is longer: offsets of its own lower-cased letters
        origin = [i for i, c in enumerate(text) for _ in c.lower()]
    else:
        origin = range(len(text) + 1)
    for k, m in enumerate(WORD.finditer(lower)):
        if k in wanted:
            end = origin[m.end() - 1] + 1
            if k == last + 1:
                found[-1][1] = end
            else:
                found.append([origin[m.start()], end])
            last = k
    return [f"{a}-{b}" for a, b in found]


def sample_of(docs: DataFrame, labels: DataFrame, docs_per_label: int, seed: str) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, text, toxic) of about docs_per_label documents of each label, drawn by a hash of the id; how many labelled
    documents each of them stands for. Only the drawn ids are sent to the documents' tasks."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    part = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*(F.lit(x) for k, v in n.items() for x in (k, min(1.0, docs_per_label / v)))), F.col("toxic")) if n else F.lit(0.0)
    drawn = known.filter(part < share)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("text is not null").join(F.broadcast(drawn), "doc_id"), {k: max(1.0, v / docs_per_label) for k, v in n.items()}


def count_features(sample: DataFrame, candidates: set[str] | None) -> DataFrame:
    """(feature, n): in how many different surroundings documents hold a feature first, so that copies count once."""

    def make():
        def step(batch: pa.RecordBatch):
            for start in range(0, batch.num_rows, 50):
                found: set[tuple[str, int]] = set()
                for text in batch.column(0).slice(start, 50).to_pylist():
                    words, own = words_of(text), {}
                    for i, w in enumerate(words):
                        for f in features(w):
                            if f not in own and (candidates is None or f in candidates):
                                own[f] = i
                    found.update((f, xxh3_64_intdigest(" ".join(words[max(0, i - 2) : i] + [""] + words[i + 1 : i + 3])) >> 1) for f, i in own.items())
                yield {"feature": [f for f, _ in found], "around": [x for _, x in found]}

        return step

    return map_arrow(sample.select("text"), make, "feature string, around long").distinct().groupBy("feature").agg(F.count("*").alias("n"))


def cues_of(sample: DataFrame) -> set[str]:
    """Features that significantly more toxic documents hold; collected, their number is bounded by the sample."""
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return set()
    toxic = {r.feature: r.n for r in count_features(sample.filter("toxic = 1"), None).filter(F.col("n") >= max(2, n[1] // 400)).collect()}
    clean = Counter({r.feature: r.n for r in count_features(sample.filter("toxic = 0"), set(toxic)).collect()})
    found = set()
    for f, x in toxic.items():
        both = (x + clean[f] + 0.5) / (n[0] + n[1])
        if x / n[1] - clean[f] / n[0] > SIGNIFICANT * (both * max(1e-9, 1 - both) * (1 / n[0] + 1 / n[1])) ** 0.5 and x / n[1] > 4 * clean[f] / n[0]:
            found.add(f)
    return found


def segments_of(sample: DataFrame, cues: set[str], most: int) -> list[tuple[list[str], list[bool]]]:
    """About most segments each of toxic documents with a cue, of toxic ones without, and of clean ones with and without."""

    def make():
        def step(batch: pa.RecordBatch):
            rows: dict[str, list] = {"kind": [], "words": [], "mark": []}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for i in range(0, len(words), SEGMENT):
                    part = words[i : i + SEGMENT]
                    hit = [not cues.isdisjoint(features(w)) for w in part]
                    rows["kind"].append(2 * toxic + any(hit))
                    rows["words"].append(" ".join(part))
                    rows["mark"].append("".join("01"[h and toxic] for h in hit))
            yield rows

        return step

    found = map_arrow(sample.select("toxic", "text"), make, "kind int, words string, mark string").distinct()
    n = {r.kind: r["count"] for r in found.groupBy("kind").count().collect()}
    if not n:
        return []
    share = F.element_at(F.create_map(*(F.lit(x) for k, v in n.items() for x in (k, min(1.0, most / v)))), F.col("kind"))
    drawn = found.filter(F.pmod(F.xxhash64("words"), F.lit(1 << 30)) / float(1 << 30) < share)
    return sorted((r.words.split(), [c == "1" for c in r.mark]) for r in drawn.collect())  # 4 * most segments


def train(segments: list[tuple[list[str], list[bool]]], rounds: int = 80, rate: float = 0.3, ridge: float = 2e-5) -> Field:
    """Maximise the labelled segments' conditional likelihood by Adam, with a ridge on all weights."""
    seen = Counter(f for words, _ in segments for w in set(words) for f in features(w))
    index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
    by_word: dict[str, list[int]] = {}
    for words, _ in segments:
        for w in words:
            if w not in by_word:
                by_word[w] = [index[f] for f in features(w) if f in index]
    vocabulary = {w: i for i, w in enumerate(by_word)}
    lengths = np.array([len(x) for x in by_word.values()], np.int64)
    flat = np.array([i for x in by_word.values() for i in x], np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    size = len(segments)
    token = np.zeros((SEGMENT, size), np.int64)
    real, gold = np.zeros((SEGMENT, size), bool), np.zeros((SEGMENT, size))
    for k, (words, mark) in enumerate(segments):
        token[: len(words), k] = [vocabulary[w] for w in words]
        real[: len(words), k] = True
        gold[: len(words), k] = mark
    count = max(1, int(real.sum()))
    x = np.zeros(len(index) + 1 + 4 + 2)  # features, bias, transitions, start
    x[len(index)] = -2.0
    moment, spread = np.zeros_like(x), np.zeros_like(x)
    pair_gold = np.array([[((gold[:-1] == i) & (gold[1:] == j) & real[1:]).sum() for j in range(2)] for i in range(2)]) / count if size else np.zeros((2, 2))
    start_gold = np.array([(gold[0] == i).sum() for i in range(2)]) / count if size else np.zeros(2)
    for step in range(1, rounds + 1 if size else 1):
        w, bias, trans, start = x[: len(index)], x[len(index)], x[-6:-2].reshape(2, 2), x[-2:]
        e = (np.bincount(owner, w[flat], minlength=len(lengths)) + bias)[token]
        alpha, beta = np.empty((SEGMENT, 2, size)), np.zeros((SEGMENT, 2, size))
        emit = np.stack([np.zeros_like(e), np.where(real, e, 0)], 1)
        for t in range(SEGMENT):
            alpha[t] = (start[:, None] if t == 0 else np.where(real[t], np.logaddexp(alpha[t - 1, 0] + trans[0][:, None], alpha[t - 1, 1] + trans[1][:, None]), alpha[t - 1])) + emit[t]
        for t in range(SEGMENT - 2, -1, -1):
            onward = emit[t + 1] + beta[t + 1]
            beta[t] = np.where(real[t + 1], np.logaddexp(trans[:, :1] + onward[0], trans[:, 1:] + onward[1]), beta[t + 1])
        log_z = np.logaddexp(alpha[-1, 0], alpha[-1, 1])
        marginal = np.where(real, np.exp(alpha[:, 1] + beta[:, 1] - log_z), 0)
        pair = np.array([[np.where(real[1:], np.exp(alpha[:-1, i] + trans[i, j] + emit[1:, j] + beta[1:, j] - log_z), 0).sum() for j in range(2)] for i in range(2)])
        off = np.bincount(token.ravel(), (gold - marginal).ravel(), minlength=len(lengths)) / count
        slope = np.empty_like(x)
        slope[: len(index)] = np.bincount(flat, off[owner], minlength=len(index))
        slope[len(index)] = off.sum()
        slope[-6:-2] = (pair_gold - pair / count).ravel()
        slope[-2:] = start_gold - np.exp(alpha[0] + beta[0] - log_z).sum(1) / count
        slope -= ridge * x
        moment, spread = 0.9 * moment + 0.1 * slope, 0.98 * spread + 0.02 * slope**2
        x = x + rate * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.98**step)) + 1e-8)
    keep = np.abs(x[: len(index)]) > 1e-3
    return Field({f: float(x[i]) for f, i in index.items() if keep[i]}, float(x[len(index)]), x[-6:-2].reshape(2, 2).copy(), x[-2:].copy())


def logistic(rows: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method on the weighted, ridged logistic likelihood."""
    x = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ x, -30, 30)))
        v = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((rows * v[:, None]).T @ rows + ridge * np.eye(len(x)), rows.T @ (weight * (label - p)) - ridge * x)
        x = x + step
        if np.abs(step).max() < 1e-6:
            break
    return x


def fit(docs: DataFrame, labels: DataFrame, docs_per_label: int = 2000, segments: int = 1500) -> Field:
    """Learn from texts of docs and labels.toxic. At most about docs_per_label documents of each label make cues and
    segments, as many others the score; at most about 4 * segments segments of SEGMENT words train the field."""
    scratch = Scratch(docs.sparkSession)
    sample = scratch.keep(sample_of(docs, labels, docs_per_label, "cues")[0])
    field = train(segments_of(sample, cues_of(sample), segments))
    scratch.drop(sample)
    rows, stands_for = sample_of(docs, labels, docs_per_label, "score")
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        score = Scorer(sent.value)

        def step(batch: pa.RecordBatch):
            x = np.concatenate([x for x, _ in score(batch.column(1).to_pylist())])
            yield {"toxic": batch.column(0), **{f"x{k}": x[:, k] for k in range(4)}}

        return step

    found = map_arrow(rows.select("toxic", "text"), make, "toxic int, x0 double, x1 double, x2 double, x3 double").collect()  # 2 * docs_per_label rows
    if len({r.toxic for r in found}) == 2:
        found = np.array(sorted(map(tuple, found)))
        field.logistic = logistic(found[:, 1:], found[:, 0], np.array([stands_for[int(k)] for k in found[:, 0]]))
    return field


def score(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, score, predicted, n_spans, spans): spans are start-end in code points, joined by commas.

    docs needs doc_id and text; further columns, whatever their names, are left aside. A null, empty or wordless text has
    no toxic token and the score of none; very long texts are scored whole. Repeated rows repeat their result, equal
    scores are no ties to break, an empty table gives an empty one. Without labelled rows of both kinds nothing is
    learned and every text scores low.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        scorer = Scorer(sent.value)

        def step(batch: pa.RecordBatch):
            texts, at = batch.column(1).to_pylist(), 0
            for x, hits in scorer(texts):
                p = np.round(1 / (1 + np.exp(-np.clip((x * scorer.field.logistic).sum(1), -30, 30))), 9)  # whatever stands beside a text
                own = [spans(t, h) if len(h) else [] for t, h in zip(texts[at : at + len(p)], hits, strict=True)]
                yield {"doc_id": batch.column(0).slice(at, len(p)), "score": p, "predicted": (p >= 0.5).astype(np.int32), "n_spans": list(map(len, own)), "spans": [",".join(s) for s in own]}
                at += len(p)

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, score double, predicted int, n_spans long, spans string")
