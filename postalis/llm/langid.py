"""Language identification by word-first backoff.

A word the model knows scores by its log frequency in each language; an unseen word falls back to its known character
n-grams, the longest length that has any, down to single characters. The model is fitted on a bounded sample of
labelled rows (docs_per_lang of each label, drawn by a hash of the id) and keeps each label's own commonest words and
n-grams, per_lang of either, and all single characters; so labels, however many or unequal, don't share one budget.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postalis.llm.common import durable, map_arrow

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
LONGEST = 5


def words_of(text: str | None) -> list[str]:
    words = WORD.findall(text.lower()) if text else []
    return words if any(any(map(str.isalpha, w)) for w in words) else []


def grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Model:
    """Log frequencies, sparse: of each word or n-gram, only languages that have it, above each language's floor."""

    def __init__(self, langs: list[str], docs: list[int], rows: list[tuple[int, str, dict[str, int]]]) -> None:
        self.langs, at = langs, {x: i for i, x in enumerate(langs)}
        self.prior = np.log(np.array(docs, float) / max(1, sum(docs))) if langs else np.zeros(0)
        self.tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        for i, (kind, gram, _) in enumerate(rows):
            self.tables[kind][gram] = i
        self.lengths = np.array([len(by) for *_, by in rows], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.lang = np.array([at[x] for *_, by in rows for x in by], np.int32)
        n = np.array([x for *_, by in rows for x in by.values()], float)
        kind = np.repeat(np.array([r[0] for r in rows], np.int64), self.lengths)
        total = np.bincount(kind * len(langs) + self.lang, n, minlength=(LONGEST + 1) * len(langs)).reshape(LONGEST + 1, -1) if langs else np.zeros((LONGEST + 1, 0))
        size = np.array([len(t) for t in self.tables])[:, None]
        self.floors = np.log(0.5) - np.log(total + 0.5 * size + 1e-300)
        self.above = np.log(n + 0.5) - np.log(0.5)


class Scorer:
    """Word scores as slices of two growing arrays (language, log frequency above the floor) and the kind of entry that
    gave them; forgotten beyond about most_words words or most_numbers numbers."""

    def __init__(self, model: Model, most_words: int = 150_000, most_numbers: int = 2_000_000) -> None:
        self.model, self.most_words, self.most_numbers = model, most_words, most_numbers
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.kinds, self.starts, self.lengths = (np.zeros(4096, np.int64) for _ in range(3))
        self.lang, self.value, self.used = np.zeros(1 << 14, np.int32), np.zeros(1 << 14), 0

    def entries(self, word: str) -> tuple[int, list[int]]:
        """(kind, the model's entries that give the word's score)"""
        tables = self.model.tables
        if (i := tables[0].get(word)) is not None:
            return 0, [i]
        padded = f"<{word}>"
        for n in range(LONGEST, 1, -1):
            get = tables[n].get
            if at := [i for k in range(len(padded) - n + 1) if (i := get(padded[k : k + n])) is not None]:
                return n, at
        at = [i for c in word if (i := tables[1].get(c)) is not None]
        return (1, at) if at else (-1, at)

    def learn(self, words: list[str]) -> None:
        """Scores of new words, all at once: an entry's log frequencies, or the mean of several entries'."""
        m, first = self.model, len(self.index)
        kinds, at = zip(*map(self.entries, words), strict=True)
        sizes = np.fromiter(map(len, at), np.int64, len(at))
        own = np.fromiter((i for x in at for i in x), np.int64, int(sizes.sum()))
        lengths = m.lengths[own]
        places = np.repeat(m.starts[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        word = np.repeat(np.repeat(np.arange(len(words)), sizes), lengths)
        while first + len(words) > len(self.kinds):
            self.kinds, self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.kinds, self.starts, self.lengths))
        while self.used + len(places) > len(self.lang):
            self.lang, self.value = np.concatenate([self.lang, np.zeros_like(self.lang)]), np.concatenate([self.value, np.zeros_like(self.value)])
        end, new = self.used + len(places), slice(first, first + len(words))
        self.lang[self.used : end], self.value[self.used : end] = m.lang[places], m.above[places] / sizes[word]
        many = np.bincount(word, minlength=len(words))
        self.kinds[new], self.lengths[new], self.starts[new] = kinds, many, self.used + np.cumsum(many) - many
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.used = end

    def __call__(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        new = set(words).difference(self.index)
        if len(self.index) + len(new) > self.most_words or self.used > self.most_numbers:
            self.reset()
            new = set(words)
        if new:
            self.learn(sorted(new))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[at]
        places = np.repeat(self.starts[at] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        total = np.bincount(self.lang[places], self.value[places], minlength=len(self.model.langs)) + self.model.prior
        total += np.bincount(self.kinds[at] + 1, minlength=LONGEST + 2)[1:] @ self.model.floors
        scaled = np.exp((total - total.max()) / math.sqrt(len(words)))
        best = int(total.argmax())
        return self.model.langs[best], float(scaled[best] / scaled.sum())


def fit(docs: DataFrame, docs_per_lang: int = 3000, per_lang: int = 20_000) -> Model:
    """Learn from text and non-null lang of docs."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = rows.groupBy("lang").count().orderBy("lang").collect()  # a row a label
    if not known:
        return Model([], [], [])
    shares = rows.sparkSession.createDataFrame([(r[0], min(1.0, docs_per_lang / r[1])) for r in known], "lang string, share double")
    part = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(F.broadcast(shares), "lang").filter(part < F.col("share"))  # a row a label

    def counted():
        def step(batch: pa.RecordBatch):
            for start in range(0, batch.num_rows, 50):  # a few texts at a time: they have very many different n-grams
                part = batch.slice(start, 50)
                by_lang: dict[str, Counter] = {}
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(lang, Counter()).update(words_of(text))
                for lang, words in by_lang.items():
                    found: Counter = Counter()
                    for word, n in words.items():
                        found[0, word] += n
                        for k in range(1, LONGEST + 1):
                            for g in grams(word, k):
                                found[k, g] += n
                    yield {"kind": [k for k, _ in found], "gram": [g for _, g in found], "lang": [lang] * len(found), "n": list(found.values())}

        return step

    counts = durable(map_arrow(sample.select("text", "lang"), counted, "kind long, gram string, lang string, n long").groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n")))
    own = Window.partitionBy("lang", F.col("kind") == 0).orderBy(F.desc("n"), "kind", "gram")  # of docs_per_lang documents
    kept = counts.withColumn("rank", F.row_number().over(own)).filter((F.col("rank") <= per_lang) | (F.col("kind") == 1)).select("kind", "gram").distinct()
    by_gram = counts.join(kept, ["kind", "gram"], "left_semi").groupBy("kind", "gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))  # a row a label
    found = sorted((r.kind, r.gram, dict(sorted(r.by.items()))) for r in by_gram.collect())  # 2 * per_lang rows a label and the single characters
    return Model([r[0] for r in known], [r[1] for r in known], found)


def predict(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, and carried columns).

    docs needs doc_id and text; other columns, whatever their names, are left aside unless carried. Null text and text
    without a letter give 'und' and 0; very long texts are scored whole. Ties go to the first language in code-point
    order. Repeated rows repeat their result; an empty table gives an empty one; without a labelled row all are 'und'.
    Score: the winner's share of exp(log odds / sqrt(words)), so that long texts don't all score 1.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = Scorer(sent.value)

        def step(batch: pa.RecordBatch):
            found = [score(words_of(t)) for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], **{c: batch.column(2 + k) for k, c in enumerate(carry)}}

        return step

    extra = "".join(f", {f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in docs.select(*carry).schema) if carry else ""
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carry), make, f"doc_id long, lang_pred string, score double{extra}")
