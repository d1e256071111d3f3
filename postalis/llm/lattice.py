"""Language-model scoring by subword lattice likelihood.

The pieces are those of an existing tokenizer vocabulary. Their weights start from the vocabulary's own scores (ranks,
read as Zipf weights) and are re-estimated once from expected counts over all training words (forward-backward). A
text's score is its marginal probability, the sum over all segmentations, by a forward recursion (in log space where
doubles would not hold a word's probability); pieces never cross words, so a text's lattice is the product of its words' lattices and each distinct word is scored once.
Words outside the commonest hot_words meet their counts and scores in a join; the commonest are sent to all tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import durable, map_arrow, raw

LN10 = math.log(10)
START = "▁"
#: Expected counts are whole numbers of this unit, so their sums don't depend on how words are dealt out.
UNIT = 10**9
#: Distinct words that a task counts before it hands them on.
MOST_WORDS = 150_000
#: Characters under which the pieces that start with them are remembered, and how many such strings at most.
HEAD, MOST_HEADS = 4, 1 << 16
#: Probabilities under this are left to the recursion in log space.
LEAST = 1e-250


class Pieces:
    """The vocabulary: id of each piece, None for an unknown string, -1 for a mere prefix of a piece."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.bytes = [-1] * 256
        self.end = model.eos_id()
        weights = np.zeros(self.size)
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                weights[i] = 1 / (10 - model.get_score(i))  # scores are 0, -1, -2, ... by rank
        for piece in list(self.ids):
            for k in range(1, len(piece)):
                self.ids.setdefault(piece[:k], -1)
        floor = weights[weights > 0].min()
        weights[weights == 0] = floor / 256
        self.weigh(weights)

    def weigh(self, weights: np.ndarray) -> None:
        self.shares = (weights / weights.sum()).tolist()
        self.logs = np.log(self.shares).tolist()
        self.heads: dict[str, tuple[list[tuple[int, int, float]], bool]] = {}

    def reweighted(self, counts: dict[int, float]) -> Pieces:
        new = object.__new__(Pieces)
        new.__dict__ = dict(self.__dict__)
        w = np.full(self.size, 0.5)
        for i, n in counts.items():
            w[i] += n
        new.weigh(w)
        return new

    def spelt(self, character: str) -> tuple[int, ...]:
        """A character that is no piece, in bytes."""
        return tuple(self.bytes[b] for b in character.encode("utf-8", "replace"))

    def starting(self, head: str) -> tuple[list[tuple[int, int, float]], bool]:
        """(length, id, probability) of the pieces that head starts with, id -1 for its first character in bytes, and
        whether longer pieces may start with all of head."""
        found = []
        k = self.ids.get(head[0])
        if k is None or k < 0:
            found.append((1, -1, math.prod(self.shares[b] for b in self.spelt(head[0]))))
        for j in range(1, len(head) + 1):
            k = self.ids.get(head[:j])
            if k is None:
                break
            if k >= 0:
                found.append((j, k, self.shares[k]))
        if len(self.heads) >= MOST_HEADS:
            self.heads.clear()
        self.heads[head] = found, k is not None and len(head) == HEAD
        return self.heads[head]

    def score(self, word: str) -> float:
        """Natural log of the word's probability over all its segmentations: the forward recursion."""
        own = START + word
        n, get, shares, heads = len(own), self.ids.get, self.shares, self.heads.get
        alpha = [1.0] + [0.0] * n
        for i in range(n):
            here = alpha[i]
            if here < LEAST:
                return self.score_in_logs(word)
            head = own[i : i + HEAD]
            found, more = heads(head) or self.starting(head)
            for j, _, p in found:
                alpha[i + j] += here * p
            if more:
                for j in range(i + HEAD + 1, n + 1):
                    k = get(own[i:j])
                    if k is None:
                        break
                    if k >= 0:
                        alpha[j] += here * shares[k]
        return math.log(alpha[n]) if alpha[n] >= LEAST else self.score_in_logs(word)

    def score_in_logs(self, word: str) -> float:
        """The same for words of any length."""
        word = START + word
        n, get, logs, exp, log = len(word), self.ids.get, self.logs, math.exp, math.log
        arriving: list[list[float]] = [[] for _ in range(n + 1)]
        here = 0.0
        for i in range(n + 1):
            if own := arriving[i]:
                most = max(own)
                here = most if len(own) == 1 else most + log(sum([exp(x - most) for x in own]))
            if i == n:
                break
            j = i + 1
            k = get(word[i:j])
            if k is None or k < 0:
                arriving[j].append(here + sum(logs[b] for b in self.spelt(word[i])))
            while k is not None:
                if k >= 0:
                    arriving[j].append(here + logs[k])
                j += 1
                if j > n:
                    break
                k = get(word[i:j])
        return here

    def expected(self, word: str, weight: int, into: Counter) -> None:
        """Add the pieces' expected counts, in billionths, times the word's count (forward, then backward). A border whose
        share is under a quarter of a unit can't make a piece's count one, so the way back ends there."""
        own = START + word
        n, get, shares, heads = len(own), self.ids.get, self.shares, self.heads.get
        arriving: list[list[tuple[float, int, int]]] = [[] for _ in range(n + 1)]
        alpha = [1.0] + [0.0] * n
        for i in range(n):
            here = alpha[i]
            if here < LEAST:
                return self.expected_in_logs(word, weight, into)
            head = own[i : i + HEAD]
            found, more = heads(head) or self.starting(head)
            for j, k, p in found:
                part = here * p
                alpha[i + j] += part
                arriving[i + j].append((part, i, k))
            if more:
                for j in range(i + HEAD + 1, n + 1):
                    k = get(own[i:j])
                    if k is None:
                        break
                    if k >= 0:
                        part = here * shares[k]
                        alpha[j] += part
                        arriving[j].append((part, i, k))
        if alpha[n] < LEAST:
            return self.expected_in_logs(word, weight, into)
        share = [0.0] * n + [float(weight * UNIT)]  # posterior probability of a border here, times the count
        for j in range(n, 0, -1):
            if (now := share[j]) > 0.25:
                now /= alpha[j]
                for part, i, k in arriving[j]:
                    part *= now
                    share[i] += part
                    if part > 0.5:  # rounded by word, so sums don't depend on how words are dealt out
                        if k >= 0:
                            into[k] += round(part)
                        else:
                            for b in self.spelt(own[i]):
                                into[b] += round(part)

    def expected_in_logs(self, word: str, weight: int, into: Counter) -> None:
        """The same for words of any length."""
        word = START + word
        n, get, logs, exp, log = len(word), self.ids.get, self.logs, math.exp, math.log
        arriving: list[list[tuple[float, int, int | tuple]]] = [[] for _ in range(n + 1)]
        alpha = [0.0] * (n + 1)
        for i in range(n + 1):
            if own := arriving[i]:
                most = max(own)[0]
                alpha[i] = most if len(own) == 1 else most + log(sum([exp(x[0] - most) for x in own]))
            here = alpha[i]
            for j in range(i + 1, n + 1):
                k = get(word[i:j])
                if j == i + 1 and (k is None or k < 0):
                    arriving[j].append((here + sum(logs[b] for b in self.spelt(word[i])), i, self.spelt(word[i])))
                if k is None:
                    break
                if k >= 0:
                    arriving[j].append((here + logs[k], i, (k,)))
        share = [0.0] * n + [float(weight * UNIT)]  # posterior probability of a border here, times the count
        for j in range(n, 0, -1):
            if (now := share[j]) > 0.25:
                base = alpha[j]
                for x, i, ids in arriving[j]:
                    part = now * exp(x - base)
                    share[i] += part
                    for k in ids:
                        into[k] += round(part)  # by word, so sums don't depend on how words are dealt out


def mark_of(text: bytes | None) -> int:
    """64 bits that tell the texts of one id (or of none) apart."""
    from xxhash import xxh3_64_intdigest

    mark = xxh3_64_intdigest(text or b"")
    return mark - (1 << 64) if mark >> 63 else mark


def word_table(docs: DataFrame) -> DataFrame:
    """(word, c, total): counts in training texts and in all, A-Z in lower case."""

    def make():
        train: Counter = Counter()
        rest: Counter = Counter()

        def step(batch: pa.RecordBatch | None):
            if batch is not None:
                for text, held in zip(raw(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                    if text:
                        (rest if held else train).update(text.lower().split())
            if batch is None or len(train) + len(rest) > MOST_WORDS:
                words = list(train | rest)
                yield {"word": pa.array(words, pa.binary()).cast(pa.string()), "c": [train[w] for w in words], "total": [train[w] + rest[w] for w in words]}
                train.clear()
                rest.clear()

        return step

    return map_arrow(docs, make, "word string, c long, total long", end=True).groupBy("word").agg(F.sum("c").alias("c"), F.sum("total").alias("total"))


def common(words: DataFrame, most: int) -> DataFrame:
    """The commonest words, `most` at most: those above a step of the counts' histogram, so no list is sorted."""
    step = F.floor(F.log2("total") * 16).cast("int")  # finer than 5 per cent
    counts = sorted(((r[0], r[1]) for r in words.groupBy(step.alias("s")).count().collect()), reverse=True)  # a thousand rows at most
    least, seen = 1 << 30, 0
    for s, n in counts:
        seen += n
        if seen > most:
            break
        least = s
    return words.filter(step >= least)


def score(docs: DataFrame, vocabulary: str, held_out: Column, hot_words: int = 150_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    docs needs doc_id and text; other columns, whatever their names, are left aside; held_out is a condition on doc_id.
    Null text is empty: its end token alone. Very long texts are scored whole, very long words by the same recursion.
    base_score is the add-one unigram model of whole words, score the lattice model's log10 probability; both count the
    end. Repeated rows each get their row, rows of one id (or none) and different texts their own; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out.alias("held_out"))
    n_docs = rows.filter(~F.col("held_out")).count()
    table = durable(word_table(rows.select("text", "held_out")))
    found = table.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    n_tokens, distinct = (found[0] or 0) + n_docs, found[1] + (n_docs > 0)
    start = spark.sparkContext.broadcast(Pieces(vocabulary))  # the vocabulary's size

    def expected():
        pieces = start.value

        def step(batch: pa.RecordBatch):
            into: Counter = Counter()
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pieces.expected(word, c, into)
            yield {"piece": list(into), "n": [x // UNIT for x in into.values()], "rest": [x % UNIT for x in into.values()]}

        return step

    counts = map_arrow(table.filter("c > 0").select("word", "c"), expected, "piece long, n long, rest long").groupBy("piece").agg(F.sum("n"), F.sum("rest")).collect()  # a row a piece
    model = start.value.reweighted({r[0]: r[1] + r[2] / UNIT for r in counts} | {start.value.end: float(n_docs)})
    sent = spark.sparkContext.broadcast(model)

    def scored():
        pieces = sent.value

        def step(batch: pa.RecordBatch):
            yield {"word": batch.column(0), "c": batch.column(1), "total": batch.column(2), "log": [pieces.score(w) for w in batch.column(0).to_pylist()]}

        return step

    words = durable(map_arrow(table, scored, "word string, c long, total long, log double"))
    top = common(words, hot_words).select("word", "c", "log").collect()  # hot_words rows at most
    hot = spark.sparkContext.broadcast(({r[0].encode(): i for i, r in enumerate(top)}, np.array([(r[1] > 0, math.log10(r[1] + 1), r[2]) for r in top]).reshape(-1, 3)))  # hot_words rows
    # xxhash64 of Spark with its seed, as the tasks below compute it
    cold = words.select(F.xxhash64("word").alias("word"), (F.col("c") > 0).cast("long").alias("cold_known"), F.log10(F.col("c") + 1.0).alias("cold_base"), F.col("log").alias("cold_log"))

    def looked_up():
        from xxhash import xxh64_intdigest

        index, values = hot.value
        done = 0

        def step(batch: pa.RecordBatch):
            nonlocal done
            marks, keys, times, sums, lengths = [], [], [], [], []
            for text in raw(batch.column(1)):
                own = (text or b"").lower().split()
                at = np.fromiter(map(index.get, own, repeat(-1)), np.int64, len(own))
                marks.append(mark_of(text))
                sums.append((len(own) + 1, *(values[at[at >= 0]].sum(0) if len(values) else (0, 0, 0))))
                cold = Counter([own[i] for i in np.flatnonzero(at < 0).tolist()])
                done += 1
                keys += [xxh64_intdigest(w, 42) for w in cold] if cold else [(marks[-1] + done) % (1 << 64)]  # no word: anywhere
                times += cold.values() if cold else [0]
                lengths.append(max(1, len(cold)))
            n, known, base, log = (np.array(x) for x in zip(*sums, strict=True)) if sums else [np.zeros(0)] * 4
            rows = np.repeat(np.arange(len(lengths)), lengths)
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if lengths else np.zeros(0, np.int64)

            def once(x: np.ndarray, kind: type) -> np.ndarray:
                out = np.zeros(len(rows), kind)
                out[first] = x
                return out

            yield {
                "doc_id": batch.column(0).take(pa.array(rows)), "mark": np.array(marks, np.int64)[rows], "times": times, "word": np.array(keys, np.uint64).view(np.int64),
                "copies": once(1, np.int64), "n_tokens": once(n, np.int64), "known": once(known, np.int64), "base": once(base, np.float64), "log": once(log, np.float64),
            }

        return step

    # a row for each rarer word of a text, one at least; a text's first row has its length and the sums over common words
    apart = map_arrow(rows.select("doc_id", "text"), looked_up, "doc_id long, mark long, times long, word long, copies long, n_tokens long, known long, base double, log double")
    with_cold = lambda c: F.sum(F.col(c) + F.col("times") * F.coalesce(f"cold_{c}", F.lit(0))).alias(c)
    per = apart.join(cold, "word", "left").groupBy("doc_id", "mark").agg(F.sum("copies").alias("copies"), F.sum("n_tokens").alias("n_tokens"), *(with_cold(c) for c in ("known", "base", "log")))
    each = per.withColumn("_i", F.explode(F.expr("sequence(1L, copies)")))
    share = lambda c: F.col(c) / F.col("copies")  # noqa: E731  repeated rows were summed together
    return each.select(
        "doc_id", held_out.alias("held_out"), share("n_tokens").cast("long").alias("n_tokens"),
        (share("known").cast("long") + int(n_docs > 0)).alias("n_known"), F.lit(n_tokens).cast("long").alias("train_tokens"),
        (share("base") + math.log10(n_docs + 1) - share("n_tokens") * math.log10(n_tokens + distinct + 1)).alias("base_score"),
        ((share("log") + model.logs[model.end]) / LN10).alias("score"),
    )
