"""Cross-tokenizer alignment against a brute-force version on whole texts."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postalis.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "  two  spaces ", "line\nbreak\n\n\ttab\r\nend\r\n", "The quick brown fox, the lazy dog.", "The quick brown fox, the lazy dog.", "straße größe 日本語  　wide  ", "piece▁space", "<|endoftext|> <s> <unk> <0x0A>", "x" * 3000,
    "\n starts so", "mixed\x1c\x85 ends", "emoji 👩‍👩‍👧 and ﻿ mark", "tail   ", "\r", "don't we'll I'm 12345 !!!???", "no" + "-" * 500 + "break",
]


def brute(rows):
    """doc -> figures, from each whole text's own encoding and all pairs of its groups."""
    a_of, b_of = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_of.encode_special_tokens = True
    *_, bytes_a, bytes_b, _, _ = alignment.tokenizers(A, B)
    out, links = {}, {}
    for k, text in rows:
        out[k], links[k] = (0, 0, 0, 0, ""), Counter()
        if not text:
            continue
        a, b, whole = a_of.encode(" " + text, add_special_tokens=False).ids, b_of.encode(text), (" " + text).encode()
        if b"".join(bytes_a[x] for x in a) != whole or b"".join(bytes_b[x] for x in b) != whole:
            continue
        ends = [[0], [0]]
        for own, ids, sizes in ((ends[0], a, bytes_a), (ends[1], b, bytes_b)):
            for x in ids:
                own.append(own[-1] + len(sizes[x]))
        cuts, groups = sorted(set(ends[0]) & set(ends[1])), []
        for lo, hi in zip(cuts, cuts[1:]):
            i, j = ([n for n in range(len(own) - 1) if lo <= own[n] and own[n + 1] <= hi] for own in ends)
            groups.append(",".join(str(a[x]) for x in i) + "|" + ",".join(str(b[x]) for x in j))
            links[k].update((a[x], b[y]) for x in i for y in j if ends[0][x] < ends[1][y + 1] and ends[1][y] < ends[0][x + 1])
        out[k] = (len(a), len(b), len(groups), sum(links[k].values()), hashlib.sha256(";".join(groups).encode()).hexdigest())
    count = sum(links.values(), Counter())
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return {k: (*x[:4], sum(n for p, n in links[k].items() if count[p] == best[p[1]]), sum(n * count[p] for p, n in links[k].items()), x[4]) for k, x in out.items()}


@pytest.mark.parametrize("fan_in", [256, 2])
def test_alignment(spark, fan_in):
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = alignment.token_alignment(docs.withColumns({"run": F.lit("x"), "at": F.lit(1), "n_a": F.lit(9)}), A, B, fan_in).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute(rows) and len(found) == len(rows)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (None, None)], "doc_id long, text string")
    found = sorted((tuple(r) for r in alignment.token_alignment(docs, A, B).collect()), key=str)
    want = brute([(0, "same text"), (1, "same text"), (2, "same text")])[0]
    assert sorted(map(str, found)) == sorted(map(str, [(1, *want), (1, *want), (None, *want), (None, 0, 0, 0, 0, 0, 0, "")]))
    assert alignment.token_alignment(docs.limit(0), A, B).count() == 0
    assert alignment.token_alignment(docs.filter("text is null"), A, B).first().n_links == 0


def test_small_buffers_and_portions_change_nothing(monkeypatch):
    texts = [f"document {i} says {i * 7919} times naïve words, " + "alpha beta " * (i % 5) for i in range(60)] + ["long " * 2000]

    def run():
        import pyarrow as pa

        class Context:
            @staticmethod
            def get():
                return type("T", (), {"partitionId": lambda self: 3})()

        monkeypatch.setattr(alignment, "TaskContext", Context)
        step = alignment.to_runs(A, B)()
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
        rows = [r for out in (*step(batch), *step(None)) for r in zip(*(list(out[c]) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "run", "at")), strict=True)]
        return {r[0]: r[1:6] for r in rows if r[0] is not None}, {r[6] for r in rows if r[6] is not None}

    whole, one = run()
    for name, value in (("PORTION", 300), ("MOST_UNITS", 50), ("RUN_LINKS", 100), ("TOGETHER", 3), ("LONG_UNIT", 4)):
        monkeypatch.setattr(alignment, name, value)
    parts, many = run()
    assert parts == whole and len(one) == 1 and len(many) > 5


def test_runs_pack_and_merge():
    import numpy as np

    rng = np.random.default_rng(5)
    heads, want = [], Counter()
    for _ in range(9):
        keys = np.unique(rng.integers(0, 1 << 22, 9000)).astype(np.uint32)
        sums = rng.integers(1, 1 << 40, len(keys))
        want.update(dict(zip(keys.tolist(), sums.tolist(), strict=True)))
        heads.append(alignment.to_head(keys, sums))
    keys, sums = (np.concatenate(x) for x in zip(*alignment.blocks_of(alignment.merged(heads)), strict=True))
    assert dict(zip(keys.tolist(), sums.tolist(), strict=True)) == want and (np.diff(keys.astype(np.int64)) > 0).all()
    keys = np.sort(rng.integers(0, 50, 500)).astype(np.uint32)
    at, n = rng.integers(0, 60_000, 500), rng.integers(1, 1 << 20, 500)
    pair, reps, back, links = alignment.from_body(alignment.to_body(keys, at, n))
    assert np.repeat(pair, reps).tolist() == keys.tolist() and back.tolist() == at.tolist() and links.tolist() == n.tolist()
