"""Rows of one id, or none, and different texts keep their own scores; the session's batch setting stays."""

import public_tokenizers
from pyspark.sql import functions as F

from postalis.llm import lattice
from postalis.llm.common import BATCH_SETTING

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_texts_of_one_id_are_no_copies(spark):
    texts = ["one two three four five six seven eight", "alpha beta", "alpha beta", None, "plumless", "buckeroo"]  # the last two share their crc32
    docs = spark.createDataFrame([(None, t) for t in texts] + [(1, "plumless"), (1, "buckeroo"), (2, "alpha beta")], "doc_id long, text string")
    found = lattice.score(docs, PIECES, held_out=F.coalesce(F.col("doc_id") == 2, F.lit(False)), hot_words=2).collect()
    assert sorted(r.n_tokens for r in found if r.doc_id is None) == [1, 2, 2, 3, 3, 9]
    by = {}
    for r in found:
        by.setdefault((r.doc_id, r.n_tokens, round(r.score, 9)), []).append(r)
    assert len(by[(None, 3, next(s for d, n, s in by if d is None and n == 3))]) == 2
    ones = sorted(round(r.score, 9) for r in found if r.doc_id == 1)
    twos = sorted(round(r.score, 9) for r in found if r.doc_id is None and r.n_tokens == 2)
    assert ones == twos and ones[0] != ones[1]


def test_batch_setting_stays(spark):
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, "7")
    try:
        docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
        assert lattice.score(docs, PIECES, held_out=F.lit(False)).count() == 1 and spark.conf.get(BATCH_SETTING) == "7"
    finally:
        spark.conf.set(BATCH_SETTING, before)


def test_rare_words_keep_their_expected_counts():
    from collections import Counter

    pieces, into = lattice.Pieces(PIECES), Counter()
    pieces.expected("unhappy", 1, into)
    assert len(into) > 10 and sum(into.values()) >= lattice.UNIT and any(0 < n < lattice.UNIT // 1_000_000 for n in into.values())


def test_texts_are_split_once_to_count_and_once_to_score(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "")], "doc_id long, text string")
    found = lattice.score(docs, PIECES, held_out=F.lit(False), hot_words=1)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.n_tokens, r.n_known) for r in found.collect()) == [(1, 3, 3), (2, 2, 2), (3, 1, 1)]


def test_recursions_in_doubles_and_in_logs_agree():
    from collections import Counter

    pieces = lattice.Pieces(PIECES)
    for word in ("unhappy", "", "straße", "\U0001f600x\U0001f601", "internationalization", "é́z", "\U0001f600" * 90, "word" * 300):
        assert abs(pieces.score(word) - pieces.score_in_logs(word)) <= 1e-12 * abs(pieces.score_in_logs(word))
        one, two = Counter(), Counter()
        pieces.expected(word, 3, one)
        pieces.expected_in_logs(word, 3, two)
        assert all(abs(one[k] - two[k]) <= max(2 * len(word), 1e-9 * two[k]) for k in one | two)
