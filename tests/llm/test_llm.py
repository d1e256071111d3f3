"""Operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postalis.llm import graph, htmltext, jaccard, langid, lattice, licenses, mixing, packing, quality, queries, toolchat, topk
from postalis.llm.common import Scratch, fold

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, key string"
LONG = " ".join(f"w{i % 7000} x{i}" for i in range(9000))
PARTS = [f"one two three four five six {i} seven eight nine ten eleven twelve thirteen" for i in range(3)]
ROWS = [
    (1, None, "en", "a", 0, 1, 1, "k"), (2, "", "en", "a", 0, 1, 1, "k"), (3, " \n\t ", None, None, 3, 1, 1, None), (4, LONG, "en", "a", len(LONG), 1, 1, "k"), (5, LONG, "en", "b", len(LONG), 1, 1, "k"),
    (6, PARTS[0], "en", "a", 1, 1, 1, "k"), (6, PARTS[0], "en", "a", 1, 1, 1, "k"), (None, PARTS[1], "en", None, 1, 1, 1, "k"), (7, "Été über! 42", "fr", "c", 1, 1, 1, "k"), (8, "Released under the MIT License.", "en", "c", 1, 1, 1, "k"), (9, "12 34", None, "c", 1, 1, 1, "k"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return (text or "").encode().lower().split()


def test_packing(spark, edge, none, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    for frame in (edge, docs):
        got = packing.pack(frame, WORDS).toPandas()
        want = Counter()
        for r in frame.collect():
            ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
            for k, i in enumerate(range(0, len(ids), 4096)):
                own = ids[i : i + 4096]
                want[r.doc_id, k, i, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
        have = Counter((None if math.isnan(d) else int(d), *map(int, x)) for d, *x in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
        assert have == want
        got = got.sort_values(["sequence_id", "offset"])
        assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
        assert got.groupby("sequence_id").length.sum().max() <= 4096
    assert got.sequence_id.nunique() <= got.length.sum() / 4096 + 1.5
    assert packing.pack(none, WORDS).count() == 0


def test_packing_plan_is_sound_on_random_lengths():
    draw = np.random.default_rng(1)
    for cap in (12, 100):
        lengths = draw.integers(1, cap + 1, 500)
        histogram = np.bincount(lengths, minlength=cap + 1)
        bins, table = {}, packing.plan(histogram, cap)
        for length in range(1, cap + 1):
            own = table[table[:, 0] == length]
            for rank in range(histogram[length]):
                e = own[np.searchsorted(own[:, 1], rank, "right") - 1]
                nth = rank - e[1]
                bins.setdefault(e[2] + nth // e[3], []).append((e[4] + nth % e[3] * length, length))
        for items in bins.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= cap
        assert len(bins) <= 1.1 * lengths.sum() / cap + 1 + (lengths > cap // 2).sum()


def test_mixing(edge, none, docs):
    got = mixing.mix(docs, block=20).toPandas()
    again = mixing.mix(docs.repartition(7), block=20).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, got[key].to_numpy())) == sorted(map(tuple, again[key].to_numpy()))
    assert (got.taken <= 2 * got["size"]).all()
    by = got.assign(source=got.doc_id.map({r.doc_id: r.source for r in docs.collect()})).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.most).all()
    size = {s: sum(len(words(r.text)) for r in docs.collect() if r.source == s) for s in by.index}
    weight, target = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by.index))}, dict.fromkeys(by.index, 0.0)
    rest, open_ = 1.5 * sum(size.values()), set(by.index)
    while rest > 1e-6:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        for s, x in share.items():
            target[s] += x
        rest = sum(max(0, target[s] - 2 * size[s]) for s in open_)
        for s in [s for s in open_ if target[s] >= 2 * size[s]]:
            target[s] = 2.0 * size[s]
            open_.discard(s)
    assert all(abs(by.target[s] - target[s]) < 1e-3 for s in by.index)
    assert mixing.mix(edge).count() == len(ROWS) and mixing.mix(none).count() == 0


def test_mixing_spreads_equal_rows_and_is_the_same_again(spark):
    rows = [(None, "a b c", "hot")] * 5000 + [(i, "w " * (i % 9 + 1), "other") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [mixing.mix(frame.repartition(n), block=100, fan=4).toPandas() for n in (3, 8)]
    totals = [sorted(zip(g.doc_id.fillna(-1), g["size"], g.taken)) for g in got]
    assert totals[0] == totals[1] and len(totals[0]) == 5300
    for _, own in got[0].assign(hot=got[0].doc_id.isna()).groupby("hot"):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= own["size"].max()


def test_flight_keeps_both_totals():
    sizes, chances = [3, 8, 1, 9, 4, 4, 7] * 5, [0.4, 0.7] * 17 + [0.5]
    out = mixing.flight(sizes, chances, 3)
    assert sum(0 < p < 1 for p in out) <= 2
    assert math.isclose(sum(out), sum(chances)) and math.isclose(np.dot(sizes, out), np.dot(sizes, chances))


def test_top_k(spark):
    draw = np.random.default_rng(2)
    data = [(i, [float(x) for x in draw.normal(size=6)]) for i in range(300)] + [(500 + i, [0.5] * 6) for i in range(20)]
    odd = [(1000, None), (1001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1002, [math.nan] * 6), (1003, [math.inf] * 6), (0, [0.25] * 6), (None, [1.0] * 6), (2000, [1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(data + odd, "vec_id long, embedding array<float>").withColumn("cell", F.lit(1)), F.col("vec_id") % 50 == 0, block=16, chunk=3)
    rows = [(k, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for k, v in data + odd[4:5] + odd[6:]]
    want = []
    for i, (q, v) in enumerate(rows):
        if q % 50 == 0:
            best = sorted(((-int(v @ x), k) for j, (k, x) in enumerate(rows) if j != i and len(x) == len(v)))[:5]
            want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_large_components(spark):
    values = {0: [3e15, 2e15], 1: [1.0, 1.0], 2: [-1e15, 2e15], 3: [1.0, -1.0], 50: [0.5, 0.25], 51: [2e16, 1.0], 52: [0.0, -1e300]}
    frame = lambda keys: spark.createDataFrame([(k, values[k]) for k in keys], "vec_id long, embedding array<double>")
    for keys in ((0, 1, 3, 50), (50, 51, 1, 2)):
        got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(frame(keys), F.col("vec_id") % 50 == 0, scale=2).collect()}
        for q in [k for k in keys if k % 50 == 0]:
            score = {k: sum(int(2 * x // 1) * int(2 * y // 1) for x, y in zip(values[q], values[k], strict=True)) for k in keys if k != q}
            for n, k in enumerate(sorted(score, key=lambda k: (-score[k], k)), 1):
                assert got.pop((q, n)) == (k, score[k])
        assert not got
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(frame((0, 1, 2)), F.col("vec_id") % 50 == 0).collect()
    with pytest.raises(Exception, match="no double"):
        topk.top_k(frame((1, 50, 52)), F.col("vec_id") % 50 == 0, scale=10**9).collect()


def test_quality(edge, none, docs):
    for frame in (edge, docs):
        for r, g in zip(frame.orderBy("doc_id").collect(), quality.judge(frame).orderBy("doc_id").collect(), strict=True):
            w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
            windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
            covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
            lines = [x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(covered))
            assert g.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (g.base_failed and g.kept)
    assert quality.judge(none).count() == 0


def test_line_frequency_spares_copies(spark):
    body = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(i, f"Subscribe now to our letter\nstory {i} {body} number {i * 7}", "h") for i in range(40)] + [(100 + i, f"{body}\nmu nu xi omicron pi rho sigma tau", "h") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for rules in (quality.Rules(), quality.Rules(broadcast_lines=-1)):
        got = {r.doc_id: r for r in quality.judge(frame, rules).collect()}
        assert all(got[i].n_removed_lines == 1 and got[i].kept and "Subscribe" not in got[i].clean_text for i in range(40))
        assert all(got[100 + i].n_removed_lines == 0 and got[100 + i].kept for i in range(40))


def test_kept_and_removed_lines_against_brute_force(docs, edge):
    for frame in (docs, edge):
        rows = [(r.source, r.text or "") for r in frame.collect()]
        normal = lambda line: b" ".join(line.encode().lower().split())
        whole, places = {}, {}
        for source, text in rows:
            own = tuple(x for x in map(normal, text.split("\n")) if x)
            whole.setdefault(source, set()).add(own)
            for line in own:
                places.setdefault((source, line), set()).add(own)
        bad = {k for k, v in places.items() if len(v) > max(1, min(0.001 * len(whole[k[0]]), 3))}
        want = Counter()
        for source, text in rows:
            left = [x for x in text.split("\n") if (source, normal(x)) not in bad]
            removed = sum((source, normal(x)) in bad for x in text.split("\n"))
            want[len(words(text)), removed, "\n".join(left)] += 1
        assert frame is edge or any(removed for _, removed, _ in want)
        for broadcast in (500_000, -1):
            got = quality.judge(frame, quality.Rules(line_docs=1, line_share=0.001, line_most=3, broadcast_lines=broadcast)).collect()
            assert Counter((r.n_words, r.n_removed_lines, r.clean_text or "") for r in got) == want
            assert all(r.kept == (not r.base_failed and len(words(r.clean_text)) >= max(10, 0.3 * r.n_words)) for r in got)


def test_language(spark, edge, none, docs):
    model = langid.fit(docs.filter(fold("doc_id", 3) != 1))
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang", (fold("doc_id", 3) == 1).alias("held")), "doc_id").filter("held").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.9 and got.score.between(0, 1).all()
    odd = {r.doc_id: r for r in langid.predict(edge, model).collect()}
    assert all((odd[i].lang_pred, odd[i].score) == ("und", 0.0) for i in (1, 2, 3, 9)) and odd[7].lang_pred != "und"
    assert langid.predict(none, model).count() == 0
    assert {r.lang_pred for r in langid.predict(edge, langid.fit(none)).collect()} == {"und"}


def brute_language(rows, texts):
    """Word-first backoff over plain dictionaries: rows (text, lang) to learn from, (lang, score) of each text."""
    langs = sorted({lang for _, lang in rows})
    tables = [Counter() for _ in range(6)]
    for text, lang in rows:
        for word in langid.words_of(text):
            tables[0][word, lang] += 1
            for k in range(1, 6):
                padded = f"<{word}>" if k > 1 else word
                for i in range(len(padded) - k + 1):
                    tables[k][padded[i : i + k], lang] += 1
    known = [{g for g, _ in t} for t in tables]
    total = [{x: sum(n for (_, y), n in t.items() if y == x) + 0.5 * len(k) for x in langs} for t, k in zip(tables, known, strict=True)]
    log = lambda k, g, x: math.log((tables[k][g, x] + 0.5) / total[k][x])
    prior, out = Counter(lang for _, lang in rows), []
    for text in texts:
        own = langid.words_of(text)
        sums = {x: math.log(prior[x] / len(rows)) for x in langs}
        for word in own:
            for k in (0, 5, 4, 3, 2, 1):
                padded = f"<{word}>" if k > 1 else word
                found = [g for g in ([word] if k == 0 else [padded[i : i + k] for i in range(len(padded) - k + 1)]) if g in known[k]]
                if found:
                    for x in langs:
                        sums[x] += sum(log(k, g, x) for g in found) / len(found)
                    break
        if not own:
            out.append(("und", 0.0))
            continue
        best = max(langs, key=lambda x: (sums[x], [-ord(c) for c in x]))
        out.append((best, 1 / sum(math.exp((sums[x] - sums[best]) / math.sqrt(len(own))) for x in langs)))
    return out


def test_language_against_brute_force(spark, docs):
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    learn = [(t, x) for d, t, x in rows[:60] if t and x]
    texts = [t for _, t, _ in rows[60:90]] + [None, "", "12", "qqqq zzzz", "ß", "été " * 50]
    model = langid.fit(spark.createDataFrame([(i, *r) for i, r in enumerate(learn)], "doc_id long, text string, lang string"), per_lang=10**6)
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    for (lang, score), r in zip(brute_language(learn, texts), got, strict=True):
        assert r.lang_pred == lang and math.isclose(r.score, score, rel_tol=1e-6)


def test_language_of_300_labels_and_small_ones(spark):
    rows = [(i, " ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}{chr(97 + j)}" for j in range(20)), f"l{i:03d}") for i in range(300)]
    rows += [(1000 + i, " ".join(f"common{chr(97 + (i * j) % 26)}{chr(97 + j % 26)}{chr(97 + i % 26)}" for j in range(200)), "large") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(frame, langid.fit(frame, per_lang=500)).collect()
    assert len({r.lang_pred for r in got}) == 301 and all(r.lang_pred == dict((d, x) for d, _, x in rows)[r.doc_id] for r in got)


def test_licenses(edge, none, docs):
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for frame in (edge, docs):
        for r, g in zip(frame.orderBy("doc_id").collect(), licenses.scan(frame).orderBy("doc_id").collect(), strict=True):
            w = split.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
            places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
            at = [i for i, _ in places]
            assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
            assert set(g.base_labels.split(",")) <= set(g.labels.split(",")) or not g.base_labels
    assert licenses.scan(none).count() == 0


def test_license_templates(spark):
    text = "Copyright X.\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
    got = licenses.scan(spark.createDataFrame([(1, text), (2, "fee for software use with any purpose")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert (got[0].labels, got[0].base_labels, got[1].labels) == ("isc", "", "")


def test_lattice_score_is_the_sum_over_segmentations():
    pieces = lattice.Pieces(PIECES)

    def paths(rest):
        if not rest:
            return [0.0]
        found = [pieces.logs[k] + x for n in range(1, len(rest) + 1) if (k := pieces.ids.get(rest[:n], -1)) >= 0 for x in paths(rest[n:])]
        if pieces.ids.get(rest[:1], -1) < 0:
            found += [sum(pieces.logs[b] for b in pieces.spelt(rest[0])) + x for x in paths(rest[1:])]
        return found

    for word in ("the", "ention", "naïve", "x☃y", "a"):
        every = paths(lattice.START + word)
        assert math.isclose(pieces.score(word), math.log(sum(map(math.exp, every))), rel_tol=1e-9)
    into = Counter()
    pieces.expected("ention", 2, into)
    assert math.isclose(sum(n / lattice.UNIT * len(p) for p, k in pieces.ids.items() if k >= 0 and (n := into[k])), 2 * len("ention") + 2, rel_tol=1e-6)


@pytest.mark.parametrize("hot", [5, 150_000])
def test_lm_scores(edge, none, docs, hot):
    for frame in (edge, docs):
        got = lattice.score(frame, PIECES, fold("doc_id", 7) == 2, hot_words=hot).toPandas()
        rows, count, n = frame.collect(), Counter(), 0
        held = lambda r: zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7 == 2
        for r in rows:
            if not held(r):
                count.update(words(r.text))
                n += 1
        total, distinct = sum(count.values()) + n, len(count) + 1
        want = sorted((str(r.doc_id), held(r), len(words(r.text)) + 1, sum(count[w] > 0 for w in words(r.text)) + 1, total, round(sum(math.log10((c + 1) / (total + distinct + 1)) for c in [*(count[w] for w in words(r.text)), n]), 5)) for r in rows)
        have = sorted(("None" if math.isnan(d) else str(int(d)), bool(h), int(t), int(k), int(tt), round(b, 5)) for d, h, t, k, tt, b in got[["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]].itertuples(index=False))
        assert [x[:5] for x in have] == [x[:5] for x in want] and all(abs(x[5] - y[5]) < 1e-3 for x, y in zip(have, want, strict=True))
        pieces, into = lattice.Pieces(PIECES), Counter()
        for word, c in count.items():
            pieces.expected(word.decode(), c, into)
        model = pieces.reweighted({k: x / lattice.UNIT for k, x in into.items()} | {pieces.end: float(n)})
        score = sorted((str(r.doc_id), (sum(model.score(w.decode()) for w in words(r.text)) + model.logs[model.end]) / lattice.LN10) for r in rows)
        found = sorted(("None" if math.isnan(d) else str(int(d)), x) for d, x in got[["doc_id", "score"]].itertuples(index=False))
        assert [x[0] for x in found] == [x[0] for x in score] and all(math.isclose(x[1], y[1], rel_tol=1e-9) for x, y in zip(found, score, strict=True))
    assert lattice.score(none, PIECES, fold("doc_id", 7) == 2).count() == 0


def brute_classes(rows):
    sets = {}
    for doc, text in rows:
        w = words(text)
        sets[doc] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    lowest = {d: d for d in sets}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    while True:
        before = dict(lowest)
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
        if lowest == before:
            return {d: (len(sets[d]), lowest[d]) for d in sets}


def test_jaccard(spark, none, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    base = " ".join(f"t{i}" for i in range(120))
    near = [(10_000 + i, " ".join(f"t{j}" if j != 3 * i and j != 2 * i + 1 else f"z{i}" for j in range(120))) for i in range(40)]
    odd = [(20_000, "Two words"), (20_001, "two WORDS"), (20_002, "one two three four"), (20_003, base), (20_004, base)]
    every = rows + near + odd
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(spark.createDataFrame(every, "doc_id long, text string").withColumn("node", F.lit(1))).collect()}
    assert got == brute_classes(every)
    assert jaccard.classes(none).count() == 0


def test_jaccard_edges(edge):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(edge).collect()]
    assert len(got) == len(ROWS) and {(1, 0, 1), (2, 0, 2), (3, 0, 3)} <= set(got)
    assert {c for d, _, c in got if d in (4, 5)} == {4} and got.count(next(x for x in got if x[0] == 6)) == 2 and {c for d, _, c in got if d is None} == {None}


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100)]
    got = dict(graph.components(spark.createDataFrame(chain, "a long, b long").repartition(5), Scratch(spark), chunk=4).collect())
    assert {got[i] for i in range(31)} == {0} and got[100] == got[101] == 100


def test_tool_calls(spark):
    call = lambda i, name, args, parent=None: f'{{"tool_calls":[{{"id":"{i}","name":"{name}","arguments":{args}' + (f',"parent_id":"{parent}"' if parent else "") + "}]}"
    result = lambda i, content: f'{{"tool_call_id":"{i}","content":{content}}}'
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", call("a", "add", '{"y":2,"x":1.50}')), (1, 2, "tool", result("a", '{"b":1,"a":[2]}')), (1, 3, "assistant", call("b", "add", '{"x":"no","z":1}', "a")), (1, 4, "tool", "not json"),
        (1, 5, "tool", result("zz", "1")), (1, 6, "assistant", call("c", "nope", "{}", "d")), (1, 7, "assistant", call("d", "add", '{"x":1,"y":1}', "c")), (2, 0, "assistant", call("a", "add", '{"x":1,"y":1}')), (2, 0, "assistant", call("a", "add", '{"x":1,"y":1}')),
        (3, 4, "assistant", call("e", "add", '{"x":1,"y":1}')), (3, 3, "tool", result("e", "null")), (None, 0, "assistant", call("q", "add", "{}")), (4, None, "tool", None),
    ]
    schemas = spark.createDataFrame([("add", "x", "number", True), ("add", "y", "integer", True)], "tool string, argument string, type string, required boolean")
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit(9))
    got = {(r.conv_id, r.call_id): r for r in toolchat.link_tool_calls(frame, schemas).collect()}
    status = {k: (r.status, r.depth, r.errors) for k, r in got.items()}
    assert status == {
        (1, "a"): ("linked", 0, ""), (1, "b"): ("unanswered", 1, "missing y; type x; unknown z"), (1, "zz"): ("orphan", None, ""), (1, "c"): ("cyclic", None, "no schema"), (1, "d"): ("cyclic", None, ""),
        (2, "a"): ("repeated", 0, ""), (3, "e"): ("early", 0, ""),
    }
    assert got[1, "a"].record == '{"arguments":{"x":1.5,"y":2},"call_id":"a","conversation":1,"depth":0,"errors":[],"parent_id":null,"result":{"a":[2],"b":1},"status":"linked","tool":"add","turn":1}'
    assert toolchat.link_tool_calls(frame.limit(0), schemas).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div id="cookie-notice">We use cookies</div>
<article><h1>Title</h1><p>One &amp; <b>two</b>\n three<br>four.<p>Five <a href=x>six</a></p><ul><li>item</li></ul><div class="ad">Buy</div><section class="comments"><p>A long reader comment with many words in it, really many of them.</p></section></article>
<aside class=sidebar><p>Popular teaser text which goes on for quite a while.</p></aside><form><p>Subscribe</p></form><footer>&copy; me</footer><script>var x = "</p>";</script></body></html>"""


def test_html(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = htmltext.fit(pages)
    odd = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<p>unclosed <b>text & more"), (1, "u", PAGE), (5, "u", "<<<>><!-- open")], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = {r.page_id: r for r in htmltext.extract(odd, model).collect()}
    assert got[1].text == "Title\nOne & two three four.\nFive six\nitem" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[4].text == "unclosed text & more"
    assert htmltext.extract(odd.limit(0), model).count() == 0 and htmltext.extract(pages, model).filter("n_chars = 0").count() == 0


def test_tree_marginals_equal_enumeration():
    for seen in ({}, {("f0", "copyright"): 90, ("n", "0"): 100, ("e1", "0"): 500, ("f1", "tag:li"): 70}):
        model = htmltext.Model(seen)
        for page in ("<div>top<p>some words &copy;</p><ul><li><a>x</a></li></ul></div>", "<header>h</header><div class='post'><p>a</p><aside>b</aside></div>"):
            nodes, _ = htmltext.parse(page)
            own = [model.own(n) for n in nodes]
            own[0] = (-htmltext.SURELY, own[0][1], own[0][1])
            weight = {y: sum(own[i][v] for i, v in enumerate(y)) + sum(model.edge[y[n.parent]][y[i]] for i, n in enumerate(nodes) if i) for y in np.ndindex(*(3,) * len(nodes))}
            for i, odds in enumerate(model.marginals(nodes)):
                yes, no = (np.logaddexp.reduce([w for y, w in weight.items() if (y[i] == htmltext.ARTICLE) == side]) for side in (True, False))
                assert math.isclose(odds, yes - no, rel_tol=1e-6, abs_tol=1e-6)


ODD_PAGE = """<body><div class="has-sidebar page"><article><h1>Head</h1><p class="search-methods">Methods</p><p class="alert">Beware</p><div id="form-of-words">Form of words, several of them</div>
<div class="notice">Notice</div><div class="ad"><p>A long advert that goes on and on in one long paragraph, as long as any paragraph of the article itself.</p></div><p>Area <math>x = 1</math> and <audio>fallback</audio>
<button>press<p>after the button</p><section class="comments"><div><p>First reader comment of many words, really many of them, like a paragraph.</p><p>Second reader comment of many words, really many of them.</p></div></section></article></div></body>"""


def test_html_words_of_names_and_nested_parts():
    for model in (htmltext.Model({}), htmltext.Model(htmltext.observed(PAGE))):
        nodes, blocks = htmltext.parse(ODD_PAGE)
        odds = model.marginals(nodes)
        assert [t for i, t in blocks if odds[i] >= 0] == ["Head", "Methods", "Beware", "Form of words, several of them", "Area x = 1 and fallback", "after the button"]


def test_html_deep_and_unclosed(spark):
    import time

    pages = ["<div>" * 30_000 + "deep" + "</p>" * 30_000, "<button>" * 30_000 + "<p>text</p>", "<nav>" * 5_000 + "<li>x" * 5_000, "<p>" + "long " * 400_000 + "</p>"]
    start = time.perf_counter()
    found = [htmltext.parse(p) for p in pages]
    assert time.perf_counter() - start < 10
    assert [b[-1][1] for _, b in found[:2]] == ["deep", "text"] and found[3][1][0][1] == ("long " * 400_000).strip()
    frame = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.n_chars for r in htmltext.extract(frame, htmltext.Model({})).collect()}
    assert got[3] == 5 * 400_000 - 1


def test_html_against_pages_without_names(spark):
    """The model, fitted on half of the pages, on the other half with and without the names of semantic elements."""
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    seen = Counter()
    for r in rows[::2]:
        seen.update(htmltext.observed(r.html))
    model, hidden, same = htmltext.Model(seen), 0, 0
    for r in rows[1::2]:
        nodes, blocks = htmltext.parse(r.html)
        article = [t for i, t in blocks if nodes[i].known == 1]
        for names in (True, False):
            html = r.html if names else re.sub(r"<(/?)(article|main|nav|footer|aside|form|header)\b", r"<\1div", r.html)
            nodes, blocks = htmltext.parse(html)
            odds = model.marginals(nodes)
            equal = [t for i, t in blocks if odds[i] >= 0] == article
            same, hidden = same + (names and equal), hidden + (not names and equal)
    assert same == len(rows[1::2]) and hidden >= 0.9 * same


def test_pipeline(spark):
    from postalis.llm import stages as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES[:4]:
        kept = stage(spark, docs, SF)
        assert kept.columns == pipeline.COLUMNS, name
        if name == "near_duplicates":
            sets = {r.doc_id: words(r.text) for r in docs.collect()}
            assert {r.doc_id for r in kept.select("doc_id").collect()} <= set(sets)
        docs = kept
    assert queries.pipeline(spark, SF).count() > 0


def test_stages_on_odd_rows(spark, edge, none):
    from postalis.llm import stages as pipeline

    rows = edge.collect()
    kept = {name: stage(spark, edge, SF).collect() for name, stage in pipeline.STAGES}
    assert all(stage(spark, none, SF).count() == 0 for _, stage in pipeline.STAGES)
    assert {r.doc_id for r in kept["quality_rules"]} == {4, 5, 6, None} and sum(r.doc_id == 6 for r in kept["quality_rules"]) == 2
    assert {1, 2, 3, 9}.isdisjoint({r.doc_id for r in kept["language_id"]}) and all(r.text for r in kept["language_id"])
    ids = Counter(r.doc_id for r in kept["near_duplicates"])
    assert ids[6] == ids[4] == 1 and 5 not in ids and None in ids and {1, 2, 3} <= set(ids)
    mixed = Counter(r.doc_id for r in kept["source_mixing"])
    assert max(mixed.values()) <= 4 and set(mixed) <= {r.doc_id for r in rows}
    assert sum(r.length for r in kept["best_fit_packing"] if r.doc_id in (1, 2)) == 2


def test_mixed_rows_are_the_mix(spark, docs):
    from postalis.llm import stages as pipeline

    frame = docs.unionByName(docs.filter("doc_id < 40")).unionByName(docs.limit(20).withColumn("doc_id", F.lit(None).cast("long")))
    rows = pipeline.source_mixing(spark, frame, SF).collect()
    got = mixing.mix(frame.withColumn("_mark", F.xxhash64(*pipeline.COLUMNS[1:])), carry=("_mark",)).toPandas()
    assert len(rows) == got.copies.sum() and sum(len(words(r.text)) for r in rows) == got.taken.sum()
    have = Counter(r.doc_id for r in rows)
    assert all(have[None if math.isnan(d) else int(d)] == n for d, n in got.groupby("doc_id", dropna=False).copies.sum().items())


def test_tool_calls_long_chain_and_message(spark):
    call = lambda i, parent: '{"tool_calls":[{"id":"%d","name":"add","arguments":{"x":"%s"},"parent_id":"%s"}]}' % (i, "long " * (50_000 if i == 5 else 1), parent)
    rows = [(1, i, "assistant", call(i, i - 1)) for i in range(300)] + [(1, 500 + i, "tool", f'{{"tool_call_id":"{i}","content":1}}') for i in range(300)]
    schemas = spark.createDataFrame([("add", "x", "string", True)], "tool string, argument string, type string, required boolean")
    got = toolchat.link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), schemas).collect()
    assert {int(r.call_id): r.depth for r in got} == {i: i for i in range(300)} and all(r.status == "linked" and not r.errors for r in got)
    assert next(len(r.record) for r in got if r.call_id == "5") > 250_000
