"""Every template that stands in a file is found, whatever else stands there."""

import random

from postalis.llm import licenses

TEXT = {label: text for label, text, _ in reversed(licenses.TEMPLATES)}  # the first text of each label


def brute(index, words, least):
    out = {}
    for t, (label, template, must) in enumerate(zip(index.labels, index.words, index.must, strict=True)):
        weight = [index.weights[t][w] for w in template]
        for start in range(-len(template), len(words)):
            have = sum(x for k, (w, x) in enumerate(zip(template, weight, strict=True)) if 0 <= start + k < len(words) and words[start + k] == w)
            inside = range(max(0, start), start + len(template) - len(must) + 1)
            if (share := have / sum(weight)) >= least and any(words[k : k + len(must)] == must for k in inside):
                out[label] = max(out.get(label, 0.0), share)
    return out


def test_files_of_several_licences(spark):
    short = {"cc-by": "licensed under cc by 4 0", "proprietary": "All rights reserved."}
    rows = [("mit", "cc-by"), ("mit", "proprietary"), ("gpl", "bsd", "cc-by"), ("bsd", "isc", "proprietary")]
    texts = [("\n\n".join(short.get(x, TEXT[x]) for x in own), own) for own in rows]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)] + [(100 + i, "licensed under by 4 0 all rights reserved cc") for i in range(50)], "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(frame).collect()}
    assert all(set(own) <= got[i] for i, (_, own) in enumerate(texts))


def test_matches_equal_all_starts():
    draw = random.Random(5)
    vocabulary = sorted({w for _, t, _ in licenses.TEMPLATES for w in t.split()})
    found = 0
    for n in range(120):
        index = licenses.Index({w.encode(): draw.choice((0, 1, 10, 500, 1000)) for w in vocabulary}, 1000)
        words = []
        for _, text, must in draw.sample(licenses.TEMPLATES, draw.randint(1, 4)):
            at = text.index(must)
            keep = draw.choice((0.5, 0.8, 1.0))
            for part, fixed in ((text[:at], False), (must, True), (text[at + len(must) :], False)):
                words += [w if fixed or draw.random() < keep else draw.choice(vocabulary) for w in part.split()]
            words += draw.choices(vocabulary, k=draw.randint(0, 30))
        words = [w.encode() for w in words]
        for rarest in (1, 16):
            want, have = brute(index, words, 0.6), index.matches(words, set(words), rarest, 0.6)
            assert want.keys() == have.keys() and all(abs(want[x] - have[x]) < 1e-9 for x in want)
        found += len(want)
    assert found > 200
