"""The near-duplicate stage against brute force over five-word shingles and a similarity of 0.8."""

from itertools import combinations

from postalis.llm import stages as pipeline

COUNT = 120


def brute_kept(rows):
    sets = {}
    for doc, text in rows:
        w = text.lower().split()
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    lowest = {d: d for d in sets}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while True:
        before = dict(lowest)
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
        if lowest == before:
            return {d for d in sets if lowest[d] == d}


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    rows = []
    for n in range(6):
        text = " ".join(f"w{n}x{i}" for i in range(COUNT))
        rows.append((10 * n, text))
        for k, tail in enumerate((0.10, 0.18, 0.22, 0.24, 0.27, 0.40)):  # a copy with an appended tail
            rows.append((10 * n + k + 1, text + "".join(f" t{n}x{k}x{i}" for i in range(int(tail * COUNT)))))
    long = [f"l{i}" for i in range(1000)]
    rows += [(100, " ".join(long))] + [(100 + every, " ".join(f"c{every}x{i}" if i % every == every // 2 else w for i, w in enumerate(long))) for every in (30, 40, 47, 50, 60)]  # one word in so many changed
    frame = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r.doc_id for r in pipeline.near_duplicates(spark, frame, "").collect())
    want = brute_kept(rows)
    assert got == sorted(want) and 2 not in want and 147 not in want and 6 in want and 130 in want
