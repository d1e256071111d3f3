"""Clusters around the similarity limit, many times larger than a block, against brute force."""

import random

import pytest
from test_llm import brute_classes

from postalis.llm import jaccard


@pytest.mark.parametrize("block", [8, 1024])
def test_clusters_of_borderline_copies(spark, block):
    draw = random.Random(7)
    rows = []
    common = " ".join(f"shared{i}" for i in range(60))  # a passage of many texts
    for c in range(4):
        base = [f"c{c}x{i}" for i in range(100)]
        for k in range(45):
            own = list(base)
            for _ in range(draw.randint(0, 4)):
                own[draw.randrange(100)] = f"e{draw.randrange(40)}"
            rows.append((1000 * c + k, " ".join(own)))
            if k % 3 == 0:  # drifts away step by step
                base[draw.randrange(100)] = f"d{c}x{k}"
    rows += [(5000 + i, f"{common} " + " ".join(f"own{i}x{j}" for j in range(draw.randint(3, 12)))) for i in range(60)]
    rows += [(6000 + i, common) for i in range(40)]
    draw.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), block=block).collect()}
    assert got == brute_classes(rows)


def test_forest_connects_groups_by_the_lightest_edges():
    import numpy as np

    x, y, weight = np.array([0, 0, 1, 2, 3]), np.array([2, 3, 2, 3, 4]), np.array([5, 1, 4, 2, 9])
    assert jaccard.forest(np.array([7, 7, 8, 9, 10]), x, y, weight) == [1, 3, 4]


def test_few_links_in_many_tasks_are_one_level(spark):
    from postalis.llm.common import Scratch
    from postalis.llm.graph import components

    draw = random.Random(3)
    node = [draw.getrandbits(60) for _ in range(600)]
    links = [(node[i], node[draw.randrange(max(0, i - 40), i)]) for i in range(1, 600)] + [(-5, -7), (-5, -7)]
    scratch = Scratch(spark)
    got = dict(components(spark.createDataFrame(links, "a long, b long").repartition(40), scratch).collect())
    assert got == {n: min(node) for n in node} | {-5: -7, -7: -7}
    assert scratch.n == 1
