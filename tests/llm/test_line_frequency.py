"""Line frequency counts distinct documents: lines of shared blocks count like single lines."""

import pytest

from postalis.llm import quality

BODY = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
HEADER = "Home and news\nAll the topics\nSign in here"
FOOTER = "About this place\nTerms of our use\nWrite us a letter"


@pytest.mark.parametrize("broadcast_lines", [500_000, -1])
def test_blocks_of_lines_in_different_documents(spark, broadcast_lines):
    rows = [(i, f"{HEADER}\nstory {i} {BODY}\n{FOOTER}", "h") for i in range(40)]
    rows += [(100 + i, f"{HEADER}\nmenu {i} one two three\n{FOOTER}", "h") for i in range(40)]  # little is left of these
    rows += [(200 + i, f"{BODY}\n{FOOTER.upper()}", "copies") for i in range(40)]  # one text forty times
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality.judge(frame, quality.Rules(broadcast_lines=broadcast_lines)).collect()}
    assert all((got[i].n_removed_lines, got[i].kept, got[i].clean_text) == (6, True, f"story {i} {BODY}") for i in range(40))
    assert all((got[100 + i].n_removed_lines, got[100 + i].kept) == (6, False) for i in range(40))
    assert all((got[200 + i].n_removed_lines, got[200 + i].kept) == (0, True) for i in range(40))


def test_hot_and_small_hosts_and_copies_of_other_texts(spark):
    rows = [(i, ("Read more of this\n" if i < 150 else "") + f"story {i} {BODY}", "hot") for i in range(32_000)]
    rows += [(40_000 + i, ("Read more of this\n" if i < 30 else "") + f"story {i} {BODY}", "small") for i in range(60)]
    rows += [(50_000 + i, "Read more of this\n" + f"story {i} {BODY}", "copies") for i in range(30)] + [(60_000 + i, BODY, "copies") for i in range(8_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    got = {r.doc_id for r in quality.judge(frame).filter("n_removed_lines = 1").collect()}
    assert got == {*range(150), *range(40_000, 40_030), *range(50_000, 50_030)}
