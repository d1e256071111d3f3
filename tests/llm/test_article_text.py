"""Article text that names alone would drop stays, parts around it go: the messages decide, which a rule on names can't."""

import pytest

from postalis.llm import htmltext

LONG = "Some text that belongs to the article and says something of substance. " * 2
NAVIGATION = "<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>"
KEPT = {
    "section": f'<section id="related-work"><h2>KEEP Related work</h2><p>KEEP {LONG}</p></section>', "social": f'<div class="social-science"><p>KEEP {LONG}</p></div>', "cookie": f'<div class="cookie-recipe"><p>KEEP {LONG}</p></div>',
    "share": f'<div id="share-prices"><p>KEEP {LONG}</p></div>', "paragraph": f'<p class="related">KEEP {LONG}</p>', **{f"heading {i}": f'<h2 id="{i}">KEEP heading</h2><p>{LONG}</p>' for i in ("login", "navigation", "comments", "social")},
    "list": "<ul>" + "".join(f'<li><a href="/{i}">KEEP source number {i}</a></li>' for i in range(5)) + "</ul>",
}
GONE = {
    "comments": '<div class="comments"><p>GO I liked this a lot, thanks</p><p>GO me too, great read indeed</p></div>', "advert": '<div class="ad-banner"><p>GO Buy now cheap shoes</p></div>',
    "related": '<div class="related"><ul><li><a href="/x">GO other story</a></li><li><a href="/y">GO third story</a></li></ul></div>', "posts": '<div class="related-posts"><h3>GO More</h3><ul><li><a href="/x">GO other story</a></li><li><a href="/y">GO third story</a></li></ul></div>',
    "share": '<div class="share-buttons"><a href="/t">GO Tweet</a> <a href="/f">GO Post</a></div>', "newsletter": '<div class="newsletter-signup"><p>GO Subscribe to our letter</p></div>', "form": "<form><p>GO name</p></form>", "aside": "<aside><p>GO pull</p></aside>",
    "sponsored": f'<div class="sponsored"><p>GO {LONG}</p></div>', "notice": '<div class="cookie-notice"><p>GO We use cookies to improve your experience.</p></div>', "hidden": f"<p hidden>GO {LONG}</p>",
}


@pytest.fixture(scope="module")
def model(spark):
    return htmltext.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def page(part):
    text = "<p>" + "A long paragraph of the article with many words. " * 4 + "</p>"
    return f"<html><body>{NAVIGATION}<div class='layout'><article><h1>Title of the piece</h1>{text}{part}{text}</article><aside class='sidebar'><p>Side note here</p></aside></div><footer>(c) 2024</footer></body></html>"


@pytest.mark.parametrize("kept", [True, False])
def test_names_alone_decide_nothing(spark, model, kept):
    own = KEPT if kept else GONE
    rows = [(i, "u", page(part)) for i, part in enumerate(own.values())]
    found = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    for i, (name, part) in enumerate(own.items()):
        assert found[i].count("KEEP") == part.count("KEEP") and "GO" not in found[i], name
        assert "Side note" not in found[i] and "Home" not in found[i] and found[i].count("A long paragraph") == 8


def test_null_and_repeated_pages(spark, model):
    html = page("")
    rows = [(None, None, html), (None, None, html), (1, "u", None), (2, "u", "")]
    found = [tuple(r) for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()]
    assert found[0] == found[1] and found[0][:2] == (None, None) and found[0][3] == len(found[0][2]) > 100 and [r[2:] for r in found[2:]] == [("", 0)] * 2
