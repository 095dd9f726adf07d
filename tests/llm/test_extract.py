from __future__ import annotations

import pytest

from caremarts.llm import extract as X

FULL = """<!DOCTYPE html><html><head><title>Site - Big title</title><style>p{margin:0}</style></head><body>
<header><a href="/">Home page of the site</a></header><nav><ul><li><a href="/a">one</a></li><li>two</li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this page, please agree</p></div>
<main><article><header><h1>Big title</h1></header><p>First <b>bold</b> words with <a href=x>a link</a> &amp; more.</p>
<ul><li>one item</li><li>two   items</li></ul><aside><p>Related things to read elsewhere</p></aside>
<form><p>Subscribe now</p><input><button>Go</button></form><p>Second paragraph<br>after a break, long enough.</p></article>
<section id="comments"><p>A reader says hello to everyone here</p><article class="comment"><p>Another reader</p></article></section>
</main><div class="sidebar"><p>Popular pages of this month</p></div><footer><p>&copy; somebody</p></footer>
<script>var a = "<p>not text</p>";</script><!-- <p>not this</p> --></body></html>"""
MAIN = "Big title\nFirst bold words with a link & more.\none item\ntwo items\nSecond paragraph after a break, long enough."


def learned(pages):
    """Weights as ``fit`` makes them, without Spark."""
    import math

    counts = X.count_labels(pages)
    inside, outside = counts.pop("")
    base = math.log((inside + 1) / (outside + 1))
    out = {}
    for f, (a, b) in counts.items():
        odds = math.log((a + 1) / (b + 1)) - base
        mixed = ((a + b) * odds + X.PRIOR_WORDS * X.prior(f)) / (a + b + X.PRIOR_WORDS)
        out[f] = max(-0.3 if f in X.LISTS else -4.0, min(2.0, mixed))
    return out


@pytest.mark.parametrize("weights", [{}, learned([FULL] * 50)], ids=["priors", "learned"])
def test_article_without_what_surrounds_it(weights):
    assert X.Extractor(weights)(FULL) == MAIN


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>cut off in a <b>tag <a hre", "cut off in a tag"),
        ("<p>a &lt;b&gt; &#233;&eacute; &nosuch; &amp", "a <b> éé &nosuch; &"),
        ("<p>one<p>two<div>three</div>four", "one\ntwo\nthree\nfour"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<div class=content><h2>Head</h2><p>Body \t\n text\xa0here</p></div><div class='sidebar'><p>no</p></div>", "Head\nBody text here"),
        ('<p title="a > b">quoted</p>', "quoted"),
        ("<script>x", ""),
        ("<nav>only a menu</nav>", ""),
        ("<!-- never closed <p>x</p>", ""),
        ("<P>UPPER<BR>case</P>", "UPPER case"),
    ],
)
def test_small_pages(page, text):
    assert X.Extractor({})(page) == text


def test_region_is_the_best_contiguous_one():
    page = "<p>few words</p>" + "<hr>" * 40 + "<p>" + "many words in this block " * 20 + "</p>"
    assert X.Extractor({})(page) == ("many words in this block " * 20).strip()


def test_table_of_pages(spark):
    rows = [(1, "u", FULL), (2, "u", None), (3, None, ""), (None, "u", "<p>x y"), (5, "u", "<p>" + "word " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'old' as TEXT")
    got = {r.page_id: r for r in X.page_texts(pages).collect()}
    assert len(got) == 5 and got[1].text == MAIN and got[1].n_chars == len(MAIN)
    assert got[2].text == got[3].text == "" and got[None].text == "x y" and got[5].n_chars == 249_999
    assert X.page_texts(pages.limit(0)).count() == 0


def test_every_marked_page_teaches(spark):
    def made(i, name):
        return f"<main><p class={name}>word{i} one two three</p></main><p class=odd>four {i}</p>"

    marked = [made(i, "good") for i in range(40)]
    blank = spark.range(25_000).selectExpr("concat('<p>plain page ', id, '</p>') as html")  # more pages than any sample
    pages = blank.union(spark.createDataFrame([(p,) for p in marked], "html string"))
    got = X.fit(pages)
    want = learned(marked)
    assert set(got) == set(want) and all(abs(got[f] - want[f]) < 1e-9 for f in want)
