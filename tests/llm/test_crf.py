import itertools
import random
import re
import time
from html import unescape

import numpy as np
import pytest

from textloom.llm import crf, plans
from textloom.llm.html_blocks import labelled_pages, leaf_blocks

SCHEMA = "page_id long, url string, html string, text int, n_chars string"


@pytest.fixture(scope="module")
def field():
    return crf.trained_field()


def test_viterbi_and_marginals_are_those_of_all_labellings():
    r = np.random.default_rng(1)
    for n in (1, 2, 5):
        s, step, start, end = r.normal(size=n), r.normal(size=(2, 2)), r.normal(size=2), r.normal(size=2)
        every = list(itertools.product((0, 1), repeat=n))
        score = np.array([start[y[0]] + end[y[-1]] + sum(s[k] * y[k] for k in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:])) for y in every])
        assert crf.BlockField({}, step, start, end).viterbi(s.tolist()) == list(every[int(score.argmax())])
        p = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        single, pairs = crf.marginals(s, step, start, end)
        for k in range(n):
            assert np.isclose(single[k, 1], sum(q for q, y in zip(p, every) if y[k]))
        for k in range(n - 1):
            assert np.isclose(pairs[k, 0, 1], sum(q for q, y in zip(p, every) if (y[k], y[k + 1]) == (0, 1)))


def test_held_out_pages(field):
    right = wanted = found = 0
    for page in labelled_pages(300, seed=77):
        scores = [sum(field.weights.get(f, 0) for f in (*crf.path_features(b.path), *crf.text_features(b))) for b in page]
        for b, label in zip(page, field.viterbi(scores)):
            right, wanted, found = right + (b.gold and label), wanted + b.gold, found + label
    assert right / wanted > 0.97 and right / found > 0.96


def test_articles_of_the_table(field):
    """The wanted text is cut out by hand: the table's articles hold paragraphs, headings and lists only."""
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    right = 0
    for p in pages:
        inside = p["html"].split("<article>")[1].split("</article>")[0]
        inside = re.sub(r"</?(?:a|b|i|em|strong|span|code)(?:\s[^>]*)?>", "", re.sub(r"(?s)<(script|style)\b.*?</\1>", " ", inside))
        right += field.extract(p["html"]) == " ".join(unescape(re.sub(r"<[^>]*>", " ", inside)).split())
    assert right >= 0.99 * len(pages)


PAGE = """<html><head><title>no</title></head><body><header class="site-header"><a href="/">Home</a></header>
<div id="cookie-notice">We use cookies.</div><article><h1>Title &amp; more</h1><p>One  two
three<br>four. <b>Five</b> six seven eight nine.<p>Second &lt;b&gt; part of it all, with words.<script>x("</p>")</script></p>
<ul><li>first point of the list<li>second point of the list</ul></article>
<section class="comments"><h3>Comments</h3><p>I like it a lot, thanks.</p></section><form><input name=q><button>Go</button></form>
<footer>&copy; 2020 me</footer></body></html>"""


def test_a_page(field):
    assert field.extract(PAGE) == (
        "Title & more One two three four. Five six seven eight nine. Second <b> part of it all, with words. "
        "first point of the list second point of the list"
    )


@pytest.mark.parametrize("html", [None, "", "   ", "<p>", "<div><p></p></div>", "<!-- only -->", "<script>x</script>", "<", "<a", "</p></div>", "<style>"])
def test_pages_without_text(field, html):
    assert field.extract(html or "") in ("", "<", "<a")


def test_rows(spark, field):
    rows = [(1, "u", PAGE, 5, "x"), (1, "u", PAGE, 5, "x"), (None, None, None, None, None), (2, "v", "", 1, "y"), (3, "w", "<article>" + "<p>some words here to read.</p>" * 20_000 + "</article>", 0, "")]
    got = crf.extract_main(spark.createDataFrame(rows, SCHEMA), field=field)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = {r.page_id: r for r in got.collect()}
    assert got.count() == 5 and by[None].text == "" and by[2].n_chars == 0 and by[3].n_chars == 20_000 * 25 - 1
    assert by[1].n_chars == len(by[1].text)
    assert crf.extract_main(spark.createDataFrame([], SCHEMA), field=field).count() == 0


def test_query_reads_every_page(spark):
    sf = "/root/testdata/sf0.001"
    assert plans.QUERIES["op7_page_text"](spark, sf).count() == plans.table(spark, sf, "pages").count()


WORDS = "Hello world, this is an article about gardens and rivers. It has words enough to read."


@pytest.mark.parametrize(
    "inside, wanted",
    [
        (f"<p title=it's>{WORDS}</p><p>We don't go there.</p><p>More to say here, friends.</p>", f"{WORDS} We don't go there. More to say here, friends."),
        (f"<p title='it\"s' data-x=\"a>b\">{WORDS}</p>", WORDS),
        (f"<p title=\"never closed>{WORDS}</p><p>More to say here, friends.</p>", f"{WORDS} More to say here, friends."),
        (f"<p/class=x>{WORDS}</p>", WORDS),
        (f"<p>{WORDS}</p><svg><path d='M0'><p>More to say here, friends.</p>", f"{WORDS} More to say here, friends."),
        (f"<p>{WORDS}</p><noscript><p>More to say here, friends.</p>", f"{WORDS} More to say here, friends."),
        (f"<p>{WORDS}</p><template><select><p>More to say here, friends.</p>", f"{WORDS} More to say here, friends."),
        (f"<p>{WORDS}</p><noscript>Turn scripts on.</noscript><svg><text>logo</text></svg><template><p>x</p></template><p>More to say here.</p>", f"{WORDS} More to say here."),
        (f"<p>{WORDS}</p><p>Energy <math><mi>E</mi></math> is conserved, as <object>they</object> <canvas>all</canvas> know.</p>", f"{WORDS} Energy E is conserved, as they all know."),
        (f"<p>{WORDS}</p><p>A < B and 3 <4, they say; x<y is a tag", f"{WORDS} A < B and 3 <4, they say; x"),
        (f"<p>{WORDS}<!-- no --> Yes.</p><![CDATA[no]]><?php no ?></>", f"{WORDS} Yes."),
        (f"<p>{WORDS}</p><script>var a = '<p>no</p>'</script ><p>Last of it, friends.</p>", f"{WORDS} Last of it, friends."),
    ],
)
def test_broken_markup_loses_nothing(field, inside, wanted):
    """Wanted texts are written by hand."""
    assert field.extract(f"<html><body><article><h1>Title</h1>{inside}") == f"Title {wanted}"
    if not inside.endswith("tag"):
        foot = "<footer>&copy; 2020 me</footer></body></html>"
        assert field.extract(f"<html><body><article><h1>Title</h1>{inside}</article>{foot}") == f"Title {wanted}"


@pytest.mark.parametrize(
    "html",
    [
        "<a " * 100_000,
        "<div>x" * 100_000,
        "<div class=a><p>x y</p>" * 30_000,
        "<a x=\"" * 100_000,
        "<a x='" * 50_000 + '"' * 50_000,
        "</p>" * 100_000 + "<foo>" * 50_000 + "</bar><li></li><td></td>" * 20_000,
        "<svg>" * 50_000 + "x" + "</svg>" * 50_000,
        "<noscript><p>x" * 50_000,
        "<title>" * 50_000,
        "<!--" * 100_000,
        "<p" + " a=b" * 100_000 + ">x",
        "&" * 200_000,
    ],
)
def test_bad_pages_take_time_by_their_length(field, html):
    start = time.perf_counter()
    field.extract(html)
    assert time.perf_counter() - start < 20


def test_scores_of_linked_elements_are_those_of_their_features(field):
    r = random.Random(5)
    pages = ["".join(r.choice(("<div>", "<div class=post>", "<article>", "</div>", "<ul><li>", "</ul>", "<noscript>", "words ", "<p>", "<b>x</b>", "<main id=main>")) for _ in range(200)) for _ in range(50)]
    for page in [*pages, PAGE]:
        scorer = crf.PathScore(field.weights, {})
        for b in leaf_blocks(page):
            path = tuple(e for e in b.path.path() if e.tag != "noscript")
            assert abs(scorer.at(b.path) - sum(field.weights.get(f, 0.0) for f in crf.path_features(path))) < 1e-9
