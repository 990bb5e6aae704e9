from __future__ import annotations

import html
import re

import pytest

from ledgersync.llm import wrappers as w


def _planted(page: str) -> str:
    """The text of the test pages' one template, read by its own marks."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br|li|ul|div)\b[^>]*>", body)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", t)).split()) for t in parts)
    return " ".join(t for t in texts if t)


def test_all_pages_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in w.op3_page_articles(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == _planted(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def _page(k: int, place: str, words: str) -> str:
    items = "".join(f"<li><a href='/{i}'>item {i} of the long menu of this site</a>" for i in range(3 + k % 3))
    extra = "<div class='promo-box'>Buy now!</div>" if k % 2 else ""
    return (
        f"<html><head><title>T{k}</title><script>if (a < b) document.write('<p>no</p>')</script></head><body><header><h2>Site</h2></header><ul class=menu>{items}</ul>{extra}"
        f"<div class=wrap><div class='sidebar'><p>About us {k}</div>{place.format(f'<h1>Head {k}</h1><p>{words} {k} &amp;amp; caf&eacute;<p>Second <i>in</i>line<br>break<ul><li>x{k}<li>y</ul><form><p>search</form>')}"
        f"<div id=comments><p>Reader {k}: nice</p></div></div><footer>(c) {k}</footer></body></html>"
    )


@pytest.mark.parametrize("place", ["<article>{}</article>", "<div class='entry-content'>{}</div>", "<main>{}</main>", "<div class='c7'>{}</div>", "<td>{}</td>"])
def test_places_of_articles(spark, place):
    words = "some words of a long enough paragraph that varies from page to page " * 3
    rows = [(k, f"http://Host.example/{k}?q", _page(k, place, words), "x", "h") for k in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string").repartition(5)
    for r in w.extract_articles(df).collect():
        k = r.page_id
        assert r.text == f"Head {k} {' '.join(words.split())} {k} &amp; café Second inline break x{k} y", r.text


def test_hostile_pages(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [
        (1, None, None, ""), (2, "", "", "h"), (3, "nonsense", "plain   text &lt;b&gt;", "h"), (4, "http://a", "<p>a<p>b<", "h"),
        (5, "http://a", deep, "h"), (6, "http://b", "<article>" + "<p>w " * 50_000, "h"), (6, "http://b", "<article>" + "<p>w " * 50_000, "h"),
        (None, "http://c", "<article><p>x</article><!-- open", "h"), (7, "http://c", "<article></article>", "h"), (8, "http://d", "<p class='a\" b>c", "h"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in w.extract_articles(df).collect()}
    assert got[1] == got[2] == got[7] == "" and got[3] == "plain text <b>" and got[5] == "deep" and got[None] == "x"
    assert got[6] == " ".join(["w"] * 50_000) and got[4].startswith("a b")
    assert w.extract_articles(df.limit(0)).count() == 0


def test_wrapper_terms():
    one = w.page_terms(w.parse("<body><h1>A</h1><dl><dt>a<dd>b<dt>c<dd>d</dl><p>same</p></body>"))[0]
    two = w.page_terms(w.parse("<body><h1>B</h1><dl><dt>e<dd>f</dl><p>same</p><p>more</p><h2>x</h2></body>"))[0]
    body = w.merge(one, two)[0]
    assert [(t[1], t[2], t[3]) for t in body[7]] == [("h1", False, False), ("dl", False, False), ("p", False, True), ("h2", True, False)]
    assert body[7][0][7] == [["t", None, False]] and body[4] == 2
