from __future__ import annotations

from ledgersync.llm import wrappers as w

LEGAL = "<p>All rights of this house are reserved by law. " * 6 + "<p>Goods are sold as seen and not taken back. " * 6


def _texts(spark, pages):
    rows = [(k, f"http://slots.example/{k}", p) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in w.extract_articles(df).collect()}


def test_a_long_notice_on_every_page_is_no_article(spark):
    pages = [f"<body><div class=c1><p>Short news item number {k} of the day</div><div class=c8>{LEGAL}</div></body>" for k in range(6)]
    assert _texts(spark, pages) == {k: f"Short news item number {k} of the day" for k in range(6)}


def test_constant_blocks_within_the_place_are_left_out(spark):
    story = "words of a paragraph that is long enough and differs " * 4
    advert, menu = "<div class=c5>Our summer sale has begun today</div>", "<ul class=c6><li><a href='/a'>One</a><li><a href='/b'>Two</a></ul>"
    pages = [f"<body><article>{menu}<h2>Facts</h2><p>{k} {story}</p>{advert}<p>End {k}</p></article></body>" for k in range(6)]
    assert _texts(spark, pages) == {k: f"Facts {k} {story.strip()} End {k}" for k in range(6)}


def test_repeated_pages_make_nothing_constant(spark):
    page = "<body><div class=c1><p>The only page of this host, seen over and over</div></body>"
    assert set(_texts(spark, [page] * 8).values()) == {"The only page of this host, seen over and over"}


def test_long_texts_of_one_beginning_and_length_differ():
    text = "The same long opening of a text that goes on for more than eighty characters before it differs, number "
    one, two, again = (w.page_terms(w.parse(f"<div class=c1>{text}{k}</div>"))[0] for k in (1, 2, 1))
    assert one == again and one != two
