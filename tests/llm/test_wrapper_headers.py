from __future__ import annotations

import pytest

from ledgersync.llm import wrappers as w

STORY = "Some words of a paragraph that is long enough to be the article of its page."


@pytest.mark.parametrize("header", ["<header><b>Site</b> Its slogan</header>", "<div class='site-header'>Site</div>"])
@pytest.mark.parametrize("page", ["<body>{}<p>{}<p>More</body>", "<body><div class=page>{}<p>{}<p>More</div></body>", "{}<p>{}<p>More"])
def test_site_headers_beside_paragraphs(page, header):
    page = page.format(header, STORY)
    assert w.article_text(page, w.article_path(w.page_wrapper(page))) == STORY + " More"


def test_headers_of_articles_stay():
    page = f"<body><header>Site</header><article><header><h1>Head</h1></header><p>{STORY}</article></body>"
    assert w.article_text(page, w.article_path(w.page_wrapper(page))) == f"Head {STORY}"
    page = f"<body><nav>Menu</nav><div class=c1><header><h1>Head</h1></header><p>{STORY}</div><footer>End</footer></body>"
    assert w.article_text(page, w.article_path(w.page_wrapper(page))) == f"Head {STORY}"
