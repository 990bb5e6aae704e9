from __future__ import annotations

import pytest

from ledgersync.llm import wrappers as w

STORY = "Some words of a paragraph that is long enough to be the article of its page."


@pytest.mark.parametrize("name", ["overflow-hidden", "layout has-sidebar", "post comments-open", "content-sidebar", "no-sidebar"])
@pytest.mark.parametrize("page", ["<body><div class='{}'><p>" + STORY + "</div></body>", "<body><div class='{}'><article><p>" + STORY + "</article></div></body>", "<body><article class='{}'><p>" + STORY + "</article></body>"])
def test_a_fragment_of_a_name_drops_no_article(page, name):
    page = page.format(name)
    assert w.article_text(page, w.article_path(w.page_wrapper(page))) == STORY


@pytest.mark.parametrize("name", ["promo-box", "related-posts", "site-footer", "comments", "sideBar", "hidden"])
def test_names_still_drop(name):
    page = f"<body><article><p>{STORY}<div class='{name}'>Else</div></article></body>"
    assert w.article_text(page, w.article_path(w.page_wrapper(page))) == STORY
