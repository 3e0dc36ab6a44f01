"""Articles cut into sections and wrappers, and wrappers named after what they lack."""

import pytest

from lapsewise.llm import html_text

HEAD, LEAD = "Headline of forty letters, more or less", "lead " * 60
PARTS = ["first " * 117, "second " * 100]
WHOLE = "\n".join([HEAD, LEAD.strip(), *(p.strip() for p in PARTS)])
TOP = f"<h1>{HEAD}</h1><p>{LEAD}</p>"
MENU = "<div><a href='/'>Menu of the site</a> <a href='/b'>and some more</a></div>"


def sections(tag):
    return "".join(f"<{tag}><p>{p}</p></{tag}>" for p in PARTS)


@pytest.mark.parametrize(
    "body",
    [
        f"<article>{TOP}{sections('section')}</article>",
        f"<article>{TOP}<div><div><div><div><div>{sections('div')}</div></div></div></div></div></article>",
        f"<div class='post'>{TOP}{sections('div')}<div class='related-posts'>More</div></div>",
        f"<div><div class='content no-sidebar'>{TOP}{sections('section')}</div></div>",
        f"<article class='post has-banner'>{TOP}{sections('div')}<div class='comments'><p>{'nice ' * 40}</p></div></article>",
        f"<main id='main-related'>{TOP}{sections('section')}</main>",
        f"<div class='widget'><article>{TOP}{sections('section')}</article></div>",
    ],
)
def test_whole_article_of_sections_and_wrappers(spark, body):
    page = f"<html><body>{MENU}{body}<div class='cookie-notice'><p>We use cookies</p></div><footer>End</footer></body></html>"
    assert html_text.extract(page, None) == WHOLE
    pages = spark.createDataFrame([(i, "http://a.b/x", page) for i in range(3)], "page_id long, url string, html string")
    assert [r.text for r in html_text.main_text(pages).collect()] == [WHOLE] * 3


def test_climbing_stops_at_links_and_left_out_text():
    side = f"<div class='sidebar'><p>{'side ' * 120}</p></div>"
    page = f"<body><div class='layout'><div class='post'>{TOP}{sections('div')}</div>{side}{MENU}</div></body>"
    assert html_text.extract(page, None) == WHOLE


def test_names_that_mark_additions():
    gone = ["class='ad'", "class='box ad-slot-3'", "id=cookie-notice", "role=navigation", "class='related_posts'"]
    kept = ["class='no-sidebar'", "class='has-banner'", "id='main-related'", "class='social-history'", "class='adverse'"]
    assert all(html_text._is_addition(f" {r}") for r in gone) and not any(html_text._is_addition(f" {r}") for r in kept)
