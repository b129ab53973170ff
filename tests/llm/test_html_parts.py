"""Headers, notices, side columns and lists of links around an article, and those that belong to it."""

import pytest

from ratesmith.llm import html_extract

BODY = "<p>First sentence of an article, which is long.</p><p>Another paragraph with <b>bold</b> words in it, long too.</p>"
WANT = "First sentence of an article, which is long.\nAnother paragraph with bold words in it, long too."
NOTICE = "<p>" + "We use cookies to make this site better, and you may accept them all or none. " * 6 + "</p>"
LINKS = "<ul class='links'><li><a href='/a'>One</a></li><li><a href='/b'><b>Two</b></a></li></ul>"
PAGES = {
    "header beside the text": f"<body><div class='main'><header><p>Site</p><p>Slogan text.</p></header>{BODY}</div>",
    "header by its class": f"<body><div class='content'><div class='header'><a href='/'>Site</a><p>Slogan text.</p></div>{BODY}</div>",
    "header with a heading outside an article": f"<body><header><h1>Site</h1></header>{BODY}</body>",
    "header without a heading in an article": f"<article><header><a href='/'>Site</a></header>{BODY}</article>",
    "header left open": f"<body><header><a href='/'>x</a><div class='main'>{BODY}</div></body>",
    "notice longer than the article": f"<body><div class='cookie-consent'>{NOTICE}</div><div class='main'>{BODY}</div></body>",
    "side column longer than the article": f"<body><div class='main'>{BODY}</div><div class='sidebar'>{NOTICE}</div></body>",
    "notice in a wrapper with a noisy name": f"<body><div class='layout-sidebar'><div class='cookie-consent'>{NOTICE}</div><div class='main'>{BODY}</div></div></body>",
    "all of the text under a noisy name": f"<body><div class='widget'>{BODY}</div></body>",
    "list of links": f"<body><div class='main'>{BODY}{LINKS}</div>",
    "row of links": f"<body><div class='main'>{BODY}<div><a href='/a'>One</a> &middot; <a href='/b'>Two</a></div></div>",
}


@pytest.mark.parametrize("name", PAGES)
def test_what_surrounds_an_article_goes(name):
    assert html_extract.main_text(PAGES[name], None) == WANT


def test_an_articles_own_parts_stay():
    page = f"<body><header>Top</header><article><header><h1><a href='/x'>A</a> <a href='/y'>title</a></h1><p>By one of us.</p></header>{BODY}<ul><li><a href='/a'>One</a> says more<li><a href='/b'>Two</a></ul><p><a href='/c'>One link alone</a></p></article>"
    assert html_extract.main_text(page, None) == f"A title\nBy one of us.\n{WANT}\nOne says more\nTwo\nOne link alone"


def test_an_anchor_left_open_makes_no_link_of_the_text():
    assert html_extract.main_text(f"<body><div class='main'><a name='top'>{BODY}</div>", None) == WANT
