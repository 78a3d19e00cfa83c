"""Marked elements that wrap the page are kept, marked parts of it are not."""

import pytest

from sparquill.llm import html_main

BODY = "<p>Alpha, beta, gamma and more.</p><p>Delta, epsilon, zeta and more.</p>"
TEXT = "Alpha, beta, gamma and more. Delta, epsilon, zeta and more."
SIDE = "<div class='sidebar'><p>Side, text.</p></div>"


@pytest.mark.parametrize("name", ["site-content has-sidebar", "no-sidebar", "with-comments", "menu-open", "comments-open", "sidebar-layout", "header-page"])
def test_wrappers_stay(name):
    for body in (f"<article>{BODY}</article>{SIDE}", f"<main>{BODY}</main>{SIDE}", f"<div>{BODY}</div>{SIDE}", f"<div class='menu-wide'><article>{BODY}</article></div>{SIDE}"):
        assert html_main.main_text(f"<body><div class='{name}'>{body}</div></body>") == TEXT
    assert html_main.main_text(f"<main><div class='{name}'><article>{BODY}</article></div></main>{SIDE}") == TEXT


def test_header_marks_in_an_article_stay():
    assert html_main.main_text(f"<article><div class='entry-header'><h1>Title</h1></div>{BODY}{SIDE}</article>") == "Title " + TEXT
    assert html_main.main_text(f"<div class='site-header'><p>Name, of, site</p></div><article>{BODY}</article>") == TEXT


def test_comments_and_related_articles_go():
    many = "<p>Reader, says, so, much, more, and, more.</p>" * 9
    assert html_main.main_text(f"<div class='post'>{BODY}</div><div class='comments-list'>{many}</div>") == TEXT
    assert html_main.main_text(f"<article>{BODY}<div id='comments'>{many}</div></article>") == TEXT
    assert html_main.main_text(f"<article>{BODY}</article><div class='related'><article>{many}</article></div>") == TEXT
    assert html_main.main_text(f"<div class='menu-wide'><article>{BODY}</article><div class='related'><article><p>Card, text.</p></article></div></div>") == TEXT


def test_deep_wrappers():
    assert html_main.main_text("<div class='menu'>" * 20_000 + "deep, text") == "deep, text"
