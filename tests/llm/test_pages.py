"""Main text of pages whose names or nesting mislead, and pages that are broken at length."""

import time

import pytest

from shardweave.llm.html_text import main_text

BODY = "<p>" + "The article says a lot of things about the world. " * 6 + "</p>"
SIDE = '<div class="sidebar"><p>Side text here for you</p></div><div class="related-posts"><a href=x>More of it</a></div>'


def page(around: str) -> str:
    return f"<html><body>{around % (BODY * 3)}{SIDE}</body></html>"


@pytest.mark.parametrize(
    "around",
    [
        '<div class="content-with-sidebar">%s</div>',
        '<div class="main-content two-column-sidebar-left">%s</div>',
        '<div class="post-legal-news">%s</div>',
        '<div class="entry-content share-enabled">%s</div>',
        '<div class="col-with-ads">%s</div>',
        '<div class="product-reviews-article">%s</div>',
        '<div class="story alert-free">%s</div>',
        '<div id="search-results">%s</div>',
        '<form action=x>%s<input name=a><label>Your name</label></form>',
        "<form><article>%s</article></form>",
        '<div class="page-with-ads"><form><div class="story-comments-off">%s</div></form></div>',
    ],
)
def test_names_that_mislead(around):
    found = main_text(page(around))
    assert found.count("The article says") == 18
    assert "Side" not in found and "More of it" not in found and "Your name" not in found


@pytest.mark.parametrize("name", ["sidebar", "ad-box", "cookie-banner", "related-posts", "comments", "search-box"])
def test_side_matter_goes(name):
    found = main_text(page("%s" + f'<div class="{name}"><p>Not of the article at all</p></div><form>Sign up now</form>'))
    assert found.count("The article says") == 18 and "Not of" not in found and "Sign up" not in found


N = 100_000
LONG = {
    "nested blocks": "<div>" * N,
    "open paragraphs": "<div><p>some text here</p>" * (N // 2),
    "open inline": "<b>x" * N,
    "nested articles": "<article><p>word word" * (N // 2),
    "unclosed tags": "<a " * N,
    "unclosed quotes": '<a "' * N,
    "mixed quotes": "<a '\"x" * N + ">",
    "names": "<a" * N,
    "stray ends": "<div>" * (N // 2) + "</b>" * (N // 2),
    "stray inline ends": "<i><div>" + "<b>" * (N // 2) + "</i>" * (N // 2),
    "rules in inline": "<b>" * (N // 2) + "<hr>" * (N // 2),
    "paragraphs in pre": "<pre>" * (N // 2) + "<p></p>" * (N // 4),
    "lists": "<ul><li>x" * (N // 2),
    "tables": "<table><tr><td>x" * (N // 3),
    "attributes": '<a href="x>' * N,
}


@pytest.mark.parametrize("kind", LONG)
def test_time_grows_with_the_page(kind):
    begun = time.process_time()
    main_text(LONG[kind])
    assert time.process_time() - begun < 6  # some seconds even on a busy machine; growth with the square took hours


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a < b and <c", "a < b and <c"),
        ('<p>x <a href="y>z</p>', 'x <a href="y>z'),
        ("<p>one <!-- two", "one"),
        ("<p>one<b>two</b></i>three</p>", "onetwothree"),
        ("<p>1 <2 <3> 4</p>", "1 <2 <3> 4"),
        ("<div><p>one</div><p>two", "one two"),
    ],
)
def test_broken_markup(html, text):
    assert main_text(html) == text
