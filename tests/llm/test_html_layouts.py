"""Layouts that the classifier must tell apart, and time linear in a page."""

from __future__ import annotations

import time

import pytest

from tabsmith.llm import html_text

TREE = html_text.default_tree()


def text_of(page):
    return html_text.main_text(page, TREE)


PROSE = "It was a long and quiet evening by the river, and nobody spoke of the day that had gone by. "


@pytest.mark.parametrize(
    "page,want",
    [
        ("<h1>Poem</h1><p>line one here<p>line two now<p>line three ends", "Poem\nline one here\nline two now\nline three ends"),
        ("<h1>List</h1><ul><li>milk</li><li>eggs</li></ul>", "List\nmilk\neggs"),
        ("<p>one short paragraph</p>", "one short paragraph"),
        (f"<p>{PROSE}</p><p>The end of it.</p>", f"{PROSE.strip()}\nThe end of it."),
        ('<div class="alert-page"><h1>Title</h1><p>a short text on it</p></div>', "Title\na short text on it"),
        (f'<div class="alert-page"><p>{PROSE}</p></div>', PROSE.strip()),
        ("İ<article><SCRIPT>var x</SCRIPT><p>after the script</p></article>", "after the script"),
        ("<article><STYLE>p {}</STyle ><p>after the style</p></article>", "after the style"),
    ],
)
def test_short_and_odd_pages_are_kept_whole(page, want):
    assert text_of(page) == want


@pytest.mark.parametrize(
    "frame",
    [
        '<span class="advert">buy now</span>', "<span hidden>unseen</span>", '<b style="display: none">unseen</b>', '<span class="AdBox">buy <span>one</span> now</span>',
        '<div class="userComments"><p>nice one</p></div>', "<div class=promoBox>get it</div>", '<section id="user-reviews"><p>good</p></section>',
        "<div class=responses><p>hey you</p></div>", '<div style="color:red;display:none">unseen</div>', '<div class="user_comments">x y</div>',
    ],
)
def test_frames_within_an_article_go(frame):
    assert text_of(f"<article><p>Text {frame} goes on here</p></article>").split() == "Text goes on here".split()
    assert text_of(f"<p>{PROSE}</p>{frame}<p>{PROSE}</p>").split() == (PROSE * 2).split()


def test_a_muted_line_ends_with_its_block():
    assert text_of('<article><p>one <span class="ad">two</p><p>three</p></article>') == "one\nthree"
    assert text_of('<article><p>one <span class="comment">two</span></p></article>') == "one two"


def test_menus_and_footers_of_short_blocks_go():
    menu = "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(6))
    page = f'<ul>{menu}</ul><h1>Head</h1><p>{PROSE}</p><p>{PROSE}</p><p><a href="/">Home</a></p>'
    assert text_of(page) == f"Head\n{PROSE.strip()}\n{PROSE.strip()}"


@pytest.mark.parametrize("name", ["", ' class="page-sidebar-xyz"', ' class="sidebar"'])
@pytest.mark.parametrize("ends", ["</div>", "</section>", "</p>", ""])
def test_time_is_linear_in_nesting(name, ends):
    n = 20_000
    begin = time.process_time()
    text_of(f"<div{name}>x " * n + "hello" + f"y{ends}" * n)
    assert time.process_time() - begin < 5


def test_wrappers_around_wrappers_are_judged_from_the_outside():
    inner = f'<div class="widget-zone-a"><p>{PROSE * 4}</p></div><div class="widget-zone-b"><p>{PROSE}</p></div>'
    assert text_of(f'<div class="no-sidebar"><div class="form-outer">{inner}</div></div>') == (PROSE * 4).strip()
