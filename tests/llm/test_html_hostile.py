from __future__ import annotations

import time

import pytest

from tests.llm.test_html_extract import LONG
from verdigris.llm.html_extract import main_text


@pytest.mark.parametrize(
    ("head", "head_of", "tail", "tail_of"),
    [
        ("<div>a", 6, "", 1),
        ("<a ", 3, "", 1),
        ('<a ">" ', 7, "", 1),
        ("<a \"<b '>", 9, "", 1),
        ("<a<a", 4, "", 1),
        ("<!-", 3, "", 1),
        ("<b>", 20, "<p>some text</p>", 20),
        ("<div>", 10, "</p>", 8),
        ("<b><p>x" + "<i>" * 1000, 6000, "</b>", 8),
        ("<li><ul>" + "<div>" * 1000, 8000, "<li>x</li>", 18),
        ("<p>x" + "<p class", 16, ">", 1_000_000),
    ],
)
def test_time_grows_with_the_page(head, head_of, tail, tail_of):
    """A quarter and a whole megabyte; a quadratic walk takes minutes on the second."""

    def seconds(size: int) -> float:
        page = head * (size // head_of) + tail * (size // tail_of)
        start = time.process_time()
        main_text(page)
        return time.process_time() - start

    small, large = seconds(250_000), seconds(1_000_000)
    assert large < max(10 * small, 2.0)


@pytest.mark.parametrize(
    "opened",
    ["<p title='the hidden valley'>", "<p title='role=dialog class=ad'>", "<p data-note='display: none'>", "<p data-hidden=no>", '<p title="a > b">'],
)
def test_attribute_values_do_not_hide(opened):
    assert main_text(f"<article><p>{LONG}</p>{opened}Kept.</p></article>") == f"{LONG}\n\nKept."


@pytest.mark.parametrize("attribute", ["hidden", "hidden=''", "style='color:red;display : none'", "aria-hidden=true", "role=dialog"])
def test_hidden_parts(attribute):
    assert main_text(f"<article><p>{LONG}</p><div {attribute}><p>{LONG} no</p></div></article>") == LONG


def test_names_outside_an_article_that_begin_like_other_parts():
    assert main_text(f"<body><div class='football-report'><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG}\n\n{LONG}"
    parts = f"<div id='search-algorithms'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>A teaser.</p></div>"
    assert main_text(f"<body>{parts}</body>").startswith("\n\n".join([LONG] * 3))


@pytest.mark.parametrize("inside", ["", "article"])
@pytest.mark.parametrize(
    "part",
    ["section class='reader-comments'", "div id='discussion'", "div class='user-comments'", "div id=primary-menu", "div class='global-nav'"],
)
def test_other_parts(inside, part):
    source = f"<div class=story><p>{LONG}</p><p>{LONG}</p></div><{part}><p>{LONG} no</p><p>{LONG} no</p></{part.split()[0]}>"
    if inside:
        source = f"<{inside}>{source}</{inside}>"
    assert main_text(f"<body>{source}</body>") == f"{LONG}\n\n{LONG}"


def test_a_section_of_a_paper_is_no_comment():
    assert main_text(f"<article><p>{LONG}</p><section id=discussion><p>Found.</p></section></article>") == f"{LONG}\n\nFound."


def test_form_around_the_page():
    page = f"<body><form id=frame><input type=hidden><nav><a>Menu</a></nav><div><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div></form></body>"
    assert main_text(page) == f"T\n\n{LONG}\n\n{LONG}"
    assert main_text(f"<form><article><p>Short.</p></article></form><p>{LONG}</p>").startswith("Short.")


@pytest.mark.parametrize("form", [f"<form><p>{LONG}</p></form>", "<form class=x><label>Mail</label><input><p>Send us your views.</p></form>"])
def test_forms_of_the_page(form):
    assert main_text(f"<article><p>{LONG}</p>{form}</article>") == LONG
    assert main_text(f"<body><div><p>{LONG}</p><p>{LONG}</p></div>{form}</body>") == f"{LONG}\n\n{LONG}"
    assert main_text("<form><label>Name</label><input><p>Log in.</p></form>") == ""
