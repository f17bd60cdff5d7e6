from __future__ import annotations

import pytest

from tests.llm.test_html_extract import LONG
from verdigris.llm.html_extract import main_text


@pytest.mark.parametrize("around", ["article", "main"])
@pytest.mark.parametrize(
    "attribute",
    ["id='search-algorithms'", "id='football'", "id='social-history'", "class='footnotes'", "id='navier-stokes'", "id='menuetto'",
     "id='commentary'", "id='promoter-genes'", "id='noticeable-effects'", "id='shareholders'", "id='related-work'"],
)
def test_article_sections_whose_names_begin_like_other_parts(around, attribute):
    source = f"<{around}><p>{LONG}</p><section {attribute}><h2>H</h2><p>Kept.</p></section></{around}>"
    assert main_text(source) == f"{LONG}\n\nH\n\nKept."


@pytest.mark.parametrize(
    "attribute",
    ["class=nav", "id=menu", "class='footer'", "id='comments'", "class='cookie-notice'", "class='share-buttons'", "class='x sidebar-left'",
     "class='commentlist'", "class='related-posts'", "class='post-footer'", "id='ad-1'", "class='social-links'"],
)
def test_whole_names_are_still_left_out(attribute):
    assert main_text(f"<article><p>{LONG}</p><div {attribute}><p>{LONG} no</p></div></article>") == LONG


def test_captions_formulas_and_noscript_are_text():
    caption = f"<article><p>{LONG}</p><figure><img src=a><figcaption>The caption.</figcaption></figure></article>"
    assert main_text(caption) == f"{LONG}\n\nThe caption."
    formula = (
        "<math><semantics><mrow><mi>x</mi><mspace width='1em'/><mo>=</mo><mn>2</mn></mrow>"
        "<annotation encoding='application/x-tex'>x=2</annotation></semantics></math>"
    )
    assert main_text(f"<article><p>Let {formula} hold.</p></article>") == "Let x=2 hold."
    assert main_text(f"<article><p>{LONG}</p><noscript><p>Plain.</p></noscript></article>") == f"{LONG}\n\nPlain."
    assert main_text(f"<noscript><p>Enable scripts.</p></noscript><article><p>{LONG}</p></article>") == LONG


@pytest.mark.parametrize("tag", ["article", "main"])
def test_siblings_of_an_article(tag):
    assert main_text(f"<body><h1>Title</h1><{tag}><p>{LONG}</p></{tag}></body>") == f"Title\n\n{LONG}"


def test_second_article():
    second = LONG.replace("story", "sequel")
    source = f"<body><nav><a>Menu</a></nav><article><p>{LONG}</p></article><article><p>{second}</p></article><footer>F</footer></body>"
    assert main_text(source) == f"{LONG}\n\n{second}"
