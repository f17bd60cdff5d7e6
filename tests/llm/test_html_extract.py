from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from verdigris.llm.html_extract import extract, main_text
from verdigris.llm.queries import QUERIES

LONG = "A paragraph of the story, with commas, and enough words to be taken for running text, surely."


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        (None, ""),
        ("", ""),
        ("plain  text\n only", "plain text only"),
        ("<article><h1>T</h1><p>One.</p><p>Two &amp; &eacute;&#x41;&copy</p></article>", "T\n\nOne.\n\nTwo & éA©"),
        ("<article><p>One<p>Two <b>bold</b>er<br>line</article>", "One\n\nTwo bolder line"),
        (f"<body><nav><a>Menu</a></nav><div class='post'><h1>T</h1><p>{LONG}</p></div><footer>F</footer></body>", f"T\n\n{LONG}"),
        (f"<div id=sidebar><p>{LONG}</p></div><article><p>Short.</p></article>", "Short."),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG} no</p></section></article>", LONG),
        (f"<article><p>{LONG}</p><form><p>Mail</p></form><aside>Also</aside><div class=\"cookie-notice\">Ok?</div></article>", LONG),
        ("<article><script>var t='</p><p>no';</script><style>p{}</style><!-- <p>no --><p>Yes</p>", "Yes"),
        ("<article><p>Cut off<script>var never_ends", "Cut off"),
        ("<article><p>Open comment <!-- never ends <p>no", "Open comment"),
        ("<article><ul><li>a<li>b<p>c</ul><table><tr><td>x<td>y</table></article>", "a\n\nb\n\nc\n\nx\n\ny"),
        ("<article><p title='a > b'>Quoted</p><p hidden>no</p><p style='display:none'>no</p></article>", "Quoted"),
        ("<article><p>a < b and c</p></article>", "a < b and c"),
        ("<article><header class='entry-header'><h1>Head</h1></header><p>Body.</p></article>", "Head\n\nBody."),
    ],
)
def test_cases(source, expected):
    assert main_text(source) == expected


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 20_000 + "deep").endswith("deep")
    assert main_text("<article><p>" + "word " * 400_000 + "</p></article>").count(" ") == 399_999
    assert main_text('<p class="' * 3_000 + "x") is not None


def test_query_gives_the_articles(spark):
    rows = QUERIES["op4_html_text"](spark, SMALL).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for row in rows:
        body = re.search(r"<article>(.*?)</article>", pages[row.page_id].html, re.S)[1]
        parts = (html.unescape(re.sub(r"</?b>|<br>", " ", x)) for x in re.split(r"</?(?:p|h1)>", body))
        assert row.text == "\n\n".join(" ".join(p.split()) for p in parts if p.strip())
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_columns(spark):
    pages = spark.createDataFrame([(1, None), (1, None), (None, "<p>x")], "page_id long, html string")
    found = extract(pages.select("*", F.lit(1).alias("text"), F.lit(2).alias("n_chars"), F.lit(3).alias("a.b")))
    assert found.columns == ["page_id", "html", "a.b", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in found.collect()) == [("", 0), ("", 0), ("x", 1)]
    assert extract(pages.limit(0)).count() == 0
