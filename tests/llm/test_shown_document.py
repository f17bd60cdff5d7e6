from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.llm import url_reputation as u
from verdigris.llm.queries import QUERIES

SHOWN = {
    "https://a.example.org/en/7817": 7817,
    "https://a.example.org/en/7817/": 7817,
    "http://a.example.org/en/199.html?x=5#7": 199,
    "http://a.example.org/en/12#top": 12,
    "http://a.example.org/page?id=5": None,
    "http://a.example.org/en/5/more": None,
    "http://a.example.org/en/x5": None,
    "http://a.example.org/5\n": None,
    "http://a.example.org/" + "9" * 30: None,
    "http://5": None,
    "5": None,
    None: None,
}


def test_the_number_at_the_end_of_the_path(spark):
    rows = spark.createDataFrame([(url,) for url in SHOWN], "url string")
    assert {r.url: r.d for r in rows.select("url", u.shown_document(F.col("url")).alias("d")).collect()} == SHOWN


def test_outcomes_come_from_the_shown_document(spark, folder):
    pages = [(i, f"http://good.a.org/en/{1000 + i}") for i in range(60)]
    pages += [(100 + i, f"http://bad.b.org/en/{2000 + i}.html") for i in range(60)]
    # The ids of the pages are those of documents with the opposite label.
    labels = [(1000 + i, 1, 0) for i in range(60)] + [(2000 + i, 0, 0) for i in range(60)]
    labels += [(i, 0, 0) for i in range(60)] + [(100 + i, 1, 0) for i in range(60)]
    path = folder(
        pages=spark.createDataFrame(pages, "page_id long, url string"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    verdicts = {(r.host, r.verdict) for r in QUERIES["op1_url_reputation"](spark, path).collect()}
    assert verdicts == {("good.a.org", "allow"), ("bad.b.org", "block")}
