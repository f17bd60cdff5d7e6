from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.conftest import SMALL
from tests.llm.conftest import sentence
from verdigris.llm import decontaminate as d
from verdigris.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        words, hit, found = plain(text), set(), set()
        for item_id, item in items:
            own = plain(item)
            n = min(13, len(own))
            windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(str(item_id) if item_id is not None else "")
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        flag = bool(hit) and 20 * len(hit) >= len(words)
        out.append((doc_id, len(words), len(hit), len(found), digest, flag))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(1)
    items = [(i, sentence(rng, n)) for i, n in enumerate((40, 13, 14, 5, 1, 60))]
    items += [(6, None), (7, ""), (8, items[0][1]), (None, sentence(rng, 15)), (6, sentence(rng, 13)), (10, "Größe Ärger, naïve!")]
    docs = [(0, None), (1, ""), (2, sentence(rng, 30)), (3, items[0][1].upper().replace(" ", " -- ")), (3, items[0][1])]
    for i in range(30):
        words = sentence(rng, 100).split()
        own = rng.choice([t for _, t in items if t]).split()
        cut = rng.randrange(len(own))
        at = rng.randrange(90)
        docs.append((10 + i, " ".join([*words[:at], *own[cut : cut + 25], *words[at:]])))
    docs += [(None, items[3][1]), (99, "die größe Ärger  naïve x")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("chunk", [d.CHUNK_WINDOWS, 12])
def test_equals_brute_force(cases, chunk):
    docs, items, doc_frame, item_frame = cases
    judged = d.judge(d.find_contamination(doc_frame, item_frame, chunk=chunk))
    assert rows(judged) == brute(docs, items)


def test_query_equals_brute_force(spark):
    found = QUERIES["op2_decontaminate"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    expected = brute(docs, items)
    assert rows(found) == expected
    assert any(r[-1] for r in expected)


def test_spans_are_cut_from_the_text(spark):
    rng = random.Random(2)
    item = sentence(rng, 13)
    docs = spark.createDataFrame([(1, f"Before, {item.upper()}; after."), (2, None), (3, "nothing")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    cut = {r.doc_id: r.text for r in d.remove_spans(d.find_contamination(docs, items)).collect()}
    assert cut == {1: "Before, ; after.", 2: None, 3: "nothing"}


def test_odd_rows_and_clashing_columns(spark, clashing_docs, no_docs):
    items = spark.createDataFrame([(1, "same words in every row")], "item_id long, text string")
    kept = d.remove_documents(clashing_docs, items)
    assert kept.columns == clashing_docs.columns
    assert kept.count() == clashing_docs.count() - 3
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.remove_documents(clashing_docs, none).count() == clashing_docs.count()
    assert d.remove_documents(no_docs, items).count() == 0
