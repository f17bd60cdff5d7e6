from __future__ import annotations

import functools
import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.conftest import sentence
from verdigris.llm import bpe
from verdigris.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def both_sides():
    return Tokenizer.from_file(PATH), bpe.load(PATH)


@pytest.fixture
def library():
    return both_sides()[0]


@pytest.fixture
def vocabulary():
    return both_sides()[1]


def same(library, vocabulary, texts):
    found = bpe.Encoder(vocabulary).encode(texts)
    stated = library.encode_batch(["" if t is None else t for t in texts], add_special_tokens=False)
    for text, ids, right in zip(texts, found, stated, strict=True):
        assert ids.tolist() == right.ids, text
        back = library.decode(right.ids, skip_special_tokens=False)
        assert bpe._joined(vocabulary.bytes, ids) == back == (text or "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text_equals_the_library(texts):
    same(*both_sides(), texts)


def test_code_points_are_cut_as_by_the_library(library, vocabulary):
    """Where the class of letters, numbers, blanks and others changes, and a sample of the rest."""
    kinds = [regex.compile(k) for k in (r"\p{L}", r"\p{N}", r"\s")]
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    kind = [next((i for i, k in enumerate(kinds) if k.match(c)), 3) for c in points]
    edges = {j for i in range(1, len(points)) if kind[i] != kind[i - 1] for j in (i - 1, i)}
    chosen = sorted(edges | set(random.Random(1).sample(range(len(points)), 4_000)))
    same(library, vocabulary, [f"a{c}{c} {c}1 " for c in (points[i] for i in chosen)])


def test_hard_texts(library, vocabulary):
    rng = random.Random(8)
    runs = ["a" * n for n in (2, 3, 5, 999)] + ["ab" * 400 + "a", "\u00e9" * 77, " " * 500 + "x", "\n \t \n"]
    special = ["<|endoftext|>", "a<|endoftext|>b", " <|endoftext|><|endoftext|> x", "<|endoftext|", "<<|endoftext|>>"]
    same(library, vocabulary, [None, "", *runs, *special, "I'll don't DON'T we've", sentence(rng, 3_000)])


def test_long_texts_in_runs_and_an_emptied_table(library, vocabulary, monkeypatch):
    rng = random.Random(2)
    texts = [sentence(rng, 300) + "<|endoftext|>" + sentence(rng, 20) for _ in range(6)]
    monkeypatch.setattr(bpe, "RUN_PIECES", 50)
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 1_000)
    same(library, vocabulary, texts)


def test_one_very_long_word_ends(library, vocabulary):
    rng = random.Random(4)
    same(library, vocabulary, ["".join(rng.choice("abct") for _ in range(200_000))])


def test_bytes_that_are_no_text_and_unknown_ids(library, vocabulary):
    lone = [i for i, raw in vocabulary.bytes.items() if raw in (b"\xc3", b"\xe2\x80", b"\xf0\x9f")]
    for ids in (lone, lone[:1] + [0] + lone[1:], [50256] + lone):
        assert bpe._joined(vocabulary.bytes, np.array(ids)) == library.decode(ids, skip_special_tokens=False)
    assert bpe._joined(vocabulary.bytes, np.array([64, 10**8, -1])) == "a"


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(spark, clashing_docs, no_docs, vocabulary, library):
    docs = clashing_docs.selectExpr("*", "array(1) as ids", "'x' as decoded")
    both = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    assert sorted(both.columns) == sorted(docs.columns)
    rows = both.collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == (row.text or "")
    assert bpe.decode(bpe.encode(no_docs, vocabulary), vocabulary).count() == 0
    lists = spark.createDataFrame([(None,), ([],), ([64, None, 64, -5],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(lists, vocabulary).collect()] == ["", "", "aa"]
    packed = bpe.decode(bpe.encode(docs, vocabulary, packed=True), vocabulary).collect()
    assert [(r.text or "", 4 * len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in packed] == [
        (r.decoded, len(r.ids)) for r in packed
    ]


def test_rules_out_of_order_are_refused(tmp_path, vocabulary):
    stated = json.load(open(PATH, encoding="utf-8"))
    late = next(i for i, (left, _) in enumerate(stated["model"]["merges"]) if len(left) > 2)
    stated["model"]["merges"].insert(0, stated["model"]["merges"].pop(late))
    (tmp_path / "t.json").write_text(json.dumps(stated), encoding="utf-8")
    with pytest.raises(ValueError, match="precedes"):
        bpe.load(str(tmp_path / "t.json"))
