from __future__ import annotations

import unicodedata

import pytest

from verdigris.llm.language_id import fit, identify, words_of


def brute(text):
    words, word = [], ""
    for c in text.lower() + " ":
        if unicodedata.category(c).startswith("L"):
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


@pytest.mark.parametrize("text", ["²", "½ ⅔", "① x²y Ⅷa", "m² ǅ ª º", "a1b_c", "日本語 ٣ क्या", "İI", "", "１２ Ａ"])
def test_words_hold_letters_only(text):
    assert words_of(text) == brute(text)


def test_numerals_are_no_language(spark):
    taught = spark.createDataFrame([(i, "some words of this", "en") for i in range(9)], "doc_id long, text string, lang string")
    model = fit(taught, by_prior=True)
    asked = spark.createDataFrame([("²",), ("½ ⅔ ①",), ("Ⅷ",), ("",), (None,), ("ж",)], "text string")
    found = {r.text: (r.lang_pred, r.score) for r in identify(asked, model).collect()}
    assert {t for t, (lang, _) in found.items() if lang == "und"} == {"²", "½ ⅔ ①", "Ⅷ", "", None}
    assert all(score == 0 for lang, score in found.values() if lang == "und")
