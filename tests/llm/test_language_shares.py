from __future__ import annotations

from verdigris.llm import language_id as li
from verdigris.llm.queries import QUERIES


def test_equal_shares():
    assert li.equal_shares({"a": 5, "b": 100, "c": 100}, 65) == {"a": 5, "b": 30, "c": 30}
    assert li.equal_shares({"a": 5, "b": 7}, 100) == {"a": 5, "b": 7}
    assert li.equal_shares({}, 10) == {}


def test_a_language_with_few_documents_keeps_its_words(spark):
    letters = "abcdefghijklmnop"
    common = [(i, " ".join(f"{a}{b}{letters[i % 16]}" for a in letters[:8] for b in letters[:8]), "en") for i in range(64)]
    rare = [(100 + i, "zur zus zut zuv zuw", "xx") for i in range(2)]
    frame = spark.createDataFrame([*common, *rare], "doc_id long, text string, lang string")
    model = li.fit(frame, max_words=40, max_grams=40)
    assert {"zur", "zus", "zut", "zuv", "zuw"} <= set(model.rows[0])
    assert all(len(grams) <= 40 for grams in model.rows.values())
    assert len(model.rows[0]) == 40  # 5 words of one language leave 35 to the other
    assert " zur" in model.rows[4] and "zut" in model.rows[3]
    whole = li.fit(frame)
    assert len(whole.rows[0]) == 64 * 16 + 5


def test_unseen_letters_get_the_most_frequent_label(spark, folder):
    rows = [(i, "the cat sat", "en") for i in range(6)] + [(10 + i, "die katze", "de") for i in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.fit(frame, by_prior=True)
    assert model.judge(["жжж", None, "12 !?", ""]) == [("en", 0.75), ("und", 0.0), ("und", 0.0), ("und", 0.0)]
    path = folder(documents=frame.union(spark.createDataFrame([(99, "жжж", None)], frame.schema)))
    found = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, path).collect()}
    assert found[99].lang_pred in ("de", "en") and found[99].score >= 0.5
