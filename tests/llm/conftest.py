from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names clash with outputs and working columns.
CLASHING = "fp long, score double, shard int, size long, copies long, _row string, text_ string, `a.b` int"


def sentence(rng: random.Random, n: int, words=("amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "heath")):
    return " ".join(f"{rng.choice(words)}{rng.randrange(60)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty, blank and very long texts, ties and wholly repeated rows."""
    rng = random.Random(5)
    long_text = sentence(rng, 30_000)
    texts = [None, "", "  \t\n", "12 !! ..", "one", "one two", sentence(rng, 40), long_text, long_text + " tail"]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", None, "s2"][i % 3], 1) for i, t in enumerate(texts)]
    rows += [(None, sentence(rng, 20), None, None, None), (None, None, None, None, None)]
    rows += [(50, "same words in every row", "en", "s1", 4)] * 3
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing_docs(spark, odd_docs):
    from pyspark.sql import functions as F

    extra = {c.split()[0].strip("`"): c.split()[1] for c in CLASHING.split(", ")}
    return odd_docs.select("*", *[F.lit(7).cast(kind).alias(name) for name, kind in extra.items()])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture
def folder(fresh):
    """Writes the given frames as tables of a new folder and returns its path."""

    def write(**tables):
        path = fresh("tables")
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return path

    return write
