"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The labelled sample is split by a hash in three: two parts teach a lexicon each and, read
with the lexicon of the other part, the trees; the third teaches the calibration with the
lexicon of both. So no part judges what it has learned itself.

The lexicon holds words and word beginnings (4 to 6 letters) that are much more frequent
among toxic than other documents. Features are its densities and strongest entries, hits
near second-person words, shares of capitals, punctuation and symbols, and hits that show
only after undoing digits for letters, stretched letters or spelled-out letters.

The fit uses at most about ``max_rows`` labelled rows, half of each label where there are so many, weighted
back to the labels' shares; all other work covers all documents.

Defined cases: a null or empty text has zero features and is scored like any other; a null
label is no label; repeated labels count each; without two labels in every part all scores
are the share of toxic labels, 0 without labels. A column of the input that carries the
name of an output is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from verdigris.llm.common import uniform
from verdigris.llm.language_id import sample_per_label
from verdigris.session import materialize

MAX_ROWS = 20_000
MIN_DOCS = 3
MIN_ODDS = 2.0
STRONG_ODDS = 3.5
MAX_ENTRIES = 20_000
PREFIXES = (4, 5, 6)
TREES, DEPTH, STEP = 25, 3, 0.3
NEAR = 5
SEED = 77

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti contigo usted ustedes vosotros os vuestro".split()
)
# Characters used in place of letters.
_LOOK_ALIKE = str.maketrans("013457@$!|", "oieastasil")

_TOKEN = re.compile(r"[\w@$!|*]*[^\W\d_][\w@$!|*]*")
_SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][\s.\-_*]){3,}[^\W\d_](?!\w)")
_STRETCHED = re.compile(r"(\w)\1{2,}")
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]")
_EDGES = "@$!|*_0123456789"

FEATURES = (
    "log_words", "strong_log", "strong_rate", "mild_log", "mild_rate", "prefix_log", "prefix_rate", "top_odds",
    "second_odds", "odds_rate", "near_second", "second_rate", "hidden_log", "hidden_rate", "spelled_log",
    "capital_rate", "shouted_rate", "mark_rate", "punctuation_rate", "symbol_rate", "digit_rate", "word_length",
)


def plain_word(token: str) -> str:
    return token.strip(_EDGES)


def entries_of(word: str) -> list[str]:
    """Lexicon keys of a word: itself, and its beginnings marked by a star."""
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


def uncovered(token: str) -> str:
    """A token with look-alikes, fillers and stretched letters undone."""
    return _STRETCHED.sub(r"\1", token.translate(_LOOK_ALIKE).replace("*", "").replace("_", ""))


class Lexicon:
    """Log odds of toxic against other documents by entry."""

    def __init__(self, odds: dict[str, float]):
        self.odds = odds

    def word(self, word: str) -> float:
        return self.odds.get(word, 0.0)

    def prefix(self, word: str) -> float:
        return max((self.odds.get(word[:n] + "*", 0.0) for n in PREFIXES if len(word) > n), default=0.0)


def features_of(text: str | None, lexicon: Lexicon, cache: dict[str, tuple[float, float, float]]) -> list[float]:
    text = text or ""
    tokens = _TOKEN.findall(text)
    lowered = [t.lower() for t in tokens]
    n = max(len(tokens), 1)
    hits, best, spots = Counter(), [0.0, 0.0], []
    total = 0.0
    for at, token in enumerate(lowered):
        found = cache.get(token)
        if found is None:
            if len(cache) > 200_000:
                cache.clear()
            word = plain_word(token)
            direct, prefix = lexicon.word(word), lexicon.prefix(word)
            hidden = 0.0
            if not direct and not prefix:
                other = uncovered(token)
                if other != word:
                    hidden = max(lexicon.word(other), lexicon.prefix(other))
            found = cache[token] = (direct, prefix, hidden)
        if found != (0.0, 0.0, 0.0):
            direct, prefix, hidden = found
            odds = max(found)
            hits["strong"] += max(direct, prefix) >= STRONG_ODDS
            hits["mild"] += 0 < max(direct, prefix) < STRONG_ODDS
            hits["prefix"] += prefix >= STRONG_ODDS
            hits["hidden"] += hidden > 0
            total += odds
            spots.append(at)
            if odds > best[0]:
                best = [odds, best[0]]
            elif odds > best[1]:
                best[1] = odds
    spelled = 0
    for run in _SPELLED.findall(text):
        word = "".join(c for c in run.lower() if c.isalpha())
        spelled += max(lexicon.word(word), lexicon.prefix(word)) > 0
    second = [i for i, t in enumerate(lowered) if t in SECOND_PERSON]
    near = 0
    if second and spots:
        ends = np.array(second)
        for spot in spots:
            i = int(np.searchsorted(ends, spot))
            near += any(abs(int(ends[j]) - spot) <= NEAR for j in (i - 1, i) if 0 <= j < len(ends))
    chars = max(len(text), 1)
    letters = sum(map(len, tokens)) or 1
    capitals = len(_CAPITALS.findall(text))
    shouted = sum(len(t) > 1 and t.isupper() for t in tokens)
    marks = text.count("!") + text.count("?")
    punctuation = marks + sum(map(text.count, ".,;:-\"'"))
    symbols = sum(map(text.count, "@#$%&*~^+=|<>"))
    digits = sum(map(text.count, "0123456789"))
    return [
        math.log1p(len(tokens)), math.log1p(hits["strong"]), hits["strong"] / n, math.log1p(hits["mild"]),
        hits["mild"] / n, math.log1p(hits["prefix"]), hits["prefix"] / n, best[0], best[1], total / n,
        math.log1p(near), len(second) / n, math.log1p(hits["hidden"]), hits["hidden"] / n, math.log1p(spelled),
        capitals / chars, shouted / n, marks / chars, punctuation / chars, symbols / chars, digits / chars, letters / n,
    ]


def _entry_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for (part, label), texts in batch.groupby(["part", "label"])["text"]:
            seen: Counter[str] = Counter()
            for text in texts:
                words = {plain_word(t.lower()) for t in _TOKEN.findall(text)}
                seen.update({entry for word in words if word for entry in entries_of(word)})
            rows += [(entry, int(part), int(label), count) for entry, count in seen.items()]
        yield pd.DataFrame(rows, columns=["entry", "part", "label", "docs"])


def learn_lexicons(rows: DataFrame) -> dict[str, Lexicon]:
    """From (text, label, part) rows of parts 0 and 1: a lexicon of each part, and of ``both``.

    Entries occur in ``MIN_DOCS`` toxic documents and have log odds of ``MIN_ODDS`` at least.
    """
    sizes = {(r["part"], r["label"]): r["count"] for r in rows.groupBy("part", "label").count().collect()}
    counts = (
        rows.filter("text is not null")
        .mapInPandas(_entry_counts, "entry string, part int, label int, docs long")
        .groupBy("entry")
        .agg(
            *[
                F.sum(F.when((F.col("part") == part) & (F.col("label") == label), F.col("docs")).otherwise(0)).alias(f"n{part}{label}")
                for part in (0, 1)
                for label in (0, 1)
            ]
        )
    )
    counts = materialize(counts.filter(F.col("n01") + F.col("n11") >= MIN_DOCS), "entries")
    found = {}
    for name, parts in (("0", (0,)), ("1", (1,)), ("both", (0, 1))):
        seen = {label: sum((F.col(f"n{part}{label}") for part in parts), F.lit(0)) for label in (0, 1)}
        of = {label: sum(sizes.get((part, label), 0) for part in parts) for label in (0, 1)}
        odds = F.log((seen[1] + 0.5) / (of[1] + 1.0)) - F.log((seen[0] + 1.0) / (of[0] + 1.0))
        best = counts.filter(seen[1] >= MIN_DOCS).select("entry", odds.alias("odds")).filter(F.col("odds") >= MIN_ODDS)
        best = best.orderBy(F.desc("odds"), "entry").limit(MAX_ENTRIES)
        found[name] = Lexicon({r.entry: r.odds for r in best.collect()})
    return found


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Add a struct ``features`` of the columns named in ``FEATURES``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, cache = shared.value, {}
        for batch in batches:
            rows = np.array([features_of(t, known, cache) for t in batch]).reshape(-1, len(FEATURES))
            yield pd.DataFrame(rows, columns=list(FEATURES))

    schema = ", ".join(f"{name} double" for name in FEATURES)
    return docs.withColumn("features", F.pandas_udf(run, schema).asNondeterministic()(F.col(text)))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(key, text, label, weight, part) of a bounded sample; parts are 0.4, 0.4 and 0.2."""
    known = labels.select(F.col("key").cast("string").alias("key"), F.col("label").cast("int").alias("label"))
    # A repeated label is one row with its number of times, so the sample is bounded by documents.
    known = known.filter("key is not null and label in (0, 1)")
    known = known.groupBy("key", "label").agg(F.count(F.lit(1)).alias("times"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    sample = sample_per_label(known, "label", F.col("key"), max_rows, 2)
    share = {k: min(1.0, max_rows / len(sizes) / n) for k, n in sizes.items()}
    weight = F.when(F.col("label") == 1, F.lit(1 / share.get(1, 1.0))).otherwise(F.lit(1 / share.get(0, 1.0)))
    draw = uniform(F.lit(SEED), F.col("key"))
    part = F.when(draw < 0.4, 0).when(draw < 0.8, 1).otherwise(2)
    sample = sample.select("key", "label", (weight * F.col("times")).alias("weight"), part.alias("part"))
    texts = docs.select(F.col("key").cast("string").alias("key"), "text")
    # At most about ``max_rows`` rows of a few bytes.
    return texts.join(F.broadcast(sample), "key")


def fit_scores(features: DataFrame, sample: DataFrame, fallback: float) -> DataFrame:
    """Rows of ``features`` (with the columns in ``FEATURES``) and their ``score``."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    parts = {(r["part"], r["label"]) for r in sample.select("part", "label").distinct().collect()}
    if any((part, label) not in parts for part in (0, 1, 2) for label in (0, 1)):
        return features.withColumn("score", F.lit(fallback))
    known = assembler.transform(sample)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
        seed=SEED,
    )
    model = trees.fit(known.filter("part < 2").withColumn("label", F.col("label").cast("double")))
    margin = vector_to_array("rawPrediction")[1]
    judged = model.transform(known.filter("part = 2")).select(
        margin.alias("margin"), F.col("label").cast("double").alias("label"), "weight"
    )
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight", predictionCol="level")
    calibrated = isotonic.fit(judged).transform(
        model.transform(assembler.transform(features)).withColumn("margin", margin)
    )
    # The step function is tilted a little, so that documents of one step keep their order.
    order = 1 / (1 + F.exp(-F.col("margin")))
    score = 0.998 * F.least(F.greatest(F.col("level"), F.lit(0.0)), F.lit(1.0)) + 0.002 * order
    return calibrated.withColumn("score", score)


def score_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` (key, text) and ``labels`` (key, label): (key, score), one row for each document."""
    sample = materialize(labelled_sample(docs, labels, max_rows), "labelled")
    lexicons = learn_lexicons(sample.filter("part < 2").select("text", "label", "part"))
    mean = sample.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0] or 0.0
    # Each part is read with the lexicon of the other, the last one with that of both.
    readers = {0: lexicons["1"], 1: lexicons["0"], 2: lexicons["both"]}
    known = None
    for part, lexicon in readers.items():
        own = with_features(sample.filter(F.col("part") == part), lexicon).select("part", "label", "weight", "features.*")
        known = own if known is None else known.union(own)
    known = materialize(known, "known")
    found = with_features(docs.select("key", "text"), lexicons["both"]).select("key", "features.*")
    return fit_scores(materialize(found, "features"), known, float(mean)).select("key", "score")
