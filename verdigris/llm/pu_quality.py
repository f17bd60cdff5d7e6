"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled good documents; unlabelled are all documents, whose labels
stay unseen, including labels of bad ones. A first model tells positives from unlabelled; on positives kept
out of its fit, the smallest ratio of unlabelled to positive documents above a score bounds
the share of good documents, the class prior. The final model minimises the non-negative
unbiased risk: prior * E+[loss(good)] + max(0, Eu[loss(bad)] - prior * E+[loss(bad)]), with
logistic loss; whenever the second term is negative, the step raises it instead.

The model is additive over standardised features with hinges. Every step sums gradients
over all rows in Spark; the driver holds one weight vector. At most about
``max_positives`` trusted positives take part, all unlabelled documents do.

Defined cases: a null or empty text has zero features and is scored like any other; a null
label is no label; without trusted positives every score is 0.5. A column of the input
that carries the name of an output is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from verdigris.llm.common import uniform
from verdigris.llm.language_id import sample_per_label
from verdigris.session import materialize

MAX_POSITIVES = 20_000
FIRST_STEPS, FINAL_STEPS = 30, 50
RATE = 0.15
RIDGE = 1e-3
BINS = 400
SEED = 31

FEATURES = (
    "log_words", "word_length", "long_words", "distinct_words", "top_word", "repeated_next", "repeated_pairs",
    "symbol_words", "symbol_rate", "mark_rate", "mark_words", "capital_rate", "shouted_words", "bar_rate", "digit_rate",
    "stop_rate", "comma_rate", "short_words", "log_lines", "repeated_lines", "words_per_line", "letter_rate",
    "link_rate", "log_words_below",
)

_SYMBOL_TAIL = re.compile(r"[^\w\s]{3,}(?=\s|$)")
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]")


def features_of(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n = len(words)
    many = max(n, 1)
    chars = max(len(text), 1)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [line for line in text.split("\n") if line.strip()]
    spaces = sum(map(text.count, " \n\t\r"))
    symbols = sum(map(text.count, "#$%&*@^~=+<>{}[]\\"))
    marks = text.count("!") + text.count("?")
    lengths = list(map(len, words))
    return [
        math.log1p(n),
        sum(lengths) / many,
        sum(x > 14 for x in lengths) / many,
        len(counts) / many,
        max(counts.values(), default=0) / many,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / many,
        1 - len(pairs) / max(n - 1, 1) if n > 1 else 0.0,
        len(_SYMBOL_TAIL.findall(text)) / many,
        symbols / chars,
        marks / chars,
        sum(w.endswith("!") for w in counts) / max(len(counts), 1),
        len(_CAPITALS.findall(text)) / chars,
        sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / many,
        text.count("|") / many,
        sum(map(text.count, "0123456789")) / chars,
        text.count(".") / many,
        text.count(",") / many,
        sum(x < 4 for x in lengths) / many,
        math.log1p(len(lines)),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        math.log1p(n / max(len(lines), 1)),
        1 - (spaces + symbols + marks) / chars,
        (text.count("http") + text.count("@")) / many,
        max(0.0, 4 - math.log1p(n)),
    ]


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add a struct ``features`` of the columns named in ``FEATURES``."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = np.array([features_of(t) for t in batch]).reshape(-1, len(FEATURES))
            yield pd.DataFrame(rows, columns=list(FEATURES))

    schema = ", ".join(f"{name} double" for name in FEATURES)
    return docs.withColumn("features", F.pandas_udf(run, schema).asNondeterministic()(F.col(text)))


class Basis:
    """Standardised features, two hinges and the clipped square of each, and a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        self.mean, self.deviation = mean, np.where(deviation > 1e-12, deviation, 1.0)
        self.width = 4 * len(mean) + 1

    def expand(self, frame: pd.DataFrame) -> np.ndarray:
        z = np.clip((frame[list(FEATURES)].to_numpy(np.float64) - self.mean) / self.deviation, -6, 6)
        high, low = np.maximum(z - 1, 0), np.maximum(-z - 1, 0)
        return np.hstack([z, high, low, np.minimum(z * z, 4), np.ones((len(z), 1))])


def fit_basis(features: DataFrame) -> Basis:
    row = features.agg(
        *[F.coalesce(F.avg(c), F.lit(0.0)) for c in FEATURES],
        *[F.coalesce(F.stddev_pop(c), F.lit(0.0)) for c in FEATURES],
    ).first()
    n = len(FEATURES)
    return Basis(np.array(row[:n]), np.array(row[n:]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _sums(rows: DataFrame, basis: Basis, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient and loss sums over all rows: of positives as good and bad, of all as bad.

    ``rows`` has the features and ``trusted``, the share of a row that is a trusted positive.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = basis.width
        total = np.zeros((3, width + 2))  # each: gradient, loss, count
        for batch in batches:
            x = basis.expand(batch)
            z = x @ weights
            p, t = _sigmoid(z), batch["trusted"].to_numpy(np.float64)
            good, bad = np.logaddexp(0, -z), np.logaddexp(0, z)
            for i, (slope, loss, share) in enumerate(((p - 1, good, t), (p, bad, t), (p, bad, np.ones_like(t)))):
                total[i, :width] += (slope * share) @ x
                total[i, width] += loss @ share
                total[i, width + 1] += share.sum()
        yield pd.DataFrame({"place": np.arange(total.size), "value": total.ravel()})

    found = rows.mapInPandas(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(3 * (basis.width + 2))
    for row in found.collect():  # one row for each weight and sum
        total[row["place"]] = row["value"]
    names = ("positive_good", "positive_bad", "all_bad")
    shaped = total.reshape(3, basis.width + 2)
    return {n: shaped[i, :-1] / max(shaped[i, -1], 1e-300) for i, n in enumerate(names)}


class _Adam:
    def __init__(self, width: int, rate: float = RATE):
        self.first, self.second, self.step, self.rate = np.zeros(width), np.zeros(width), 0, rate

    def move(self, weights: np.ndarray, gradient: np.ndarray, share: float) -> np.ndarray:
        self.step += 1
        self.first = 0.8 * self.first + 0.2 * gradient
        self.second = 0.95 * self.second + 0.05 * gradient**2
        first, second = self.first / (1 - 0.8**self.step), self.second / (1 - 0.95**self.step)
        return weights - self.rate * (1 - share) * first / (np.sqrt(second) + 1e-8)


def _descend(rows: DataFrame, basis: Basis, weights: np.ndarray, steps: int, prior: float | None) -> np.ndarray:
    """Without a prior: logistic regression of positives against all rows, at equal weight."""
    adam = _Adam(basis.width)
    shrink = np.full(basis.width, RIDGE)
    shrink[-1] = 0
    for step in range(steps):
        sums = _sums(rows, basis, weights)
        good, bad, every = sums["positive_good"], sums["positive_bad"], sums["all_bad"]
        if prior is None:
            gradient = good[:-1] + every[:-1]
        else:
            negative = every - prior * bad  # gradient, and the risk of bad documents at its end
            gradient = -negative[:-1] if negative[-1] < 0 else prior * good[:-1] + negative[:-1]
        weights = adam.move(weights, gradient + shrink * weights, 0.9 * step / steps)
    return weights


def estimate_prior(rows: DataFrame, basis: Basis, weights: np.ndarray) -> float:
    """Smallest ratio of all rows to kept-out positives above a score, with its sampling error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros((2, BINS))
        for batch in batches:
            score = _sigmoid(basis.expand(batch) @ weights)
            place = np.minimum((score * BINS).astype(int), BINS - 1)
            count[0] += np.bincount(place, minlength=BINS)
            count[1] += np.bincount(place, weights=batch["kept_out"].to_numpy(np.float64), minlength=BINS)
        yield pd.DataFrame({"place": np.arange(2 * BINS), "value": count.ravel()})

    found = rows.mapInPandas(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    count = np.zeros(2 * BINS)
    for row in found.collect():
        count[row["place"]] = row["value"]
    every, trusted = count.reshape(2, BINS)[:, ::-1].cumsum(axis=1)
    if trusted[-1] == 0:
        return 0.5
    slack = [math.sqrt(math.log(40) / 2 / max(n, 1)) for n in (every[-1], trusted[-1])]
    p_all, p_trusted = every / every[-1], trusted / trusted[-1]
    bound = (p_all + slack[0] + slack[1]) / np.maximum(p_trusted, 1e-12)
    best = int(np.argmin(np.where(p_trusted > 0, bound, np.inf)))
    return float(np.clip(p_all[best] / p_trusted[best], 0.02, 0.98))


def fit(rows: DataFrame) -> tuple[Basis, np.ndarray, float] | None:
    """``rows``: stored features with ``trusted`` and ``kept_out`` (0 or 1); None without positives."""
    if not rows.agg(F.sum("trusted")).first()[0]:
        return None
    basis = fit_basis(rows)
    first = _descend(rows, basis, np.zeros(basis.width), FIRST_STEPS, None)
    prior = estimate_prior(rows, basis, first)
    return basis, _descend(rows, basis, first, FINAL_STEPS, prior), prior


def score_quality(docs: DataFrame, positives: DataFrame, max_positives: int = MAX_POSITIVES) -> DataFrame:
    """``docs`` (key, text) and ``positives`` (key): (key, score), one row for each document.

    A fifth of the positives is kept out of the first fit, for the class prior.
    """
    known = positives.select(F.col("key").cast("string").alias("name"), F.lit(1).alias("one")).filter("name is not null")
    sample = sample_per_label(known, "one", F.col("name"), max_positives, 1).groupBy("name").agg(F.count("one").alias("times"))
    found = materialize(with_features(docs.select("key", "text")).select("key", "features.*"), "features")
    name = F.col("key").cast("string")
    # At most about ``max_positives`` rows of a few bytes.
    joined = found.join(F.broadcast(sample), name == F.col("name"), "left")
    times = F.coalesce(F.col("times"), F.lit(0))
    out = uniform(F.lit(SEED), name) < 0.2
    rows = joined.select(
        "key",
        *FEATURES,
        F.when(out, 0).otherwise(times).cast("int").alias("trusted"),
        F.when(out, times).otherwise(0).cast("int").alias("kept_out"),
    )
    rows = materialize(rows.withColumn("trusted", F.coalesce("trusted", F.lit(0))), "positives")
    model = fit(rows)
    if model is None:
        return docs.select("key", F.lit(0.5).alias("score"))
    basis, weights, _ = model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_sigmoid(basis.expand(batch) @ weights))

    return rows.select("key", F.pandas_udf(run, "double")(F.struct(*FEATURES)).alias("score"))
