"""Language identification by words first, then by ever shorter character n-grams.

A word seen in training scores by its log frequency in each language. An unseen word falls
back to its 5-grams; if none of them was seen to its 4-grams, and so on down to single
letters. The sum over a text's words gives the posterior of each language.

The classifier is fitted on a sample of labelled rows: at most about ``max_docs`` in
expectation, the same number for each language where it has so many, chosen by a hash. At
most ``max_words`` words and ``max_grams`` n-grams of each length are kept, so the broadcast
model has a bounded size. Where there are more, each language keeps its own most frequent
ones in an equal share; what a language leaves of its share goes to the others, and a gram
of several languages counts in the share of each that chose it.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a text whose
words and letters were all unseen gets the most frequent label, scored by its share of the
labelled rows, if the model is fitted with ``by_prior``, otherwise it is ``und`` as well;
ties go to the alphabetically first language; without any labelled row every text is ``und``. Columns of the input that carry
the name of an output are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from verdigris.llm.common import uniform, unused, without
from verdigris.operators.ordering import number_rows
from verdigris.session import materialize

UNKNOWN = "und"
LONGEST = 5
MAX_DOCS = 12_000
MAX_WORDS = 60_000
MAX_GRAMS = 20_000
MAX_LANGUAGES = 1_000
SMOOTHING = 0.5
SLICE_CHARS = 2_000_000  # texts judged together share the work on equal words

_LETTERS = re.compile(r"[^\W\d_]+")
_ONLY_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters. The quick pattern also takes numerals such as ² and Ⅷ, which are cut out."""
    words = _LETTERS.findall(text.lower()) if text else []
    if words and not "".join(words).isalpha():
        return [part for word in words for part in _ONLY_LETTERS.findall(word)]
    return words


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class LanguageModel:
    """Log frequencies of words and n-grams in each language, one matrix row for each."""

    def __init__(
        self, languages: list[str], counts: dict[int, tuple[list[str], np.ndarray]], prior: list[float] | None = None
    ):
        """``counts``: n (0 for words) to grams and their counts, a column for each language.

        ``prior``: share of each language, which judges texts with unseen letters only.
        """
        self.languages = languages
        self.unseen = (UNKNOWN, 0.0)
        if prior:
            best = int(np.argmax(prior))
            self.unseen = (languages[best], float(prior[best]))
        self.rows: dict[int, dict[str, int]] = {}
        parts, start = [np.zeros((0, len(languages)))], 0
        for n, (grams, found) in counts.items():
            smoothed = found + SMOOTHING
            parts.append(np.log(smoothed / smoothed.sum(axis=0)))
            self.rows[n] = {gram: start + i for i, gram in enumerate(grams)}
            start += len(grams)
        self.scores = np.vstack(parts)

    def rows_of(self, word: str) -> list[int]:
        """The word's own row, or those of its longest n-grams that were seen."""
        row = self.rows.get(0, {}).get(word)
        if row is not None:
            return [row]
        for n in range(LONGEST, 0, -1):
            known = self.rows.get(n)
            if known:
                found = [known[g] for g in grams_of(word, n) if g in known]
                if found:
                    return found
        return []

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior of each text; a word's score is the mean over its rows."""
        place: dict[str, int] = {}
        words, times, sizes = [], [], []
        for text in texts:
            counted = Counter(words_of(text))
            words += [place.setdefault(word, len(place)) for word in counted]
            times += counted.values()
            sizes.append(len(counted))
        rows = [self.rows_of(word) for word in place]
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        flat = np.fromiter((i for r in rows for i in r), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(rows)), lengths)
        by_word = np.zeros((len(rows), len(self.languages)))
        np.add.at(by_word, owner, self.scores[flat])
        by_word /= np.maximum(lengths, 1)[:, None]
        used, weight = np.array(words, np.int64), np.array(times, np.float64)
        totals = np.zeros((len(texts), len(self.languages)))
        of_text = np.repeat(np.arange(len(texts)), sizes)
        np.add.at(totals, of_text, by_word[used] * weight[:, None])
        scored = np.bincount(of_text, weights=lengths[used] > 0, minlength=len(texts)) > 0
        out = []
        for total, known, size in zip(totals, scored, sizes, strict=True):
            if known:
                best = int(np.argmax(total))
                out.append((self.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
            else:
                out.append(self.unseen if size else (UNKNOWN, 0.0))
        return out


def slices(texts: pd.Series, chars: int = SLICE_CHARS) -> Iterator[list[str | None]]:
    """Consecutive whole texts of together about ``chars`` characters, or one longer text."""
    part, size = [], 0
    for text in texts:
        length = len(text) if text else 0
        if part and size + length > chars:
            yield part
            part, size = [], 0
        part.append(text)
        size += length
    if part:
        yield part


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for language, texts in batch.groupby("lang", sort=False)["text"]:
            for part in slices(texts):
                words: Counter[str] = Counter()
                for text in part:
                    words.update(words_of(text))
                rows = [(language, 0, word, count) for word, count in words.items()]
                for n in range(1, LONGEST + 1):
                    grams: Counter[str] = Counter()
                    for word, count in words.items():
                        for gram in grams_of(word, n):
                            grams[gram] += count
                    rows += [(language, n, gram, count) for gram, count in grams.items()]
                yield pd.DataFrame(rows, columns=["lang", "n", "gram", "count"])


def label_sizes(rows: DataFrame, label: str, most_labels: int) -> dict:
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().limit(most_labels + 1).collect()}
    if len(sizes) > most_labels:
        raise ValueError(f"more than {most_labels} labels in {label}")
    return sizes


def sample_per_label(
    rows: DataFrame, label: str, key: Column, bound: int, most_labels: int, sizes: dict | None = None
) -> DataFrame:
    """About ``bound`` rows in expectation, dealt evenly over the labels, chosen by hash of ``key``."""
    if sizes is None:
        sizes = label_sizes(rows, label, most_labels)
    share = F.lit(0.0)
    for name, size in sizes.items():
        share = F.when(F.col(label) == F.lit(name), F.lit(bound / len(sizes) / size)).otherwise(share)
    return rows.filter(uniform(key) < share)


def equal_shares(sizes: dict[str, int], bound: int) -> dict[str, int]:
    """How many of its ``sizes`` each may keep: equally many, what one leaves going to the others."""
    shares, left = {}, bound
    for i, (name, size) in enumerate(sorted(sizes.items(), key=lambda item: (item[1], item[0]))):
        shares[name] = min(size, left // (len(sizes) - i))
        left -= shares[name]
    return shares


def _kept_grams(by_lang: DataFrame, counted: DataFrame, languages: list[str], bounds: dict[int, int]) -> DataFrame:
    """Rows of ``counted`` (n, gram, ...) within ``bounds``; ``by_lang`` is (n, gram, lang, count)."""
    distinct = {r["n"]: r["count"] for r in counted.groupBy("n").count().collect()}
    if all(size <= bounds[n] for n, size in distinct.items()):
        return counted
    sizes = {(r["n"], r["lang"]): r["count"] for r in by_lang.groupBy("n", "lang").count().collect()}
    # Places in the order of n, language, falling count; one row for each n and language.
    ends, start = [], 0
    for n in sorted(distinct):
        own = {name: sizes.get((n, name), 0) for name in languages}
        shares = own if distinct[n] <= bounds[n] else equal_shares(own, bounds[n])
        for code, name in enumerate(languages):
            ends.append((n, code, start + shares[name]))
            start += own[name]
    codes = F.create_map(*[F.lit(x) for code, name in enumerate(languages) for x in (name, code)])
    ordered = by_lang.select("n", codes[F.col("lang")].alias("code"), (-F.col("count")).alias("rarity"), "gram")
    placed = number_rows(ordered, ["n", "code", "rarity", "gram"], "position")
    limits = by_lang.sparkSession.createDataFrame(ends, "n int, code int, end long")
    chosen = placed.join(F.broadcast(limits), ["n", "code"]).filter("position < end").select("n", "gram").distinct()
    return materialize(counted.join(chosen, ["n", "gram"], "left_semi"), "kept-grams")


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    max_docs: int = MAX_DOCS,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
    by_prior: bool = False,
) -> LanguageModel:
    rows = labelled.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).cast("string").alias("key")
    ).filter("text is not null and lang is not null")
    sizes = label_sizes(rows, "lang", MAX_LANGUAGES)
    sample = sample_per_label(rows, "lang", F.col("key"), max_docs, MAX_LANGUAGES, sizes)
    by_lang = (
        sample.select("text", "lang")
        .mapInPandas(_count_grams, "lang string, n int, gram string, count long")
        .groupBy("n", "gram", "lang")
        .agg(F.sum("count").alias("count"))
    )
    by_lang = materialize(by_lang, "grams")
    # At most one entry for each language.
    counted = by_lang.groupBy("n", "gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "count"))).alias("by_lang"))
    counted = materialize(counted, "counted")
    languages = sorted(r[0] for r in by_lang.select("lang").distinct().collect())
    bounds = {n: max_grams if n else max_words for n in range(LONGEST + 1)}
    kept = _kept_grams(by_lang, counted, languages, bounds) if languages else counted
    by_column = F.transform(F.array(*map(F.lit, languages)), lambda name: F.coalesce(F.col("by_lang")[name], F.lit(0)))
    counts = {}
    for n in range(LONGEST + 1) if languages else ():
        rows = kept.filter(F.col("n") == n).orderBy("gram").select("gram", by_column.alias("counts")).collect()
        counts[n] = ([r.gram for r in rows], np.array([r.counts for r in rows], np.float64).reshape(-1, len(languages)))
        del rows  # one table at a time is in the driver's memory as rows
    taught = sum(sizes[name] for name in languages)
    return LanguageModel(languages, counts, [sizes[name] / taught for name in languages] if by_prior else None)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the posterior of that language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            judged = [row for part in slices(batch) for row in known.judge(part)]
            yield pd.DataFrame(judged, columns=["lang_pred", "score"])

    kept = without(docs, ("lang_pred", "score"))
    (judged,) = unused(docs, "_judged")
    once = run.asNondeterministic()  # not to be evaluated again below a filter on its result
    return docs.select(*kept, once(F.col(text)).alias(judged)).select(
        *kept, F.col(judged)["lang_pred"].alias("lang_pred"), F.col(judged)["score"].alias("score")
    )


def confident(judged: Column, score: Column, least: float) -> Column:
    """Whether a document is in a learned language, more likely than ``least``."""
    return (judged != UNKNOWN) & (score >= least) & ~F.isnan(score)


def keep_confident(docs: DataFrame, model: LanguageModel, least: float, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that are in a learned language with at least that score."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    (row,) = unused(docs, "_row")
    whole = docs.select(F.struct(*kept).alias(row), F.col(text).alias("text"))
    judged = identify(whole, model)
    return judged.filter(confident(F.col("lang_pred"), F.col("score"), least)).select(f"{row}.*")
