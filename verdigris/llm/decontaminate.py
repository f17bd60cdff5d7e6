"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

Texts are reduced to words of digits, lower-cased Latin letters and all characters above
ASCII. Every benchmark item yields its windows of 13 consecutive words; an item with fewer
words is one window. A task maps document words to the ids of benchmark words, drops
window starts that touch a foreign word, hashes the rest, probes the hash set and verifies
each hit against the window's words. Hit words are kept as word ranges, from which spans
or whole documents are removed.

The set is broadcast in chunks of at most ``chunk`` windows. A larger benchmark takes more
passes over the rows, each with a set of bounded size; nothing is left out.

Defined cases: a null text has no words and is never contaminated; an item without words
has no window; repeated items count once, an item without id has an empty id; repeated documents
are judged alike; an empty benchmark contaminates nothing. Columns of the input that carry
the name of an output are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from verdigris.llm.common import unused, without
from verdigris.session import materialize

WINDOW = 13
CHUNK_WINDOWS = 100_000
PASSES_PER_STORE = 4  # sets of so many passes may be in a worker's memory together

# ASCII letters are lowered, other ASCII but digits becomes a blank.
_NORMAL = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20
    for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
OUTPUTS = ("n_words", "hit_ranges", "item_ids")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split() if text else []


def _codes(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of the ids in each window, modulo 2^64."""
    code = np.zeros(len(starts), np.uint64)
    for step in range(length):
        code = code * _BASE + ids[starts + step]
    return code


class WindowSet:
    """Hash set of the windows of one chunk; built on the driver, used in tasks."""

    def __init__(self, pairs: list[tuple[bytes, str]]):
        self.items: dict[bytes, list[str]] = {}
        for window, item in pairs:
            self.items.setdefault(window, []).append(item)
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, list[list[bytes]]] = {}
        for window in self.items:
            words = window.split()
            for word in words:
                self.ids.setdefault(word, len(self.ids) + 1)
            by_length.setdefault(len(words), []).append(words)
        self.codes: dict[int, np.ndarray] = {}
        for length, windows in by_length.items():
            flat = np.array([self.ids[w] for words in windows for w in words], np.uint64)
            self.codes[length] = np.unique(_codes(flat, np.arange(0, len(flat), length), length))

    def find(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Merged ranges [start, end) of hit words, flattened, and the items hit."""
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.uint64, len(words))
        foreign = np.concatenate(([0], np.cumsum(ids == 0)))
        hits, found = [], set()
        for length, codes in self.codes.items():
            if len(words) < length:
                continue
            starts = np.flatnonzero(foreign[length:] == foreign[:-length])
            code = _codes(ids, starts, length)
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            for start in starts[codes[at] == code].tolist():
                items = self.items.get(b" ".join(words[start : start + length]))
                if items:
                    found.update(items)
                    hits.append((start, start + length))
        ranges: list[int] = []
        for start, end in sorted(hits):
            if ranges and start <= ranges[-1]:
                ranges[-1] = max(ranges[-1], end)
            else:
                ranges += (start, end)
        return ranges, found


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct (gram, item) rows."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grams, items = [], []
            for name, body in zip(batch["item"], batch["text"], strict=True):
                words = words_of(body)
                if words:
                    last = max(len(words) - size, 0)
                    own = [b" ".join(words[i : i + size]) for i in range(last + 1)]
                    grams += own
                    items += [name] * len(own)
            yield pd.DataFrame({"gram": pd.Series(grams, dtype=object), "item": pd.Series(items, dtype=object)})

    named = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")
    )
    return named.mapInPandas(cut, "gram binary, item string").distinct()


def _probe(spark, pairs: list[tuple[bytes, str]]):
    shared = spark.sparkContext.broadcast(WindowSet(pairs))

    @F.pandas_udf("n_words long, ranges array<int>, items array<string>")
    def probe(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = shared.value
        for batch in texts:
            out = []
            for text in batch:
                words = words_of(text)
                ranges, items = windows.find(words)
                out.append((len(words), ranges, sorted(items)))
            yield pd.DataFrame(out, columns=["n_words", "ranges", "items"])

    # Not to be evaluated again below a filter on its result.
    return probe.asNondeterministic()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    chunk: int = CHUNK_WINDOWS,
) -> DataFrame:
    """Add ``n_words``, ``hit_ranges`` (flattened, may overlap between chunks) and ``item_ids``."""
    spark = docs.sparkSession
    grams = materialize(item_windows(benchmark, item, item_text, size), "windows")
    chunks = max(1, -(-grams.count() // chunk))
    part = F.pmod(F.xxhash64("gram", "item"), F.lit(chunks))
    n_words, ranges, items, seen = unused(docs, "_n_words", "_ranges", "_items", "_seen")
    found = docs
    for number in range(chunks):
        pairs = [(bytes(r.gram), r.item) for r in grams.filter(part == number).collect()]
        found = found.withColumn(seen, _probe(spark, pairs)(F.col(text)))
        get = lambda name: F.col(seen)[name]
        if number == 0:
            found = found.withColumns({n_words: get("n_words"), ranges: get("ranges"), items: get("items")})
        else:
            found = found.withColumns(
                {ranges: F.concat(ranges, get("ranges")), items: F.array_union(items, get("items"))}
            )
        found = found.drop(seen)
        if number % PASSES_PER_STORE == PASSES_PER_STORE - 1 and number + 1 < chunks:
            found = materialize(found, "contamination")
    return found.select(
        *without(docs, OUTPUTS),
        F.col(n_words).alias("n_words"),
        F.col(ranges).alias("hit_ranges"),
        F.col(items).alias("item_ids"),
    )


def hit_words(ranges: Column) -> Column:
    """Number of words inside the union of the ranges."""
    pairs = F.array_sort(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.size(ranges)), lambda i: (i % 2 == 0) & (i < F.size(ranges))),
            lambda i: F.struct(F.get(ranges, i).alias("a"), F.get(ranges, i + 1).alias("b")),
        )
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    return F.aggregate(
        pairs,
        start,
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0), r["b"] - F.greatest(acc["to"], r["a"]))).alias("n"),
            F.greatest(acc["to"], r["b"]).alias("to"),
        ),
        lambda acc: acc["n"],
    )


def judge(found: DataFrame) -> DataFrame:
    """Digest columns; contaminated if hit words make up a twentieth of the words or more."""
    n_hit = F.when(F.size("hit_ranges") > 0, hit_words(F.col("hit_ranges"))).otherwise(F.lit(0).cast("long"))
    counted = found.select(*without(found, ("n_hit",)), n_hit.alias("n_hit"))
    return counted.select(
        *without(counted, ("n_items", "items_sha256", "contaminated")),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")).cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _cut_ranges(texts: pd.Series, ranges: pd.Series) -> pd.Series:
    out = []
    for text, flat in zip(texts, ranges, strict=True):
        if text is None or flat is None or not len(flat):
            out.append(text)
            continue
        raw = text.encode("utf-8", "surrogatepass")
        plain = raw.translate(_NORMAL)
        spots, at = [], 0
        for word in plain.split():
            at = plain.index(word, at)
            spots.append((at, at + len(word)))
            at += len(word)
        kept, upto = [], 0
        for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)):
            if spots[a][0] > upto:
                kept.append(raw[upto : spots[a][0]])
            upto = max(upto, spots[b - 1][1])
        out.append(b"".join([*kept, raw[upto:]]).decode("utf-8", "surrogatepass"))
    return pd.Series(out, dtype=object)


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Cut every hit range, from its first to its last word, out of the text."""
    cut_ranges = F.pandas_udf(_cut_ranges, "string")
    cut = F.when(F.size("hit_ranges") > 0, cut_ranges(F.col(text), F.col("hit_ranges"))).otherwise(F.col(text))
    return found.withColumn(text, cut)


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, with the columns they came with."""
    body, flag = unused(docs, "_body", "_flag")
    slim = docs.withColumn(body, F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select(body)
    named = slim.select(body, F.col(body)["text"].alias("text"))
    judged = judge(find_contamination(named, benchmark))
    return judged.filter(~F.col("contaminated")).select(f"{body}.*")
