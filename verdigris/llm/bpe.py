"""Byte-level BPE encoding and decoding over an index of pair occurrences.

Texts are cut into pieces by the usual byte-level pattern and the distinct pieces of a slice of
a partition are laid out in one array of symbols. An index maps each pair that has a merge
rule to all its positions in that array. The active ranks are applied in ascending order:
all positions of the lowest rank are merged, which changes the neighbouring pairs, whose
positions are added to their own lists; entries that no longer hold are passed over. A
merged symbol takes part only in later ranks (checked when the rules are read), so every
piece gets the same tokens as if it were merged alone.

Pieces known from earlier slices are looked up; the table of known pieces is emptied when it
holds ``KNOWN_BYTES``, which costs time only. Texts are read in runs of ``RUN_PIECES``
pieces, so one long text needs memory for its ids and not for all its pieces.

The vocabulary file is read on the driver and broadcast: its size is that of the tokenizer,
not of the data. Special tokens found in a text become their own ids, as the library does by
default; truncation, padding and post-processing are left out.

Defined cases: a null or empty text has no ids and decodes to the empty text; ids outside the
vocabulary, and null ids, are left out in decoding, bytes that are not UTF-8 decode to U+FFFD;
repeated rows are encoded alike. Columns of the input that carry the name of an output are
replaced, all others are kept.
"""

from __future__ import annotations

import codecs
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from verdigris.llm.common import without
from verdigris.llm.language_id import slices

# The byte-level piece pattern.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUN_PIECES = 200_000
KNOWN_BYTES = 96 << 20
DECODED_ROWS = 500
_GONE = -1


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Merge rules and token bytes of a byte-level tokenizer file; plain data, cheap to send."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, cut = stated["model"], stated.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space"):
            raise ValueError("a byte-level BPE tokenizer without prefix space is needed")
        unusual = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")
        if stated.get("normalizer") or any(model.get(x) for x in unusual) or model.get("ignore_merges"):
            raise ValueError("normalizers and variants of the merge rules are not supported")
        letters = byte_letters()
        ids: dict[str, int] = model["vocab"]
        self.first = [_GONE] * 256
        for letter, byte in letters.items():
            self.first[byte] = ids.get(letter, _GONE)
        self.bytes: dict[int, bytes] = {}
        for token, number in ids.items():
            self.bytes[number] = bytes(letters[c] for c in token)
        self.rules: list[tuple[int, int, int]] = []
        made = set(self.first)  # tokens that an earlier rule makes, or no rule
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            rule = (ids[left], ids[right], ids[left + right])
            if rule[0] not in made or rule[1] not in made or rule[2] in made:
                raise ValueError(f"merge {left} {right} precedes the merge that makes its parts, or is repeated")
            made.add(rule[2])
            self.rules.append(rule)
        self.special: dict[str, int] = {}
        for token in stated.get("added_tokens") or ():
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError("special tokens that take in their surroundings are not supported")
            self.special[token["content"]] = token["id"]
            self.bytes[token["id"]] = token["content"].encode("utf-8")


class Encoder:
    """Encodes texts with one vocabulary; keeps the pieces it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.first = vocabulary.first
        self.rules = vocabulary.rules
        self.ranks = {left << 32 | right: rank for rank, (left, right, _) in enumerate(vocabulary.rules)}
        self.special = vocabulary.special
        longest_first = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})") if longest_first else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def learn(self, pieces: Iterable[str]) -> None:
        """Merge the given new pieces together, in one index of their pairs."""
        new = list(pieces)
        symbols: list[int] = []
        ends = []
        for piece in new:
            symbols += [self.first[b] for b in piece.encode("utf-8", "replace")]
            symbols.append(_GONE)  # no pair reaches over the border of a piece
            ends.append(len(symbols))
        self._merge(symbols)
        left = np.array(symbols, np.int64)
        kept = left != _GONE
        raw = left[kept].astype("<u4").tobytes()
        bounds = (4 * np.cumsum(kept)[np.array(ends, np.int64) - 1]).tolist() if new else []
        start = 0
        for piece, end in zip(new, bounds, strict=True):
            self.known[piece] = raw[start:end]
            start = end
        self.held += 230 * len(new) + len(raw)

    def _merge(self, symbols: list[int]) -> None:
        """Apply all rules to ``symbols`` in place; what a merge takes in becomes ``_GONE``."""
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank_of, rules = self.ranks.get, self.rules
        places: dict[int, list[int]] = {}
        for at, (left, right) in enumerate(zip(symbols, symbols[1:])):
            rank = rank_of(left << 32 | right)
            if rank is not None:
                places.setdefault(rank, []).append(at)
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            left, right, merged = rules[rank]
            for at in sorted(places.pop(rank)):
                taken = after[at]
                if symbols[at] != left or symbols[taken] != right:
                    continue  # changed since it was listed
                symbols[at], symbols[taken] = merged, _GONE
                follow, ahead = after[taken], before[at]  # a border follows every piece
                after[at], before[follow] = follow, at
                new = rank_of(merged << 32 | symbols[follow])
                if new is not None:
                    if new in places:
                        places[new].append(at)
                    else:
                        places[new] = [at]
                        heapq.heappush(active, new)
                if ahead >= 0:
                    new = rank_of(symbols[ahead] << 32 | merged)
                    if new is not None:
                        if new in places:
                            places[new].append(ahead)
                        else:
                            places[new] = [ahead]
                            heapq.heappush(active, new)

    def _runs(self, text: str) -> Iterator[list[str] | int]:
        """The pieces of a text in runs, and the ids of special tokens between them."""
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                yield self.special[part]
            elif len(part) <= RUN_PIECES:
                yield self.pieces.findall(part)
            else:
                found = (m.group() for m in self.pieces.finditer(part))
                while run := list(islice(found, RUN_PIECES)):
                    yield run

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        raw: list[list[bytes]] = []
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if self.held > KNOWN_BYTES:
                self.known, self.held = {}, 0
            self.learn(set().union(*[run for _, run in waiting]).difference(self.known))
            known = self.known.__getitem__
            for i, run in waiting:
                raw[i].append(b"".join(map(known, run)))
            waiting.clear()
            size = 0

        for i, text in enumerate(texts):
            raw.append([])
            for run in self._runs(text) if text else ():
                if isinstance(run, int):
                    flush()  # keeps the order within the text
                    raw[i].append(np.array([run], "<u4").tobytes())
                    continue
                waiting.append((i, run))
                size += len(run)
                if size >= RUN_PIECES:
                    flush()
        flush()
        return [np.frombuffer(b"".join(parts), "<u4") for parts in raw]


def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def _ids_of(stored) -> np.ndarray:
    """Ids of a stored list or packed string of bytes, with -1 for null ids."""
    if isinstance(stored, bytes):
        return np.frombuffer(stored, "<u4").astype(np.int64)
    ids = np.asarray(stored, np.float64)
    return np.where(np.isnan(ids), -1, ids).astype(np.int64)


def _joined(tokens: dict[int, bytes], ids: np.ndarray) -> str:
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    parts = []
    for start in range(0, len(ids), RUN_PIECES):
        run = ids[start : start + RUN_PIECES].tolist()
        parts.append(reader.decode(b"".join([tokens.get(i, b"") for i in run])))
    return "".join(parts) + reader.decode(b"", True)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", packed: bool = False) -> DataFrame:
    """Add ``ids``: an array of integers or, ``packed``, little-endian unsigned 32-bit integers in a row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("binary" if packed else "array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in slices(batch):
                found = encoder.encode(part)
                yield pd.Series([x.tobytes() if packed else x.view("<i4") for x in found], dtype=object)

    kept = without(docs, ("ids",))
    # Not to be evaluated again below a filter on its result.
    return docs.select(*kept, run.asNondeterministic()(F.col(text)).alias("ids"))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of ``ids`` (an array or packed); special tokens are written out."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = shared.value.bytes
        for batch in batches:
            for start in range(0, len(batch), DECODED_ROWS):
                part = batch.iloc[start : start + DECODED_ROWS]
                yield pd.Series(["" if x is None else _joined(tokens, _ids_of(x)) for x in part], dtype=object)

    kept = without(rows, ("decoded",))
    return rows.select(*kept, run.asNondeterministic()(F.col(ids)).alias("decoded"))
