"""Phrase collocations by dynamic itemset counting.

The corpus falls into ``SHARDS`` shards, by a hash of the text, which are scanned in a cycle. All words are counted
from the first scan on. A phrase of more words is counted from the scan after the one in which
both its subphrases (without its last word, without its first word) have reached the
threshold, whatever their length, so phrases of several lengths are counted in one scan; each
is complete after one full cycle of its own. Scanning ends when a cycle has passed without a
new subphrase. Counts are held by shard, so counting a shard again changes nothing.

A scan has to know which phrases have been reached. Their number grows with the corpus, so
they are not broadcast: each falls into one of ``SLOTS`` slots by a hash, and a slot holds the
last scan in which one of its phrases was reached. This array is of fixed size. A slot shared by several phrases can only make a scan count a phrase too many: its count
is true, and it is left out unless it reaches the threshold, in which case its subphrases have
reached it too.

Most pairs of frequent words are rare, and they grow faster than the corpus. So before the first scan, all pairs are
tallied by a hash into ``TALLY_SLOTS`` slots (the filter of Park, Chen and Yu), which are sent sparsely, in slices, with
three bytes for each slot that a block of text touches. A pair whose slot stays below the threshold is rare, and no scan
spells it or sends it on. What a scan knows of the tally is one bit for each slot, at most 32 MB (packed while sent);
here, too, a shared slot only costs counting. Words are not tallied: they are few beside the pairs.

A task numbers the words of a block of at most about ``BLOCK_WORDS`` words, counts all active
phrases of one length after another on arrays, and hands on one row for each distinct phrase.
Rows of all tasks are summed before they are merged with the running counts, of which those of
complete phrases below the threshold are dropped. Once all pairs are complete, the shards are
stored without the words that no longer phrase can hold.

Scores are exact: products are decimals of 38 digits.

Defined cases: a null text counts as empty; a null language is ``und``, like documents marked
so; repeated rows count each; an empty table has no phrases. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from verdigris.session import materialize, scratch_path

LONGEST = 5
THRESHOLD = 100
SHARE = 100  # percent of a phrase's occurrences that lie in one longer phrase
TOP = 2_000
SHARDS = 2
SLOTS = 1 << 22
TALLY_SLOTS = 1 << 28
SLICE = 1 << 16  # slots of one row of a tally
SLICE_TASKS = 64  # tasks that sum up the tallies; each holds its share of the slices
BLOCK_WORDS = 2_000_000
SENT_ROWS = 200_000  # rows of one record batch
TEXT_WORDS = 50_000  # words of a stored text without rare pairs, at least
UNKNOWN = "und"
NEVER = -1  # for slots without phrases

# A-Z are lowered, these characters end a piece, a tab is a blank.
_ENDS = ".,;:!?\n\v\f\r"
_BORDER = 0xFF  # occurs in no UTF-8 text
_NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else _BORDER if chr(c) in _ENDS else 0x20 if c == 0x09 else c for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PART = pa.schema(
    [("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("fresh", pa.int64()), ("until", pa.int32())]
)


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, with a border between its pieces."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).replace(b"\xff", b" \xff ").split()


def _word_codes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxh64_intdigest(lang.encode())
    return np.array([xxh64_intdigest(w, seed) for w in words], np.uint64)


def _slots(codes: np.ndarray, slots: int) -> np.ndarray:
    return ((codes ^ (codes >> np.uint64(29))) * _BASE >> np.uint64(32)).astype(np.int64) % slots


def _longer(codes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Codes of phrases from those of all words but the last, and of the last word."""
    return codes * _BASE + last


class Reached:
    """The last scan in which a phrase of each slot reached the threshold, or ``NEVER``."""

    def __init__(self, slots: int):
        self.last = np.full(slots, NEVER, np.int16)

    def note(self, slots: np.ndarray, scan: int) -> None:
        self.last[slots] = scan

    def of(self, codes: np.ndarray) -> np.ndarray:
        found = self.last[_slots(codes, len(self.last))]
        found[:1] = NEVER  # number 0 is no phrase
        return found


class Frequent:
    """One bit for each slot of the tally: whether its pairs occur ``threshold`` times together."""

    def __init__(self, slots: int):
        self.slots = slots
        self.bits = np.zeros(-(-slots // SLICE) * SLICE // 8, np.uint8)

    def note(self, number: int, bits: bytes) -> None:
        start = number * SLICE // 8
        self.bits[start : start + SLICE // 8] = np.frombuffer(bits, np.uint8)

    def __getstate__(self) -> tuple[int, bytes]:
        return self.slots, zlib.compress(self.bits, 1)

    def __setstate__(self, state: tuple[int, bytes]) -> None:
        self.slots = state[0]
        self.bits = np.frombuffer(zlib.decompress(state[1]), np.uint8)

    def has(self, codes: np.ndarray) -> np.ndarray:
        slots = _slots(codes, self.slots)
        return (self.bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


class _Block:
    """Words of one language in a task."""

    def __init__(self, lang: str):
        self.lang = lang
        self.numbers = _Numbers({b"\xff": 0})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        words = words_of(text)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(words) + 1

    def _flat(self) -> np.ndarray:
        return np.concatenate(self.parts).astype(np.int64)

    def tallied(self, slots: int) -> np.ndarray:
        """The slots of the pairs, each as often as it occurs."""
        flat = self._flat()
        codes = _word_codes(list(self.numbers), self.lang)
        first, second = flat[:-1], flat[1:]
        pair = (first != 0) & (second != 0)
        return _slots(_longer(codes[first[pair]], codes[second[pair]]), slots)

    def counts(
        self, reached: Reached, frequent: Frequent, scan: int, shards: int, longest: int
    ) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, k, fresh, until) of the phrases that may be active in this scan.

        ``until`` is the scan by which the phrase is complete, as far as is known.
        """
        flat = self._flat()
        words = list(self.numbers)
        spelled = pa.array(words, pa.binary())
        if scan < shards:
            found = np.bincount(flat, minlength=len(words))[1:]
            yield from self._rows(spelled[1:], 1, found, np.full(len(found), shards - 1))
            yield from self._rows(pa.array([b""], pa.binary()), 0, np.array([found.sum()]), np.array([shards - 1]))
        word_codes = _word_codes(words, self.lang)
        # For each position the number of the phrase that begins there (0 for none), and for each
        # phrase when it may have been reached.
        at, codes = flat, word_codes
        last = reached.of(codes)
        for k in range(2, longest + 1):
            known = last[at] != NEVER
            places = np.flatnonzero(known[:-1] & known[1:])
            if k == 2:
                places = places[frequent.has(_longer(codes[at[places]], word_codes[at[places + 1]]))]
            if not len(places):
                return
            left, right = at[places], at[places + 1]
            _, where, which, found = np.unique(
                left * len(codes) + right, return_index=True, return_inverse=True, return_counts=True
            )
            left, right, begin = left[where], right[where], places[where]
            until = np.maximum(last[left], last[right]) + shards
            active = until >= scan
            if active.any():
                chosen = begin[active]
                parts = [spelled.take(pa.array(flat[chosen + i])) for i in range(k)]
                yield from self._rows(pc.binary_join_element_wise(*parts, b" "), k, found[active], until[active])
            at = np.zeros(len(flat) - k + 1, np.int64)
            at[places] = which + 1
            last_words = word_codes[flat[begin + k - 1]]
            codes = np.concatenate((np.zeros(1, np.uint64), _longer(codes[left], last_words)))
            last = reached.of(codes)

    def _rows(self, phrases: pa.Array, k: int, found: np.ndarray, until: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(phrases), SENT_ROWS):
            part = phrases[start : start + SENT_ROWS]
            columns = [
                pa.repeat(pa.scalar(self.lang, pa.string()), len(part)),
                part.cast(pa.string()),
                pa.array(np.full(len(part), k, np.int32)),
                pa.array(found[start : start + SENT_ROWS].astype(np.int64)),
                pa.array(until[start : start + SENT_ROWS].astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_PART)

    def without_rare_pairs(self, reached: Reached, frequent: Frequent) -> Iterator[str]:
        """What the texts hold in runs of three words or more whose pairs all may have been reached."""
        flat = self._flat()
        words = list(self.numbers)
        codes = _word_codes(words, self.lang)
        first, second = flat[:-1], flat[1:]
        pairs = np.concatenate((np.zeros(1, np.uint64), _longer(codes[first], codes[second])))
        known = (reached.of(pairs)[1:] != NEVER) & frequent.has(pairs[1:]) & (first != 0) & (second != 0)
        known = np.concatenate((known, [False]))
        runs = known & np.concatenate((known[1:], [False]))  # a run of three words begins here
        kept = runs.copy()
        kept[1:] |= runs[:-1]
        kept[2:] |= runs[:-2]
        # Words of a run stand side by side; a border follows where a pair is rare.
        line = np.stack((flat + 1, np.where(kept & known, 0, 1)), axis=1)[kept].ravel()
        line = line[line != 0] - 1
        borders = np.flatnonzero(line == 0)
        words[0] = b"\n"
        start = 0
        while start < len(line):
            end = borders[min(np.searchsorted(borders, start + TEXT_WORDS), len(borders) - 1)] + 1
            yield b" ".join([words[i] for i in line[start:end].tolist()]).decode("utf-8", "replace")
            start = end


def in_shards(docs: DataFrame, lang: str, text: str, shards: int) -> DataFrame:
    """(lang, text, shard); the shard follows from the text, so that nothing has to be stored."""
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.col(text), F.col(lang)), F.lit(shards)).cast("int").alias("shard"),
    )


def _blocks(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[list[_Block]]:
    """The texts of a task in blocks, one for each language."""
    blocks: dict[str, _Block] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            name = lang.as_py()
            block = blocks.setdefault(name, _Block(name))
            held -= block.size
            block.add(text.as_py())
            held += block.size
            if held >= block_words:
                yield list(blocks.values())
                blocks, held = {}, 0
    if blocks:
        yield list(blocks.values())


def _tally(rows: DataFrame, threshold: int, slots: int, block_words: int) -> Frequent:
    """Which slots the pairs of the whole corpus fill up to the threshold."""
    # One block's count matters up to the threshold only.
    kind = np.min_scalar_type(threshold)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in _blocks(batches, block_words):
            found = np.concatenate([block.tallied(slots) for block in blocks])
            found, counts = np.unique(found.astype(np.uint32), return_counts=True)
            counts = np.minimum(counts, threshold).astype(kind)
            numbers, starts = np.unique(found // SLICE, return_index=True)
            places = (found % SLICE).astype(np.uint16)
            ends = np.append(starts[1:], len(found))
            columns = [
                pa.array(numbers.astype(np.int32)),
                pa.array([places[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
                pa.array([counts[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "places", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
                if number not in sums:
                    sums[number] = np.zeros(SLICE, np.int64)
                sums[number][np.frombuffer(places, np.uint16)] += np.frombuffer(counts, kind)
        full = {number: held >= threshold for number, held in sums.items() if (held >= threshold).any()}
        bits = [zlib.compress(np.packbits(held, bitorder="little"), 1) for held in full.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(full), pa.int32()), pa.array(bits, pa.binary())], ["slice", "bits"])

    tallies = rows.select("lang", "text").mapInArrow(tally, "slice int, places binary, counts binary")
    sums = tallies.repartition(SLICE_TASKS, "slice").mapInArrow(total, "slice int, bits binary")
    frequent = Frequent(slots)
    for row in sums.collect():
        frequent.note(row["slice"], zlib.decompress(row["bits"]))
    return frequent


def _shorten(rows: DataFrame, reached: Reached, frequent: Broadcast, block_words: int) -> DataFrame:
    """The shards without what no phrase of three words can lie in, once pairs are complete."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(reached)

    def left(blocks: dict) -> Iterator[pa.RecordBatch]:
        for (lang, shard), block in blocks.items():
            for text in block.without_rare_pairs(shared.value, frequent.value):
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang], "text": [text], "shard": pa.array([shard], pa.int32())}
                )

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[tuple, _Block] = {}
        held = 0
        for batch in batches:
            for lang, text, shard in zip(*(batch.column(i) for i in range(3))):
                key = (lang.as_py(), shard.as_py())
                block = blocks.setdefault(key, _Block(key[0]))
                held -= block.size
                block.add(text.as_py())
                held += block.size
                if held >= block_words:
                    yield from left(blocks)
                    blocks, held = {}, 0
        yield from left(blocks)

    path = scratch_path(spark, "short-shards")
    short = rows.select("lang", "text", "shard").mapInArrow(shorten, "lang string, text string, shard int")
    short.write.partitionBy("shard").parquet(path)
    return spark.read.schema(short.schema).parquet(path)


def _scan(
    shard: DataFrame, reached: Reached, frequent: Broadcast, scan: int, shards: int, longest: int, block_words: int
) -> DataFrame:
    shared = shard.sparkSession.sparkContext.broadcast(reached)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in _blocks(batches, block_words):
            for block in blocks:
                yield from block.counts(shared.value, frequent.value, scan, shards, longest)

    return shard.select("lang", "text").mapInArrow(count, "lang string, phrase string, k int, fresh long, until int")


def _merge(state: DataFrame | None, fresh: DataFrame, scan: int, shards: int, threshold: int) -> DataFrame:
    """Running counts (lang, phrase, k, a count for each shard, reached) after a scan."""
    held = [f"c{i}" for i in range(shards)]
    nothing = F.lit(None).cast("long")
    rows = fresh.select("*", *[nothing.alias(c) for c in held], F.lit(None).cast("int").alias("reached"))
    if state is not None:
        rows = rows.unionByName(state.withColumn("fresh", nothing))
    merged = rows.groupBy("lang", "phrase", "k").agg(
        F.sum("fresh").alias("fresh"), *[F.max(c).alias(c) for c in (*held, "until", "reached")]
    )
    now = held[scan % shards]
    merged = merged.withColumn(now, F.coalesce(now, "fresh")).drop("fresh")
    total = sum((F.coalesce(c, F.lit(0).cast("long")) for c in held), F.lit(0).cast("long"))
    merged = merged.withColumn("reached", F.coalesce("reached", F.when(total >= threshold, F.lit(scan))))
    # A phrase that is complete below the threshold goes. Should a subphrase be reached only
    # later (its slot was shared), the phrase is counted again for a whole cycle.
    return merged.filter((F.col("k") == 0) | F.col("reached").isNotNull() | (F.col("until") > scan))


def _new_slots(state: DataFrame, scan: int, longest: int, slots: int) -> np.ndarray:
    """Slots of the phrases reached in this scan that a longer phrase can begin or end with."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _word_codes(phrase.encode("utf-8", "surrogatepass").split(b" "), lang)
                code = words[:1]
                for i in range(1, len(words)):
                    code = _longer(code, words[i : i + 1])
                codes.append(code)
            found = np.unique(_slots(np.concatenate(codes), slots)) if codes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["slot"])

    new = state.filter((F.col("reached") == scan) & F.col("k").between(1, longest - 1)).select("lang", "phrase")
    rows = new.mapInArrow(place, "slot long").distinct().toPandas()
    return rows["slot"].to_numpy(np.int64)


def count_phrases(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    shards: int = SHARDS,
    slots: int = SLOTS,
    block_words: int = BLOCK_WORDS,
    tally_slots: int = TALLY_SLOTS,
) -> DataFrame:
    """(lang, phrase, k, f): phrases of up to ``longest`` words that occur ``threshold`` times.

    The row of no words (k 0) has the number of words of the language.
    """
    rows = in_shards(docs, lang, text, shards)
    frequent = rows.sparkSession.sparkContext.broadcast(_tally(rows, threshold, tally_slots, block_words))
    reached, state, scan, news = Reached(slots), None, 0, -1
    while scan < shards or scan <= news + shards:
        shard = rows.filter(F.col("shard") == scan % shards)
        fresh = _scan(shard, reached, frequent, scan, shards, longest, block_words)
        state = materialize(_merge(state, fresh, scan, shards, threshold), "phrase-counts")
        found = _new_slots(state, scan, longest, slots)
        if len(found):
            reached.note(found, scan)
            news = scan
        scan += 1
        if scan == 2 * shards and longest > 2:
            rows = _shorten(rows, reached, frequent, block_words)
    total = sum((F.coalesce(f"c{i}", F.lit(0).cast("long")) for i in range(shards)), F.lit(0).cast("long"))
    counted = state.filter("k = 0 or reached is not null").select("lang", "phrase", "k", total.alias("f"))
    return materialize(counted, "phrases")


def _between(start: str, size: str) -> str:
    return f"array_join(slice(words, {start}, {size}), ' ')"


def mine(counted: DataFrame, top: int = TOP, share: int = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of each language.

    ``counted`` is what ``count_phrases`` gives. A phrase is scored by the lowest of its cuts
    in two; one that lies inside a longer phrase with ``share`` percent of its count is left
    out. Such a longer phrase has parts of one word more that are as frequent, so those one
    word longer are enough to look at.
    """
    phrases = counted.filter("k >= 2").withColumn("words", F.split("phrase", " "))
    exact = "decimal(38, 0)"
    cuts = phrases.select("lang", "phrase", "k", F.col("f").alias("a"), "words", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", F.expr(_between("1", "cut")).alias("head"), F.expr(_between("cut + 1", "k - cut")).alias("tail")
    )
    parts = counted.filter("k >= 1")
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    sizes = counted.filter("k = 0").select("lang", F.col("f").alias("n"))
    met = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(sizes, "lang")
    score = F.expr(f"(cast(a as {exact}) * 1000 * n) div (cast(l as {exact}) * r)")
    scored = met.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("best"))
    scored = scored.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("n").alias("n"), F.min("best").alias("best"))
    inner = F.array(F.expr(_between("1", "k - 1")), F.expr(_between("2", "k - 1")))
    inside = phrases.filter("k >= 3").select("lang", "f", F.explode(inner).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    free = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("best.l").alias("l"),
        F.col("best.r").alias("r"),
        "n",
        F.col("best.score").alias("score"),
    )


def mine_sql(threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, share: int = SHARE) -> str:
    """DuckDB SQL for ``mine`` over ``documents``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k - 1}], ' ')))"
        f" AS phrase FROM words WHERE len(w) >= {k}"
        for k in range(1, longest + 1)
    )
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         unnest(regexp_split_to_array(translate(text, '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
f AS (SELECT lang, k, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= {threshold}),
cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, h.f AS l, t.f AS r, s.n,
         ((1000::HUGEINT * c.a * s.n) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
  JOIN sizes s ON s.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, a AS longer, array_to_string(w[b:b + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS b FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))),
inside AS (SELECT lang, phrase, max(longer) AS longer FROM inner_parts GROUP BY ALL),
free AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < {share} * b.a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
WHERE rank <= {top}"""
