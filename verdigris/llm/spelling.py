"""Spelling variants: words one edit apart, found by a frontier of states over a relational trie.

The trie is a distributed edge table: a row for each node (a prefix) and letter, with the
letters that may follow and the count of the word that ends there. A state is (word, position,
node, edits). All states of a word's own path, from its middle on, meet the edges of their
node and spend the one edit: another letter (a later one, so that a pair is found from one
side), or a letter the word lacks. Then the frontier walks on exactly, one letter of all
states for each join with the edge table; a state whose word ends where a word of the trie
ends is a pair of neighbours, one whose next letter does not follow is dropped at once.

An edit in the first half of a word is found by the same walk over the reversed words, whose
nodes carry another mark. So no state starts near the root, where a trie is dense and a node
would hold much of all words. A letter put into a run of equal letters is put at its end, so
each pair is found once. The number of joins is half the length of the longest word walked;
words of more than ``LONGEST`` letters are few and meet on hashes of what is left when one
letter is deleted, verified by their edit distance.

Words are counted in each task before the shuffle. Positions in words count code points.

Defined cases: a null, empty or letterless text has no words; a null id counts as the empty
text in the hash that damages words; repeated rows count each; a word without near words
has no form, is its own root and has ``n_near`` 0; an empty table has no words. Extra columns
are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from verdigris.session import materialize

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5
DAMAGED = 199
LONGEST = 64
HELD_WORDS = 400_000  # distinct words a task holds before it hands on their counts

# Words are runs of ASCII letters and of U+00C0 to U+00FF; A-Z are lowered.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in Latin-1, one byte for each letter."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def damaged(key: str, words: Counter[bytes] | set[bytes], modulus: int) -> dict[bytes, bytes]:
    """Those words of a document that lose a letter, and what remains of them."""
    start = zlib.crc32(f"{key}:".encode())
    found = {}
    for word in words:
        code = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if code % modulus == 0:
            at = code % len(word)
            found[word] = word[:at] + word[at + 1 :]
    return found


def count_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    modulus: int = DAMAGED,
) -> DataFrame:
    """(word, n) of the words with at least so many letters and occurrences."""

    def rows(counted: Counter[bytes]) -> pd.DataFrame:
        kept = [(w.decode("latin-1"), n) for w, n in counted.items() if n and len(w) >= least_letters]
        return pd.DataFrame(kept, columns=["word", "n"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted: Counter[bytes] = Counter()
        for batch in batches:
            for name, body in zip(batch["key"], batch["text"], strict=True):
                words = words_of(body)
                counted.update(words)
                for word, left in damaged(name, set(words), modulus).items():
                    times = words.count(word)
                    counted[word] -= times
                    counted[left] += times
                if len(counted) > HELD_WORDS:
                    yield rows(counted)
                    counted = Counter()
        yield rows(counted)

    slim = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    partial = slim.mapInPandas(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _spelled(words: DataFrame) -> DataFrame:
    """(mark, x, n, size, start): each word in both directions, and where its states start."""
    sized = words.select("word", "n", F.length("word").alias("size")).withColumn("half", F.expr("int(size div 2)"))
    ways = F.array(
        F.struct(F.lit(">").alias("mark"), F.col("word").alias("x"), F.col("half").alias("start")),
        F.struct(F.lit("<").alias("mark"), F.reverse("word").alias("x"), (F.col("size") - F.col("half")).alias("start")),
    )
    return sized.select("n", "size", F.inline(ways))


def _edges(spelled: DataFrame) -> DataFrame:
    """(node, letter, depth, follow, end_n): the trie below the least start of a state."""
    least = spelled.agg(F.coalesce(F.min("start"), F.lit(0))).first()[0]
    places = spelled.select("mark", "x", "n", F.explode(F.expr(f"sequence({least}, size - 1)")).alias("at"))
    cut = places.select(
        F.expr("concat(mark, substring(x, 1, at))").alias("node"),
        F.expr("substring(x, at + 1, 1)").alias("letter"),
        F.col("at").alias("depth"),
        F.expr("substring(x, at + 2, 1)").alias("next"),
        "n",
    )
    return cut.groupBy("node", "letter", "depth").agg(
        F.collect_set(F.when(F.col("next") != "", F.col("next"))).alias("follow"),
        F.max(F.when(F.col("next") == "", F.col("n"))).alias("end_n"),
    )


def _goes_on(position: str) -> Column:
    """Whether a state at ``position`` behind an edge ends in a word or can take its next letter."""
    return F.expr(
        f"case when {position} = size then end_n is not null"
        f" else array_contains(follow, substring(x, {position} + 1, 1)) end"
    )


_STATE = ("mark", "x", "n", "size", "position", "node", "end_n")


def _first_frontier(spelled: DataFrame, edges: DataFrame) -> DataFrame:
    """States that have spent their edit, from all states of the words' own paths."""
    own = spelled.select("*", F.explode(F.expr("sequence(start, size)")).alias("at")).withColumn(
        "node", F.expr("concat(mark, substring(x, 1, at))")
    )
    met = own.join(edges, "node")
    here = "substring(x, at + 1, 1)"
    other = F.expr(f"at < size and letter > {here}") & _goes_on("(at + 1)")
    behind_run = F.expr(
        f"case when mark = '>' then at = size or letter <> {here}"
        " else at > start and letter <> substring(x, at, 1) end"
    )
    lacking = behind_run & _goes_on("at")
    met = met.withColumns({"other": other, "lacking": lacking}).filter("other or lacking")
    spent = F.expr("filter(array(if(other, at + 1, null), if(lacking, at, null)), p -> p is not null)")
    return met.select("mark", "x", "n", "size", "node", "letter", "end_n", F.explode(spent).alias("position")).select(
        "mark",
        "x",
        "n",
        "size",
        "position",
        F.concat("node", "letter").alias("node"),
        F.expr("if(position = size, end_n, null)").alias("end_n"),
    )


def _next_frontier(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """Each state one letter further along its word."""
    steps = edges.select(F.col("node").alias("from"), "letter", "follow", "end_n")
    moving = frontier.drop("end_n").withColumn("here", F.expr("substring(x, position + 1, 1)"))
    met = moving.join(steps, (F.col("node") == F.col("from")) & (F.col("here") == F.col("letter")))
    return met.filter(_goes_on("(position + 1)")).select(
        "mark",
        "x",
        "n",
        "size",
        (F.col("position") + 1).alias("position"),
        F.concat("node", "letter").alias("node"),
        F.expr("if(position + 1 = size, end_n, null)").alias("end_n"),
    )


def _pairs(states: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of the states at their end."""
    found = F.expr("substring(node, 2)")
    return states.filter("position = size").select(
        F.when(F.col("mark") == "<", F.reverse("x")).otherwise(F.col("x")).alias("word"),
        "n",
        F.when(F.col("mark") == "<", F.reverse(found)).otherwise(found).alias("near"),
        F.col("end_n").alias("near_n"),
    )


def _long_pairs(words: DataFrame, longest: int) -> DataFrame:
    """Pairs of which one word at least is longer than the walk goes."""
    rests = F.expr("transform(sequence(1, length(word)), i -> xxhash64(concat(substring(word, 1, i - 1), substring(word, i + 1))))")
    keyed = words.filter(F.length("word") >= longest).select(
        "word", "n", F.explode(F.array_distinct(F.concat(rests, F.array(F.xxhash64("word"))))).alias("rest")
    )
    keyed = materialize(keyed, "rests")
    other = keyed.select("rest", F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = keyed.join(other, "rest").filter((F.col("word") < F.col("near")) & (F.length("word") + F.length("near") > 2 * longest))
    return met.select("word", "n", "near", "near_n").distinct().filter(F.levenshtein("word", "near", 1) == 1)


def near_pairs(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(word, n, near, near_n): each unordered pair of words one edit apart, once.

    ``words`` is a stored table of distinct words and their counts.
    """
    walked = words.filter(F.length("word").between(1, longest))
    spelled = materialize(_spelled(walked), "spelled")
    edges = materialize(_edges(spelled), "edges")
    frontier = materialize(_first_frontier(spelled, edges), "frontier")
    pairs = _pairs(frontier)
    while not (moving := frontier.filter("position < size")).isEmpty():
        depth = moving.agg(F.min(F.length("node")).alias("least")).first().least - 1
        frontier = materialize(_next_frontier(moving, edges.filter(F.col("depth") >= depth)), "frontier")
        pairs = pairs.union(_pairs(frontier))
    if not words.filter(F.length("word") > longest).isEmpty():
        pairs = pairs.union(_long_pairs(words, longest))
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: pointers doubled until none moves."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        moved = materialize(moved, "roots")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return links


def group_variants(words: DataFrame, times: int = TIMES, longest: int = LONGEST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n).

    The form of a word is the most frequent word one edit away (ties: the first in code point
    order), if it is at least ``times`` as frequent.
    """
    words = materialize(words.select("word", "n"), "words")
    pairs = materialize(near_pairs(words, longest), "near-pairs")
    both = pairs.union(pairs.select("near", "near_n", "word", "n"))
    best = both.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    chosen = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best"))
    best = best.select("word", "n_near", chosen["near"].alias("form"), (-chosen["less"]).alias("form_n"))
    best = materialize(best, "forms")
    roots = _roots(best.filter("form is not null"))
    return (
        words.join(best, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )
