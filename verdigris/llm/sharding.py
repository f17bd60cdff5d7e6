"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order of their content. A keyed Feistel network over
pairs (left, right), with left below a and right below b and a * b just above n, permutes
the numbers; a value outside the n rows walks on through the permutation until it is inside
(cycle walking). The place of row i is p(i): shard p(i) mod k, slot p(i) div k. Shards
differ by one row at most, slots have no gaps, and both follow from a row number alone.

Only DataFrame functions run here. Rows are numbered by a stored range sort, so no task
sees more than its range, and a row that repeats very often is split by its position in
the input.

Defined cases: a null text has size 1 and no checksum; equal rows are interchangeable and
get different places; an empty table has no row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.llm.common import row_hash, unused
from verdigris.operators.ordering import number_rows

ROUNDS = 6
SEED = 20_261
MAX_WALK = 256


def _network(value: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network; ``value`` is left * b + right."""

    def turn(acc: Column, number: Column) -> Column:
        left, right = F.floor(acc / b), acc % b
        even = number % 2 == 0
        # Each round shifts one half by a hash of the other, modulo the half's own size.
        shifted_left = (left + F.pmod(F.xxhash64(F.lit(seed), number, right), F.lit(a))) % a
        shifted_right = (right + F.pmod(F.xxhash64(F.lit(seed), number, left), F.lit(b))) % b
        return F.when(even, shifted_left * b + right).otherwise(left * b + shifted_right)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), value, turn)


def permute(position: Column, n: int, seed: int = SEED) -> Column:
    """Place of ``position`` among 0 .. n - 1 under the keyed permutation."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    outside = a * b - n  # a walk leaves the range at most so often
    first = _network(position.cast("long"), a, b, seed)
    if outside:
        steps = F.sequence(F.lit(1), F.lit(min(outside, MAX_WALK)))
        first = F.aggregate(
            steps, first, lambda acc, _: F.when(acc < n, acc).otherwise(_network(acc, a, b, seed))
        )
    if outside <= MAX_WALK:
        return first
    # Beyond MAX_WALK steps has probability below n^(-MAX_WALK / 2): stop rather than misplace.
    return F.when(first < n, first).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def shard_rows(
    df: DataFrame,
    shards: int,
    order_by: list[str],
    seed: int = SEED,
    outputs: tuple[str, str] = ("shard", "slot"),
) -> DataFrame:
    """Add ``shard`` and ``slot`` (replacing columns of that name)."""
    # Rows travel as one struct, so that none of their columns can clash with a working column.
    keys = {f"key{i}": F.col(f"`{c}`") for i, c in enumerate(order_by)}
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    # The tie-break splits a row that repeats very often over several ranges.
    packed = df.select(row, *[c.alias(k) for k, c in keys.items()], F.monotonically_increasing_id().alias("tie"))
    numbered = number_rows(packed, [*keys, "tie"], "position")
    n = df.count()
    placed = numbered.withColumn("place", permute(F.col("position"), n, seed))
    names = {o.lower() for o in outputs}
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in names]
    return placed.select(
        *kept,
        (F.col("place") % shards).cast("int").alias(outputs[0]),
        F.floor(F.col("place") / shards).alias(outputs[1]),
    )


def describe(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32): bytes of the text plus one, and the text's checksum."""
    body = F.col(text)
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its ``shard`` and ``slot``; the order is that of id, then content."""
    (content,) = unused(docs, "_content")
    tagged = docs.withColumn(content, row_hash(docs))
    return shard_rows(tagged, shards, [key, content]).drop(content)
