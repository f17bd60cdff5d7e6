"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words; a document's expected number of copies is the target
over the size of its source. The whole part is taken for sure. The fractions are rounded in
pairs: probability mass, measured in words, moves from one document to the other until one
of them reaches 0 or 1. Its direction is drawn so that each document keeps its expectation,
and the words of a pair stay the same, so a source's words are kept up to one last document.

Blocks of at most ``BLOCK`` documents are reduced in order, each to its decided documents
and one residual; the residuals of a level form the blocks of the next, a reduction tree
of logarithmic height. Random numbers are hashes of the rows, so reruns agree.

Only DataFrame functions run here. Blocks are cut inside hashed buckets of a source, so a
source with a third of all rows is as many blocks as it needs. Equal rows are numbered, and
the number is part of the hash: copies of one row spread over all buckets of their source.

Defined cases: a null text has size 0; a document of size 0 takes the whole part of its
copies; a null source is a source of its own, last in order; equal rows are rounded on
their own; a source without words has target 0; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from verdigris.llm.common import NOT_BLANK, row_hash, uniform, unused
from verdigris.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2.0
BLOCK = 256
SEED = 9_241


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """(source, source_size, source_rows, target), one row for each source.

    Weights repeat over the sources in code point order, null last. Sources stop at ``most``
    times their size and the excess goes to the others by weight. With sources in the order
    of limit over weight, the first that stays below its limit at the level reached when all
    before it are full fixes that level for all.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    # These windows hold one row for each source.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    ranked = sums.withColumn(
        "weight",
        F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights)),
    ).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    wanted = share * F.sum("source_size").over(everything)
    level = (wanted - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = ranked.select("*", level.alias("level"), F.row_number().over(by_limit).alias("place"))
    free = F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.struct("place", "level"))
    fixed = levels.withColumn("fixed", F.min(free).over(everything))
    target = F.coalesce(F.least("limit", F.col("fixed.level") * F.col("weight")), F.col("limit"))
    return fixed.select("source", "source_size", "source_rows", target.alias("target"))


# One step of the pivotal method: the residual a meets the next document b. ``up`` words could
# move from b to a, ``down`` words from a to b; the direction keeps both expectations.
_UP = "least((1 - acc.x) * acc.size, it.x * it.size)"
_DOWN = "least(acc.x * acc.size, (1 - it.x) * it.size)"
_TO_A = f"(it.u * ({_UP} + {_DOWN}) < {_DOWN})"
_A_DONE = f"""case when {_TO_A} then (1 - acc.x) * acc.size <= it.x * it.size
                  else acc.x * acc.size <= (1 - it.x) * it.size end"""
_STEP = f"""
case when {_A_DONE} then
  named_struct(
    'done', concat(acc.done, array(named_struct('row', acc.row, 'hit', {_TO_A}))),
    'row', it.row, 'size', it.size,
    'x', case when {_TO_A} then greatest(0D, it.x - (1 - acc.x) * acc.size / it.size)
              else least(1D, it.x + acc.x * acc.size / it.size) end)
else
  named_struct(
    'done', concat(acc.done, array(named_struct('row', it.row, 'hit', not {_TO_A}))),
    'row', acc.row, 'size', acc.size,
    'x', case when {_TO_A} then least(1D, acc.x + it.x * it.size / acc.size)
              else greatest(0D, acc.x - (1 - it.x) * it.size / acc.size) end)
end
"""


def _reduce_blocks(open_rows: DataFrame, counts: DataFrame, level: int, block: int, seed: int) -> DataFrame:
    """Each block's decided rows (``done``) and residual (``row``, ``size``, ``x``)."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / block))
    placed = open_rows.join(counts, open_rows["source"].eqNullSafe(counts["of"])).drop("of")
    lot = F.xxhash64(F.lit(seed + level), F.col("hash"))
    placed = placed.withColumn("bucket", F.pmod(lot, buckets)).withColumn("lot", lot)
    in_bucket = Window.partitionBy("source", "bucket").orderBy("lot", "hash", "row")
    number = F.row_number().over(in_bucket) - 1
    cut = placed.withColumns({"number": number, "block": F.floor(number / block)})
    item = F.struct(
        "number", "row", "hash", "size", "x", uniform(F.lit(seed), F.lit(level), F.col("hash"), F.col("number")).alias("u")
    )
    # At most ``block`` rows to each group.
    blocks = cut.groupBy("source", "bucket", "block").agg(F.array_sort(F.collect_list(item)).alias("items"))
    first = "items[0]"
    empty = "cast(array() as array<struct<row: bigint, hit: boolean>>)"
    start = f"named_struct('done', {empty}, 'row', {first}.row, 'size', {first}.size, 'x', {first}.x)"
    reduced = f"aggregate(slice(items, 2, size(items)), {start}, (acc, it) -> {_STEP})"
    return blocks.select("source", F.expr(reduced).alias("r"), F.expr("items[0].hash").alias("hash")).select(
        "source", "hash", "r.*"
    )


def apart(sized: DataFrame) -> DataFrame:
    """``sized`` with ``lot``: the row's hash, in which the copies of a row differ by their number.

    Rows are counted within the partition that stored them (the upper bits of ``row``), so no
    group is larger than a partition, and each partition's count starts where earlier ones end.
    The numbers of equal rows are always 0, 1, 2 and so on, whatever the partitions are.
    """
    stored = sized.withColumn("part", F.shiftright("row", 33))
    runs = stored.groupBy("hash", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition that holds a copy; a row's first partition needs no entry.
    starts = runs.select("hash", "part", F.sum("n").over(earlier).alias("start")).filter("start is not null")
    within = Window.partitionBy("hash", "part").orderBy("row")
    counted = stored.withColumn("number", F.row_number().over(within) - 1).join(starts.hint("merge"), ["hash", "part"], "left")
    number = F.col("number") + F.coalesce("start", F.lit(0))
    lot = F.when(number > 0, F.xxhash64("hash", number)).otherwise(F.col("hash"))
    return counted.select(*sized.columns, lot.alias("lot"))


def round_copies(sized: DataFrame, targets: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``sized`` (row, source, size, hash) with source_size, target and copies."""
    of_source = targets.withColumnRenamed("source", "of")
    rated = apart(sized).join(of_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = rated.withColumn("whole", F.floor(ratio)).withColumn("x", ratio - F.floor(ratio))
    rated = materialize(rated, "rated")
    remaining = rated.filter("size > 0 and x > 0").select("row", "source", F.col("lot").alias("hash"), F.col("size").cast("double").alias("size"), "x")
    level, decided = 0, None
    while True:
        counts = remaining.groupBy(F.col("source").alias("of")).agg(F.count(F.lit(1)).alias("rows"))
        counts = materialize(counts, "open-rows")
        most = counts.agg(F.max("rows")).first()[0] or 0
        if most <= 1:
            break
        reduced = materialize(_reduce_blocks(remaining, counts, level, block, seed), "reduced")
        done = reduced.select(F.explode("done").alias("d")).select("d.row", "d.hit")
        decided = done if decided is None else decided.union(done)
        remaining = reduced.select("row", "source", "hash", "size", "x")
        level += 1
    # The last residual of each source is drawn on its own.
    last = remaining.select("row", (uniform(F.lit(seed), F.lit(-1), F.col("hash")) < F.col("x")).alias("hit"))
    decided = last if decided is None else decided.union(last)
    decided = materialize(decided, "decided")
    # Rows, not sources: by hint neither these nor the hashes taken in ``mix`` are broadcast.
    return rated.drop("lot").join(decided.hint("merge"), "row", "left").withColumn(
        "copies", F.col("whole") + F.coalesce(F.col("hit").cast("long"), F.lit(0))
    )


def measure(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Stored (row, doc_id, source, size, hash): what rounding needs, without the text."""
    slim = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        row_hash(docs).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    return materialize(slim, "sized")


def plan_mix(docs: DataFrame, **columns: str) -> DataFrame:
    """(doc_id, source, size, hash, source_size, target, copies), one row for each row."""
    sized = measure(docs, **columns)
    targets = materialize(source_targets(sized), "targets")
    return round_copies(sized, targets)


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixed table: every row as often as it was taken, all columns kept."""
    own, number, copy = unused(docs, "_hash", "_number", "_copy")
    plan = plan_mix(docs, key=key, source=source, text=text)
    taken = plan.groupBy(F.col("hash").alias(own)).agg(F.sum("copies").alias("_taken")).filter("_taken > 0")
    taken = materialize(taken.withColumnRenamed("_taken", number), "taken")
    tagged = docs.withColumn(own, row_hash(docs))
    # Wholly equal rows are one group; it appears as often as its rows were taken together.
    # The rank filter also runs before the shuffle, so each task sends such a row once.
    alike = Window.partitionBy(own).orderBy(F.lit(0))
    once = tagged.withColumn(copy, F.row_number().over(alike)).filter(F.col(copy) == 1)
    repeated = once.join(taken.hint("merge"), own).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(number))))
    return repeated.drop(own, number, copy)
