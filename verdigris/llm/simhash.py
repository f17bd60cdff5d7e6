"""SimHash near-duplicates found by meeting in the middle of Hamming balls.

A fingerprint has 64 bits, the majority over the XXH64 hashes of all shingles of
``shingle`` words, repeats included. Fingerprints at ``radius`` or fewer differing bits are
linked; the radius is 2, or 3 with the second round. Three bits are nearly equal texts: ball
hashing does not reach the 5 to 14 bits at which most texts of Jaccard 0.8 lie.

First round: every distinct fingerprint emits itself and its 64 one-bit variants, half the
radius rounded down. Whatever meets on a variant is at 2 bits or fewer, so all of it is
linked to the smallest at once: a bucket of n gives n - 1 links, never all pairs.

Second round, for the 3rd bit of the odd radius: one half of the bits is masked. Three
differing bits leave one half with at most one, so every fingerprint emits both halves as
they are and all their one-bit variants; a half that meets a variant gives a candidate,
which is verified on all 64 bits. Only candidates from different components of the first
round are kept, so dense groups, linked there already, make no pairs here.

Both rounds run on distinct fingerprints; copies only meet their fingerprint. A hot group
of equal texts is therefore one row, and rows meet their component in a join that adaptive
execution can split.

Defined cases: a null, empty or blank text has fingerprint zero, linked like any other; a
text shorter than a shingle is one shingle; rows without id are linked and get the smallest
id of their component, null if it has none; repeated rows share their component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from verdigris.llm.common import unused
from verdigris.llm.components import components
from verdigris.session import materialize

SHINGLE = 3
SEED = 42
HALF = 32
RADIUS = 3
RADII = (2, 3)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        part = hashes[start : start + 8192].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _once(text: Column, shingle: int) -> Column:
    """Fingerprint column that is not evaluated again below a filter on it."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return F.pandas_udf(run, "long").asNondeterministic()(text)


def _near_links(points: DataFrame) -> DataFrame:
    """Links (a, b), a > b, that connect all fingerprints at 2 or fewer bits."""
    here = F.col("fp")
    ball = F.explode(F.array(here, *[here.bitwiseXOR(F.lit(_bit(i))) for i in range(64)]))
    # A variant has at most 65 distinct fingerprints around it.
    met = points.select("fp", ball.alias("variant")).select(
        "fp", F.min("fp").over(Window.partitionBy("variant")).alias("least")
    )
    return met.filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def _bit(i: int) -> int:
    return 1 << i if i < 63 else -(1 << 63)


def _far_links(points: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between components of the first round by fingerprints at 3 or fewer bits."""
    # Null stands for a fingerprint that is its own root.
    placed = points.join(roots, points["fp"] == roots["node"], "left").select("fp", "root")
    placed = materialize(placed, "placed")
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("fp", HALF)
    upper = F.lit(1 << HALF)  # tells the halves apart
    whole = F.array(low, high.bitwiseOR(upper))
    around = F.array(
        low,
        high.bitwiseOR(upper),
        *[low.bitwiseXOR(F.lit(1 << i)) for i in range(HALF)],
        *[high.bitwiseOR(upper).bitwiseXOR(F.lit(1 << i)) for i in range(HALF)],
    )
    centres = placed.select("fp", "root", F.explode(whole).alias("half")).alias("x")
    variants = placed.select("fp", "root", F.explode(around).alias("half")).alias("y")
    x_root, y_root = F.coalesce("x.root", "x.fp"), F.coalesce("y.root", "y.fp")
    close = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= RADIUS
    # Spark sizes an exploded side by its wider rows only: 66 variants of a small table were taken for
    # less than the broadcast limit and collected on the driver.
    met = centres.join(variants.hint("merge"), (F.col("x.half") == F.col("y.half")) & (x_root > y_root) & close)
    return met.select(x_root.alias("a"), y_root.alias("b")).distinct()


def fingerprint_components(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for distinct fingerprints ``fp`` that are not their component's smallest."""
    if radius not in RADII:
        raise ValueError(f"radius {radius} is not one of {RADII}")
    near = components(_near_links(points))
    if radius == 2:
        return near.select(F.col("node").alias("fp"), "root")
    far = _far_links(points, near)
    joined = near.select(F.col("node").alias("a"), F.col("root").alias("b")).union(far)
    return components(joined).select(F.col("node").alias("fp"), "root")


def _grouped(slim: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """Stored (fp, best) over all fingerprints, and (fp, best) of each linked one's component.

    ``best`` is the smallest ``who`` struct. The second frame holds linked fingerprints only.
    """
    points = materialize(slim.groupBy("fp").agg(F.min("who").alias("best")), "points")
    linked = fingerprint_components(points.select("fp"), radius)
    whole = linked.union(linked.select(F.col("root").alias("fp"), "root").distinct())
    members = materialize(whole.join(points, "fp").select("fp", "root", "best"), "members")
    smallest = materialize(members.groupBy("root").agg(F.min("best").alias("best")), "smallest")
    return points, members.select("fp", "root").join(smallest, "root").select("fp", "best")


def _with_best(slim: DataFrame, radius: int) -> DataFrame:
    points, linked = _grouped(slim, radius)
    chosen = points.join(linked.withColumnRenamed("best", "linked"), "fp", "left").select(
        "fp", F.coalesce("linked", "best").alias("best")
    )
    return slim.join(materialize(chosen, "chosen"), "fp")


def _who(*columns):
    """Sorts rows with an id before those without."""
    return F.struct(columns[0].isNull().alias("none"), *columns)


def _name(key: Column) -> Column:
    """The key as text that also tells null apart, so that one plain column joins and groups."""
    return F.when(key.isNull(), "").otherwise(F.concat(F.lit("="), key.cast("string")))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fp, component_id), one row for each row of ``docs``."""
    name = F.col(key).alias("doc_id")
    slim = docs.select(name, _once(F.col(text), shingle).alias("fp"))
    slim = materialize(slim.withColumn("who", _who(F.col("doc_id"))), "fingerprints")
    return _with_best(slim, radius).select("doc_id", "fp", F.col("best.doc_id").alias("component_id"))


def fingerprint_text(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of each component, that of the smallest id (then text hash), all columns kept."""
    row_hash, place, name = unused(docs, "_hash", "_place", "_name")
    content = F.xxhash64(F.col(text), *[F.col(f"`{c}`") for c in docs.columns])
    slim = docs.select(F.col(key).alias("doc_id"), content.alias("hash"), _once(F.col(text), shingle).alias("fp"))
    slim = materialize(slim.withColumn("who", _who(F.col("doc_id"), F.col("hash"))), "fingerprints")
    points, linked = _grouped(slim, radius)
    kept = (
        points.join(linked.withColumnRenamed("best", "linked"), "fp", "left")
        .filter("linked is null or linked = best")
        .select(_name(F.col("best.doc_id")).alias(name), F.col("best.hash").alias(row_hash))
    )
    kept = materialize(kept, "kept")
    # Wholly equal rows share id and hash; the first of them stays. The rank filter also runs
    # before the shuffle, so a row that repeats very often leaves each task once.
    alike = Window.partitionBy(name, row_hash).orderBy(F.lit(0))
    tagged = docs.withColumns({row_hash: content, name: _name(F.col(key))})
    once = tagged.withColumn(place, F.row_number().over(alike)).filter(F.col(place) == 1)
    return once.join(kept, [name, row_hash], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
