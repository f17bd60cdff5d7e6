"""Exact top-k inner products by best-first search in M-trees.

Vectors become integers. Adding one coordinate that brings every vector to the longest
length R turns the largest inner product into the smallest distance: for a query q,
d(q, x)^2 = |q|^2 + R^2 - 2 q.x. In that metric space rows are dealt to shards around
bounded sampled pivots; a pivot with many rows is split into as many shards as it needs.
Each shard becomes an M-tree: pages of entries, each with its distance to the page's
routing vector, inner entries also with a covering radius. Pages are stored as rows.

A query's k-th best score over a sample of rows bounds its search from the start. With the
pivots' covering radii it rules out pivots with all their shards. Queries stay rows: a query
goes to the shards of its remaining pivots, queries of a length in blocks, so that one cell of
the shuffle holds the pages of one shard and the queries of one block, both bounded. In a
cell each query is searched best page first. Stored distances to the parent bound an entry's
distance from both sides by the triangle inequality, so most distances are never computed.

Bounds have a margin above rounding errors and scores are exact integers, ties included: a
page whose bound equals the k-th score is still opened if it holds a smaller id. While the
longest vector's square stays below 2^53, sums of products are exact in floating point.
Beyond, vectors are scaled by a power of two for the bounds, and every row whose rounded score
could be among the best is scored again in Python integers.

Defined cases: vectors that are null, empty, hold a null or non-finite component (also after
multiplying by 256), or have no id, take no part; vectors meet only vectors of their own length,
of which there may be any number; rows with the query's id are its own; repeated queries count
once and repeated candidates each; a score outside 64 bits ranks by its exact value and is
returned as the nearest 64-bit integer; an empty table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from operator import mul
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from verdigris.session import materialize

SCALE = 256
MAX_PIVOTS = 16  # for each vector length
SAMPLE = 1_024  # rows whose scores bound the searches, for each vector length
SHARD_ROWS = 4_096
PAGE = 512  # entries of a page
QUERY_BLOCK = 8_192
EXACT_SINGLE = 1 << 22  # no product of two vectors is larger than the longest one's square
EXACT_DOUBLE = 1 << 53
LENGTHS = 64  # vector lengths that are worked through together
_PAGES = "dim int, shard string, page int, leaf boolean, kids array<long>, gaps array<double>, radii array<double>, least array<long>, vectors binary"
_HITS = "query long, query_id long, vec_id long, score long, place binary"


class _Reach(NamedTuple):
    """Square of the longest vector of a length after scaling by 2^-shift; ``exact`` without scaling."""

    square: float
    shift: int
    exact: bool

    def scaled(self, vectors: np.ndarray) -> np.ndarray:
        return vectors if self.exact else np.ldexp(vectors, -self.shift)


def _reach(square: float, norm: float) -> _Reach:
    if square < EXACT_DOUBLE:
        return _Reach(square, 0, True)
    shift = int(np.frexp(norm)[1])
    return _Reach(float(np.ldexp(norm, -shift)) ** 2 * (1 + 1e-12), shift, False)


def quantise(vector: Column) -> Column:
    """floor(256 * x) of each component as a whole double, or null where the vector takes no part."""
    scaled = F.transform(vector, lambda x: x.cast("double") * SCALE)
    finite = F.forall(scaled, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))))
    # Doubles from 2^53 on are whole, and ``floor`` would turn them into 64-bit integers.
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < EXACT_DOUBLE, F.floor(y).cast("double")).otherwise(y))
    return F.when(finite & (F.size(vector) > 0), whole)


def _place(score: int) -> bytes:
    """Bytes that sort like the integer, of any size."""
    size = (abs(score).bit_length() + 7) // 8
    if score >= 0:
        return (0x8000 + size).to_bytes(2, "big") + score.to_bytes(size, "big")
    return (0x7FFF - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + score).to_bytes(size, "big")


def _lift(vectors: np.ndarray, reach: float) -> np.ndarray:
    """Vectors with the coordinate that brings them to length sqrt(reach)."""
    rest = np.maximum(reach - (vectors**2).sum(axis=1), 0)
    return np.hstack([vectors, np.sqrt(rest)[:, None]])


def _gap(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


class _Builder:
    """Bulk-loads the pages of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, reach: _Reach):
        self.ids, self.vectors = ids, vectors
        self.points = _lift(reach.scaled(vectors), reach.square)
        self.kind = "<i4" if reach.exact else "<f8"
        self.pages: list[tuple] = []

    def _page(self, leaf, kids, gaps, radii, least, rows) -> int:
        packed = self.vectors[rows].astype(self.kind).tobytes()
        self.pages.append((leaf, list(kids), list(gaps), list(radii), list(least), packed))
        return len(self.pages) - 1

    def _split(self, rows: np.ndarray) -> list[np.ndarray]:
        """Parts around pivots taken evenly from the rows; equal points are cut by id."""
        ways = min(PAGE, max(2, -(-len(rows) // PAGE)))
        pivots = self.points[rows[np.linspace(0, len(rows) - 1, ways).astype(int)]]
        # All points have one length, so the nearest pivot has the largest product.
        owner = np.argmax(self.points[rows] @ pivots.T, axis=1)
        parts = [rows[owner == way] for way in range(ways)]
        # A part with most of the rows (equal or very dense points) is cut by id instead, so
        # that the depth stays logarithmic and pages stay full.
        step, cut = -(-len(rows) // ways), []
        for part in parts:
            whole = 2 * len(part) <= len(rows)
            cut += [part] if whole else [part[i : i + step] for i in range(0, len(part), step)]
        return [p for p in cut if len(p)]

    def build(self, rows: np.ndarray, depth: int = 0) -> tuple[int, int, float]:
        """Page number, row of the routing vector and covering radius."""
        points = self.points[rows]
        route = int(rows[np.argmin(_gap(points, points.mean(axis=0)))])
        gaps = _gap(points, self.points[route])
        radius = float(gaps.max())
        if len(rows) <= PAGE:
            return self._page(True, self.ids[rows], gaps, [], self.ids[rows], rows), route, radius
        kids, routes, radii, least = [], [], [], []
        for part in self._split(rows):
            page, centre, wide = self.build(part, depth + 1)
            kids.append(page)
            routes.append(centre)
            radii.append(wide)
            least.append(int(self.ids[part].min()))
        to_parent = _gap(self.points[routes], self.points[route])
        return self._page(False, kids, to_parent, radii, least, np.array(routes)), route, radius


def _build(reach: dict[int, _Reach]):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        dim, shard = key
        frame = frame.sort_values("vec_id", kind="stable")
        builder = _Builder(frame["vec_id"].to_numpy(np.int64), np.stack(frame["v"].to_numpy()), reach[int(dim)])
        _, route, radius = builder.build(np.arange(len(frame)))
        # The root gets an entry of its own: its routing vector, radius and smallest id.
        builder._page(False, [len(builder.pages) - 1], [0.0], [radius], [int(builder.ids.min())], np.array([route]))
        out = pd.DataFrame(builder.pages, columns=["leaf", "kids", "gaps", "radii", "least", "vectors"])
        return out.assign(dim=dim, shard=shard, page=np.arange(len(out)))[
            ["dim", "shard", "page", "leaf", "kids", "gaps", "radii", "least", "vectors"]
        ]

    return run


class _Tree:
    def __init__(self, frame: pd.DataFrame, dim: int, reach: _Reach):
        self.reach, self.dim = reach, dim
        self.leaf = frame["leaf"].to_numpy()
        self.kids = [np.asarray(x, np.int64) for x in frame["kids"]]
        self.gaps = [np.asarray(x, np.float64) for x in frame["gaps"]]
        self.radii = [np.asarray(x, np.float64) for x in frame["radii"]]
        self.least = [np.asarray(x, np.int64) for x in frame["least"]]
        # Sums of integer products stay exact in single precision below 2^24.
        self.kind = np.float32 if reach.exact and reach.square < EXACT_SINGLE else np.float64
        stored = "<i4" if reach.exact else "<f8"
        self.whole = [np.frombuffer(x, stored).reshape(-1, dim) for x in frame["vectors"]]
        self.vectors = [reach.scaled(x).astype(self.kind) for x in self.whole]

    def search(self, own: int, whole: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
        """(score, id) of the k best rows, those below ``floor`` left out."""
        exact, shift = self.reach.exact, 2 * self.reach.shift
        query = self.reach.scaled(whole)
        digits = None if exact else [int(c) for c in whole]
        length = float(query @ query)
        asked = query.astype(self.kind)
        both = length + self.reach.square
        margin, blur = _margins(both, self.dim, exact)
        found: list[tuple[int, int]] = []  # heap of (score, -id), worst first
        # ``worst`` bounds rounded scores from below; the k-th exact score is ``found[0]``.
        worst, worst_id = floor, np.inf
        widest = np.sqrt(max(both - 2 * (worst - margin), 0)) if np.isfinite(worst) else np.inf
        top = len(self.leaf) - 1
        queue = [(-np.inf, top, 0.0)]  # (-bound, page, distance of the query to its routing vector)
        while queue:
            bound, page, far = heapq.heappop(queue)
            if -bound < worst:
                break
            kids, gaps, vectors = self.kids[page], self.gaps[page], self.vectors[page]
            radii = 0.0 if self.leaf[page] else self.radii[page]
            if page == top:
                open_ = np.arange(len(kids))
            else:
                open_ = np.flatnonzero(np.abs(far - gaps) - radii <= widest + margin)
            if not len(open_):
                continue
            near = vectors if len(open_) == len(kids) else vectors[open_]
            scores = (near @ asked).astype(np.float64)
            if self.leaf[page]:
                good = scores >= worst
                for row, score, name in zip(open_[good].tolist(), scores[good].tolist(), kids[open_[good]].tolist(), strict=True):
                    if name == own or (exact and score == worst and name > worst_id):
                        continue
                    score = int(score) if exact else sum(map(mul, digits, map(int, self.whole[page][row].tolist())))
                    if len(found) == k:
                        if (score, -name) <= found[0]:
                            continue
                        heapq.heapreplace(found, (score, -name))
                    else:
                        heapq.heappush(found, (score, -name))
                    least = found[0][0] if exact else _unscaled(found[0][0], shift) - blur
                    if len(found) == k and least >= worst:
                        worst, worst_id = float(least), -found[0][1]
                        widest = np.sqrt(max(both - 2 * (worst - margin), 0))
            else:
                away = np.sqrt(np.maximum(both - 2 * scores, 0))
                closest = np.maximum(away - radii[open_], 0)
                bounds = (both - closest**2) / 2 + margin
                bounds = np.floor(bounds) if exact else bounds
                first = self.least[page][open_]
                for i in np.flatnonzero((bounds > worst) | ((bounds == worst) & (first <= worst_id))).tolist():
                    heapq.heappush(queue, (-bounds[i], int(kids[open_[i]]), float(away[i])))
        return [(score, -name) for score, name in found]


def _margins(both: float, dim: int, exact: bool) -> tuple[float, float]:
    """What rounding may take from a distance or bound, and from a score."""
    if exact:
        return 2e-7 * both + 0.01, 0.0
    return 1e-6 * (1 + dim / 64) * both, (dim + 16) * 2.3e-16 * both


def _unscaled(score: int, shift: int) -> float:
    """An exact score on the scale of the bounds, rounded."""
    drop = max(score.bit_length() - 80, 0)
    return float(np.ldexp(float(score >> drop), drop - shift))


def _search(reach: dict[int, _Reach], k: int):
    def run(key, pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(pages) and len(queries):
            dim = int(key[0])
            tree = _Tree(pages.sort_values("page"), dim, reach[dim])
            for number, own, vector, floor in zip(queries["query"], queries["query_id"], queries["v"], queries["floor"], strict=True):
                for score, name in tree.search(own, np.asarray(vector, np.float64), k, floor):
                    near = min(max(score, -(1 << 63)), (1 << 63) - 1)
                    rows.append((number, own, name, near, _place(score)))
        return pd.DataFrame(rows, columns=["query", "query_id", "vec_id", "score", "place"])

    return run


def _plan_searches(
    queries: DataFrame, reach: dict[int, _Reach], samples, radii: dict[int, dict[int, float]], k: int
) -> DataFrame:
    """Queries with ``floor``, the k-th best score over the sample, and the pivots that may hold a better row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            floors, open_ = [], []
            for dim, own, vector in zip(batch["dim"], batch["query_id"], batch["v"], strict=True):
                at = reach[dim]
                query = at.scaled(np.asarray(vector, np.float64))
                ids, points = samples.value[dim]
                both = float(query @ query) + at.square
                margin, blur = _margins(both, dim, at.exact)
                scores = (points[:, :-1] @ query)[ids != own]
                floor = float(np.partition(scores, -k)[-k]) - blur if len(scores) >= k else -np.inf
                widest = np.sqrt(max(both - 2 * (floor - margin), 0)) if np.isfinite(floor) else np.inf
                away = np.sqrt(np.maximum(both - 2 * (points[:MAX_PIVOTS, :-1] @ query), 0))
                floors.append(floor)
                open_.append([p for p, radius in radii[dim].items() if away[p] - radius <= widest + margin])
            yield batch.assign(floor=floors, pivots=open_)

    schema = "query long, query_id long, dim int, v array<double>, floor double, pivots array<int>"
    return queries.select("query", "query_id", "dim", "v").mapInPandas(run, schema)


def _draw_limit(rows: int, least: int) -> int:
    """Draws up to here are expected of four times ``SAMPLE`` rows; at least one row has its draw there."""
    return max(least, -(1 << 63) + min((1 << 64) - 1, 4 * SAMPLE * (1 << 64) // rows))


def _top_of_lengths(
    spark: SparkSession, clean: DataFrame, reach: dict[int, _Reach], limits: dict[int, int], k: int
) -> DataFrame:
    """(query, query_id, vec_id, score, place) of the best rows of each shard, for these lengths."""
    clean = clean.filter(F.col("dim").isin(list(reach)))
    # At most ``SAMPLE`` rows of each of ``LENGTHS`` lengths; the limit keeps most rows out of the sort.
    bounds = F.broadcast(spark.createDataFrame(list(limits.items()), "dim int, limit long"))
    drawn = Window.partitionBy("dim").orderBy("draw", "vec_id", "v")
    near = clean.join(bounds, "dim").filter(F.col("draw") <= F.col("limit"))
    rows = near.withColumn("_draw", F.row_number().over(drawn)).filter(F.col("_draw") <= SAMPLE)
    by_dim: dict[int, list] = {dim: [] for dim in reach}
    for row in rows.orderBy("dim", "_draw").select("dim", "vec_id", "v").collect():
        by_dim[row["dim"]].append(row)
    points = {
        dim: (np.array([r.vec_id for r in found]), _lift(reach[dim].scaled(np.array([r.v for r in found], np.float64)), reach[dim].square))
        for dim, found in by_dim.items()
    }
    samples = spark.sparkContext.broadcast(points)

    def deal(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near, gap = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            sizes = batch.map(len).to_numpy()
            for dim in np.unique(sizes):
                at, rows = reach[int(dim)], np.flatnonzero(sizes == dim)
                lifted = _lift(at.scaled(np.stack(batch.iloc[rows].to_numpy()).astype(np.float64)), at.square)
                pivots = samples.value[int(dim)][1][:MAX_PIVOTS]
                near[rows] = np.argmax(lifted @ pivots.T, axis=1)
                gap[rows] = _gap(lifted, pivots[near[rows]])
            yield pd.DataFrame({"pivot": near, "gap": gap})

    dealt = clean.select("dim", "vec_id", "v", F.pandas_udf(deal, "pivot int, gap double")("v").alias("d"))
    dealt = materialize(dealt.select("dim", "vec_id", "v", "d.*"), "dealt")
    # At most ``MAX_PIVOTS`` rows of each of ``LENGTHS`` lengths.
    sizes = dealt.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("parts"), F.max("gap").alias("radius"))
    sizes = materialize(sizes, "pivots")
    radii: dict[int, dict[int, float]] = {dim: {} for dim in reach}
    for row in sizes.collect():
        radii[row["dim"]][row["pivot"]] = row["radius"]
    split = dealt.join(F.broadcast(sizes), ["dim", "pivot"])
    part = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("parts"))
    split = split.withColumn("shard", F.concat_ws("-", "pivot", part))
    # A shard holds about ``SHARD_ROWS`` rows at most.
    pages = split.select("dim", "shard", "vec_id", "v").groupBy("dim", "shard").applyInPandas(_build(reach), _PAGES)
    pages = materialize(pages, "pages")

    asked = clean.filter("asks").select(F.col("vec_id").alias("query_id"), "dim", "v").distinct()
    asked = materialize(asked.withColumn("query", F.xxhash64("query_id", "v")), "queries")
    blocks = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
    # One row for each length.
    blocks = F.broadcast(materialize(blocks, "blocks"))
    planned = _plan_searches(asked, reach, samples, radii, k).join(blocks, "dim")
    sent = planned.withColumn("block", F.pmod("query", "blocks")).withColumn("pivot", F.explode("pivots"))
    sent = sent.join(F.broadcast(sizes.select("dim", "pivot", "parts")), ["dim", "pivot"])
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    sent = sent.select("dim", F.concat_ws("-", "pivot", "part").alias("shard"), "block", "query", "query_id", "v", "floor")
    laid = pages.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = ["dim", "shard", "block"]
    return laid.drop("blocks").groupBy(*cell).cogroup(sent.groupBy(*cell)).applyInPandas(_search(reach, k), _HITS)


def top_products(
    vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query row."""
    spark = vectors.sparkSession
    clean = vectors.select(F.col(key).cast("long").alias("vec_id"), quantise(F.col(vector)).alias("v"), is_query.alias("asks"))
    clean = clean.filter("vec_id is not null and v is not null").withColumn("dim", F.size("v"))
    most = F.array_max(F.transform("v", lambda x: F.abs(x)))
    part = F.when(most > 0, most).otherwise(F.lit(1.0))
    clean = materialize(
        clean.withColumns(
            {
                "draw": F.xxhash64("vec_id"),
                "square": F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x),
                "norm": part * F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + (x / part) * (x / part))),
            }
        ),
        "vectors",
    )
    # One row for each length, no more than the longest vector has components.
    longest = clean.groupBy("dim").agg(
        F.max("square").alias("square"),
        F.max("norm").alias("norm"),
        F.count(F.lit(1)).alias("rows"),
        F.min("draw").alias("least"),
    )
    longest = longest.orderBy("dim").collect()
    found = spark.createDataFrame([], _HITS)
    for first in range(0, len(longest), LENGTHS):
        these = longest[first : first + LENGTHS]
        reach = {r["dim"]: _reach(r["square"], r["norm"]) for r in these}
        limits = {r["dim"]: _draw_limit(r["rows"], r["least"]) for r in these}
        found = found.union(_top_of_lengths(spark, clean, reach, limits, k))
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("place"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
