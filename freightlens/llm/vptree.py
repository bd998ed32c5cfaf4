"""Nearest neighbours by vantage-point trees, one per shard of space.

Largest inner product is made a metric search by one more coordinate: with M
the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give
|q' - x'|^2 = |q'|^2 + M^2 - 2 q.x, so the nearest x' has the largest product.
A query's length does not change its order, so it is scaled to M.

A vantage-point tree over a bounded sample (``SAMPLE_ROWS`` rows, by hash) cuts
the space into regions of about ``shard_rows`` rows.  Every row goes down it to
its region; a region that holds more is dealt to several shards by id.  Each
region's centre, with the distances of its nearest and farthest row, is a shell.

A query first searches the region that it falls in.  The distance of its k-th
best there is its reach: it goes on to those regions only whose place in the tree
and whose shell the triangle inequality leaves within ``factor`` times the reach.
The same holds inside a shard, whose own tree starts from the reach: 1 is exact,
less prunes more.  The best of all shards are merged per query.

Queries of a region come in blocks of bounded size; a task holds one shard and one
block.  Equal vectors are one point with its k + 1 smallest ids (ties go to the
smaller id, so no other can be among the k nearest of anything), and equal queries
are searched once, so copies by the million cost no more than one vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import Scratch, union_all

SHARD_ROWS = 8192
QUERY_ROWS = 4096
# Rows that the regions are fitted on, and the fewest of them for a region.
SAMPLE_ROWS = 8192
REGION_SAMPLE = 8
LEAF = 64
# Share of the k-th distance within which a region or subtree is still visited.
FACTOR = 0.7
# Rounding allowed for when distances are compared, as a share of M.
ROUNDING = 1e-9

OUT = "query_id long, query_key long, vec_id long, score double"


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, ((a - b) ** 2).sum(-1)))


class Tree:
    """A vantage-point tree over the rows of ``points`` (in the lifted space)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 7):
        self.points, self.leaf, self.random = points, leaf, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, own: np.ndarray):
        if len(own) <= self.leaf:
            return own
        vantage = own[self.random.integers(len(own))]
        d = _distance(self.points[own], self.points[vantage])
        radius = np.median(d)
        inside = d <= radius
        if inside.all():  # many equal distances
            inside = d < radius
            if not inside.any():
                return own
            radius = d[inside].max()
        return vantage, radius, self._build(own[inside]), self._build(own[~inside])


class Search:
    """The ``k`` points of largest product for each of a block of queries of norm
    ``top``; ``floor`` is a product that each query has reached elsewhere.  Of equal
    products the point of the smaller number stays."""

    def __init__(self, tree: Tree, queries: np.ndarray, floor: np.ndarray, top: float, k: int, factor: float):
        self.tree, self.factor, self.k, self.top, self.floor = tree, factor, k, top, floor
        self.q = np.hstack([queries, np.zeros((len(queries), 1))])
        self.best = np.full((len(queries), k), -np.inf)
        self.which = np.full((len(queries), k), np.iinfo(np.int64).max)
        self._visit(tree.root, np.arange(len(queries)))

    def _reach(self, rows: np.ndarray) -> np.ndarray:
        """Distance within which a point still matters, relaxed."""
        return reach(np.maximum(self.best[rows, -1], self.floor[rows]), self.top, self.factor)

    def _visit(self, node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, np.ndarray):
            scores = np.hstack([self.best[rows], self.q[rows] @ self.tree.points[node].T])
            which = np.hstack([self.which[rows], np.broadcast_to(node, (len(rows), len(node)))])
            order = np.lexsort((which, -scores), axis=1)[:, :self.k]
            self.best[rows] = np.take_along_axis(scores, order, 1)
            self.which[rows] = np.take_along_axis(which, order, 1)
            return
        vantage, radius, inner, outer = node
        d = _distance(self.q[rows], self.tree.points[vantage])
        near = d <= radius
        for first, second, own, gap in ((inner, outer, near, radius - d), (outer, inner, ~near, d - radius)):
            mine, gap = rows[own], gap[own]
            self._visit(first, mine)
            self._visit(second, mine[gap <= self._reach(mine)])


def reach(product: np.ndarray, top: float, factor: float) -> np.ndarray:
    """Distance of a point with this product to a query of norm ``top``, relaxed."""
    return factor * np.sqrt(np.maximum(0, 2 * top * top - 2 * product)) + ROUNDING * top


@dataclass
class Regions:
    """The regions of the vectors of one length, numbered from ``first``."""

    tree: Tree
    top: float  # largest norm
    first: int
    centres: np.ndarray
    nearest: np.ndarray  # of a region's rows to its centre
    farthest: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, top: float, first: int, regions: int) -> Regions:
        points = lifted(sample, top)
        tree = Tree(points, max(REGION_SAMPLE, -(-len(points) // regions)))
        leaves = list(_leaves(tree.root))
        centres = np.array([points[x].mean(0) if len(x) else np.zeros(points.shape[1]) for x in leaves])
        return Regions(tree, top, first, centres, np.zeros(len(leaves)), np.full(len(leaves), np.inf))

    def __len__(self) -> int:
        return len(self.centres)

    def visited(self, points: np.ndarray, reaches: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a point's row and a region: the one it falls in, or with
        ``reaches`` all that the triangle inequality leaves within reach."""
        found: list[tuple[np.ndarray, int]] = []
        number = iter(range(len(self)))

        def visit(node, rows: np.ndarray) -> None:
            if isinstance(node, np.ndarray):
                found.append((rows, next(number)))
                return
            vantage, radius, inner, outer = node
            d = _distance(points[rows], self.tree.points[vantage])
            slack = reaches[rows] if reaches is not None else 0
            visit(inner, rows[d - radius <= slack])
            visit(outer, rows[d > radius] if reaches is None else rows[radius - d <= slack])

        visit(self.tree.root, np.arange(len(points)))
        rows = np.concatenate([r for r, _ in found])
        region = np.repeat([g for _, g in found], [len(r) for r, _ in found])
        if reaches is not None:
            d = _distance(points[rows], self.centres[region])
            keep = (d - self.farthest[region] <= reaches[rows]) & (self.nearest[region] - d <= reaches[rows])
            rows, region = rows[keep], region[keep]
        return rows, region


def _leaves(node) -> Iterator[np.ndarray]:
    if isinstance(node, np.ndarray):
        yield node
    else:
        yield from _leaves(node[2])
        yield from _leaves(node[3])


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(0, top * top - (x ** 2).sum(1)))[:, None]])


def scaled(q: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Queries of norm ``top`` and what they were multiplied by."""
    by = top / np.sqrt((q ** 2).sum(1))
    return q * by[:, None], by


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vector length, the rows that have it, and their vectors."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield int(dim), rows, _matrix(column.take(pa.array(rows)))


def usable(v: Column) -> Column:
    """Neither null nor zero, all components finite."""
    x = v.cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))


def _place(regions: dict[int, Regions]):
    """Region of a row, its distance from the centre, and the region where a query
    of the same vector starts."""

    @F.arrow_udf("region int, far double, home int")
    def place(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            region, far, home = np.zeros(len(column), dtype=np.int32), np.zeros(len(column)), np.zeros(len(column), dtype=np.int32)
            for dim, rows, x in _by_length(column):
                g = regions[dim]
                points, asked = lifted(x, g.top), np.hstack([scaled(x, g.top)[0], np.zeros((len(x), 1))])
                for of, out in ((points, region), (asked, home)):
                    at, where = g.visited(of)
                    out[rows[at]] = g.first + where
                far[rows] = _distance(points, g.centres[region[rows] - g.first])
            yield pa.StructArray.from_arrays([pa.array(region), pa.array(far), pa.array(home)], names=["region", "far", "home"])

    return place.asNondeterministic()


def _route(regions: dict[int, Regions], factor: float):
    """The regions other than the home that a query with this k-th best must visit."""

    @F.arrow_udf("array<int>")
    def route(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, home, kth in columns:
            own, best = home.to_numpy(zero_copy_only=False), kth.to_numpy(zero_copy_only=False).astype(np.float64)
            out: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * len(column)
            for dim, rows, x in _by_length(column):
                g = regions[dim]
                q, by = scaled(x, g.top)
                limit = np.where(np.isnan(best[rows]), np.inf, reach(np.nan_to_num(best[rows]) * by, g.top, factor))
                at, where = g.visited(np.hstack([q, np.zeros((len(q), 1))]), limit)
                order = np.argsort(at, kind="stable")
                cuts = np.searchsorted(at[order], np.arange(len(rows) + 1))
                for i, r in enumerate(rows):
                    found = g.first + where[order[cuts[i]:cuts[i + 1]]]
                    out[r] = found[found != own[r]].astype(np.int32)
            yield pa.array(out, pa.list_(pa.int32()))

    return route.asNondeterministic()


def _search(points: DataFrame, queries: DataFrame, tops: dict[int, float], shard_rows: int, query_rows: int, k: int, factor: float) -> DataFrame:
    """``OUT``: the best ``k`` of each shard for ``queries(query_id, query_key,
    embedding, floor, region)`` in the regions they name."""
    asked = queries.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("blocks"))
    held = points.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    sizes = held.join(asked, "region")  # a row per region
    spread = lambda of, n: F.pmod(F.xxhash64(*of), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    p = points.join(F.broadcast(sizes), "region").select(
        "vec_id", "embedding", "region", spread(["embedding", F.lit(1)], F.col("shards")).alias("shard"), every(F.col("blocks")).alias("block"))
    q = queries.join(F.broadcast(sizes), "region").select(
        "query_id", "query_key", "embedding", "floor", "region", every(F.col("shards")).alias("shard"),
        spread(["query_id", "query_key", F.lit(2)], F.col("blocks")).alias("block"))
    schema = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(mine: pa.Table, asked: pa.Table) -> pa.Table:
        if not mine.num_rows or not asked.num_rows:
            return schema.empty_table()
        ids, x = mine.column("vec_id").to_numpy(), _matrix(mine.column("embedding")) + 0.0  # no negative zero
        top = tops[x.shape[1]]
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        _, first, copy_of = np.unique(np.ascontiguousarray(x).view(f"V{8 * x.shape[1]}").ravel(), return_index=True, return_inverse=True)
        rank = np.argsort(first)  # points in the order of their smallest id
        distinct = x[first[rank]]
        copy_of = np.argsort(rank)[copy_of.ravel()]
        by_copy = np.argsort(copy_of, kind="stable")  # ids of equal vectors, ascending
        starts = np.concatenate(([0], np.cumsum(np.bincount(copy_of))))
        q_ids, keys, y = asked.column("query_id").to_numpy(), asked.column("query_key").to_numpy(), _matrix(asked.column("embedding"))
        q, by = scaled(y, top)
        floor = asked.column("floor").to_numpy().astype(np.float64)
        found = Search(Tree(lifted(distinct, top)), q, np.where(np.isnan(floor), -np.inf, floor * by), top, k, factor)
        rows = []
        for r in range(len(y)):
            which = found.which[r][np.isfinite(found.best[r])]
            score = (distinct[which] * y[r]).sum(1)  # the same order of additions for every row
            near = [(-s, i) for w, s in zip(which, score, strict=True) for i in ids[by_copy[starts[w]:starts[w + 1]]]]
            rows += [(q_ids[r], keys[r], i, -s) for s, i in sorted(near)[:k]]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema) if rows else schema.empty_table()

    cells = ("region", "shard", "block")
    return p.groupBy(*cells).cogroup(q.groupBy(*cells)).applyInArrow(search, OUT)


def nearest(vectors: DataFrame, is_query: Column, scratch: Scratch, k: int = 20, factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
            query_rows: int = QUERY_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors(vec_id,
    embedding)`` of largest inner product for each row where ``is_query``.

    Every other row of the same vector length is a candidate; fewer than ``k``
    give fewer results.  Scores are double precision on the given vectors, ties
    go to the smaller id.  Null, zero or non-finite vectors and null ids take no
    part.  Rows that repeat an id are one candidate for each different vector,
    and one query for each, with its own ranks; none is a candidate of its own id.
    An empty table gives no rows.
    """
    spark = vectors.sparkSession
    x = vectors.where("vec_id is not null").where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"), lambda c: c + F.lit(0.0)).alias("embedding"), is_query.alias("is_query"))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, c: a + c * c)
    sizes = x.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("top")).collect()  # a row per vector length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total, span = sum(s.n for s in sizes), 1 << 40
    drawn = F.pmod(F.xxhash64("vec_id", "embedding", F.lit(3)), F.lit(span)) < min(span, -(-sample_rows * span // total))
    sample: dict[int, list] = {}
    for r in x.where(drawn).select("embedding").limit(sample_rows).collect():
        sample.setdefault(len(r.embedding), []).append(r.embedding)
    regions, first = {}, 0
    for s in sorted(sizes, key=lambda s: s.dim):
        points = np.array(sample.get(s.dim, [[0.0] * s.dim]), dtype=np.float64)
        regions[s.dim] = Regions.fit(points, math.sqrt(s.top), first, max(1, -(-s.n // shard_rows)))
        first += len(regions[s.dim])
    tops = {dim: g.top for dim, g in regions.items()}

    placed = scratch.write(x.withColumn("at", _place(regions)(F.col("embedding"))).select("vec_id", "embedding", "is_query", "at.*"), "placed")
    shells = {r.region: r for r in placed.groupBy("region").agg(F.min("far").alias("near"), F.max("far").alias("far")).collect()}  # a row per region
    for g in regions.values():
        mine = [shells.get(g.first + i) for i in range(len(g))]
        g.nearest = np.array([s.near if s else np.inf for s in mine])  # an empty region is out of every reach
        g.farthest = np.array([s.far if s else -np.inf for s in mine])
    # A vector of more than k + 1 ids keeps the smallest; the window's limit is applied before the shuffle.
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    points = (placed.select("vec_id", "embedding", "region").withColumn("copy", F.dense_rank().over(copies))
              .where(F.col("copy") <= k + 1).select("vec_id", "embedding", "region").distinct())
    points = scratch.write(points, "points")
    key = F.xxhash64("embedding").alias("query_key")
    asked = (placed.where("is_query").groupBy("embedding").agg(F.min("vec_id").alias("query_id"), F.first("home").alias("home"))
             .select("query_id", key, "embedding", "home"))
    asked = scratch.write(asked, "asked")  # one query for each vector, named by its smallest id
    own = ("query_id", "query_key")
    best = Window.partitionBy(*own).orderBy(F.desc("score"), "vec_id")
    ranked = lambda df, n: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)

    none = F.lit(None).cast("double").alias("floor")
    home = _search(points, asked.select(*own, "embedding", none, F.col("home").alias("region")), tops, shard_rows, query_rows, k + 1, factor)
    home = scratch.write(ranked(home, k + 1), "home")
    kth = home.where(F.col("rank") == k + 1).select(*own, F.col("score").alias("floor"))
    routed = asked.join(kth, list(own), "left").withColumn("region", F.explode(_route(regions, factor)(F.col("embedding"), F.col("home"), F.col("floor"))))
    routed = scratch.write(routed.select(*own, "embedding", "floor", "region"), "routed")
    away = _search(points, routed, tops, shard_rows, query_rows, k + 1, factor)
    found = ranked(union_all([home.drop("rank"), away]), k + 1).drop("rank")
    members = (placed.where("is_query").select(F.col("vec_id").alias("member"), "embedding").distinct()
               .join(asked.select(*own, "embedding"), "embedding").select("member", *own))
    out = members.join(found, list(own)).where("member <> vec_id")
    return (out.withColumn("rank", F.row_number().over(Window.partitionBy("member", "query_key").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
            .select(F.col("member").alias("query_id"), "rank", "vec_id", "score"))
