"""Nearest neighbours with vantage-point trees, one for each shard.

Shards are the cells of a bounded set of pivots (each vector goes to its nearest pivot), and a cell with many
vectors is dealt over several shards. Each shard's tree prunes by the triangle inequality, and so does the
directory of cells, by the distance to a pivot and the cell's radius. Both bounds are multiplied by ``factor``:
one restores exact search, more prunes more.

Queries first search their own cell, which bounds their k-th distance, then every other cell that the
bound leaves. The queries that are sent to a cell are counted first and go in blocks of bounded size, and so does every shard, so a task
holds one tree and one block. What the driver holds is the directory: at most ``PIVOTS`` rows.

Defined results: vectors that are null, all zero, of another length than most vectors of the table, or hold null or
non-finite components take no part, neither as queries nor as candidates; a null vec_id takes no part; rows that
repeat a vec_id are separate candidates, except that a query never returns its own id; distances beyond the range of doubles are
infinite and come last; an empty table gives no rows. Ties go to the smaller vec_id. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Neighbours, factor, most pivots, vectors of a shard, queries of a block, and points of a leaf.
K, FACTOR, PIVOTS, SHARD, QUERIES, LEAF = 10, 1.0, 1024, 4096, 1024, 48


#: Stands for no neighbour; larger than any id but itself.
NONE = np.iinfo(np.int64).max


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows, components added in order."""
    return np.sqrt(np.cumsum(np.square(a[:, None, :] - b[None, :, :]), axis=2)[:, :, -1])


def _to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(v[i : i + 64], pivots) for i in range(0, len(v), 64)]) if len(v) else np.zeros((0, len(pivots)))


class Tree:
    """A vantage-point tree over the rows of ``points``; leaves hold up to LEAF of them."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.order = np.arange(len(ids))
        self.nodes: list[tuple] = []
        self.ids, self.points = ids, points
        self._build(0, len(ids))
        self.ids, self.points = ids[self.order], points[self.order]

    def _build(self, a: int, b: int) -> int:
        """Nodes: (from, to, vantage point or None, farthest of the inner half, nearest of the outer half, inner, outer)."""
        me = len(self.nodes)
        self.nodes.append((a, b, None, 0.0, 0.0, -1, -1))
        if b - a <= LEAF:
            return me
        part = self.order[a:b]
        centre = self.points[part[np.argmax(_distances(self.points[part[:1]], self.points[part])[0])]]  # an extreme point
        d = _distances(centre[None], self.points[part])[0]
        by = np.argsort(d, kind="stable")
        self.order[a:b] = part[by]
        mid = (b - a) // 2
        near, far = d[by[mid - 1]], d[by[mid]]
        if d[by[0]] == d[by[-1]]:  # equal distances cannot be split
            return me
        inner = self._build(a, a + mid)
        outer = self._build(a + mid, b)
        self.nodes[me] = (a, b, centre, near, far, inner, outer)
        return me

    def search(self, own: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int, factor: float):
        """(ids, distances), k of each query: the nearest that are closer than or at ``bound``; NONE where there are fewer."""
        self.k, self.factor = k, factor
        self.own, self.q, self.bound = own, queries, bound.copy()
        self.qq, self.pp = np.square(queries).sum(1), np.square(self.points).sum(1)
        self.best = np.full((len(own), k), np.inf)
        self.found = np.full((len(own), k), NONE)
        if len(self.ids):
            self._visit(0, np.arange(len(own)))
        return self.found, self.best

    def _leaf(self, a: int, b: int, who: np.ndarray) -> None:
        for i in range(0, len(who), 64):
            w = who[i : i + 64]
            # a product of matrices tells which pairs can be near enough, up to its rounding; only these are measured exactly
            scale = self.qq[w][:, None] + self.pp[a:b]
            rough = scale - 2 * (self.q[w] @ self.points[a:b].T)
            ids = np.broadcast_to(self.ids[a:b], rough.shape)
            # (a measure beyond the range of doubles rules nothing out)
            near = ~(rough > np.square(self.bound[w])[:, None] * (1 + 1e-9) + 1e-11 * scale) | ~np.isfinite(rough)
            near &= ids != self.own[w][:, None]
            some = near.any(1)
            if not some.any():
                continue
            w, ids, near = w[some], ids[some], near[some]
            x, y = np.nonzero(near)
            d = np.full(near.shape, np.inf)
            d[x, y] = np.sqrt(np.cumsum(np.square(self.q[w[x]] - self.points[a + y]), axis=1)[:, -1])
            near &= d <= self.bound[w][:, None]
            d, ids = np.where(near, d, np.inf), np.where(near, ids, NONE)
            d, ids = np.concatenate((self.best[w], d), 1), np.concatenate((self.found[w], ids), 1)
            first = np.lexsort((ids, d), axis=1)[:, : self.k]
            self.best[w], self.found[w] = np.take_along_axis(d, first, 1), np.take_along_axis(ids, first, 1)
            self.bound[w] = np.minimum(self.bound[w], self.best[w, -1])

    def _visit(self, node: int, who: np.ndarray) -> None:
        if not len(who):
            return
        a, b, centre, near, far, inner, outer = self.nodes[node]
        if centre is None:
            for i in range(a, b, 4 * LEAF):  # more than a leaf only where points are equally far
                self._leaf(i, min(b, i + 4 * LEAF), who)
            return
        d = _distances(self.q[who], centre[None])[:, 0]
        into = d - near < far - d
        self._visit(inner, who[into])
        self._visit(outer, who[~into])
        self._visit(outer, self._left(who[into], far - d[into]))
        self._visit(inner, self._left(who[~into], d[~into] - near))

    def _left(self, who: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Those whose neighbours can lie beyond the bound."""
        return who[~(least * self.factor > self.bound[who] * (1 + 1e-9) + 1e-12) | ~np.isfinite(least)]


FOUND = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR, pivots: int = PIVOTS, shard: int = SHARD, queries: int = QUERIES, vec_id: str = "vec_id", embedding: str = "embedding", observe: Callable[[int], None] | None = None) -> DataFrame:
    """query_id, rank, vec_id, score. ``is_query`` is a condition on vec_id; candidates are all rows but the query's own. Tasks tell
    ``observe`` how many queries each block has."""
    rows = usable(vectors, vec_id, embedding).withColumn("q", is_query)
    total = rows.count()
    n_pivots = max(1, min(pivots, total // shard))
    # a sample of bounded size, the same at every reading
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).select("v").collect()
    centres = np.array([r["v"] for r in chosen]) if chosen else np.zeros((1, 1))
    held = rows.sparkSession.sparkContext.broadcast(centres)  # PIVOTS rows at most

    def assign(batches):
        for batch in batches:
            d = _to_pivots(_matrix(batch.column("v")), held.value) if batch.num_rows else np.zeros((0, 1))
            cell = d.argmin(1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])], names=["vec_id", "v", "q", "cell", "d"])

    placed = rows.mapInArrow(assign, "vec_id long, v array<double>, q boolean, cell int, d double")
    directory = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("radius")).collect()
    radius, salts = np.full(n_pivots, -1.0), np.zeros(n_pivots, int)
    for r in directory:
        radius[r.cell], salts[r.cell] = r.radius, -(-r.n // shard)
    of = lambda values: F.array(*(F.lit(int(x)) for x in values))[F.col("cell")]

    def build(key, group):
        import pickle

        tree = Tree(group["vec_id"].to_numpy(), _matrix(group["v"]))
        return pa.table({"cell": [key[0].as_py()], "salt": [key[1].as_py()], "tree": [pickle.dumps(tree)]}, schema=pa.schema([("cell", pa.int32()), ("salt", pa.int32()), ("tree", pa.binary())]))

    index = placed.withColumn("salt", F.pmod(F.xxhash64("vec_id"), of(salts)).cast("int")).groupBy("cell", "salt").applyInArrow(build, "cell int, salt int, tree binary")
    index = materialise(index, "trees")

    def search(key, trees, asked):
        import pickle

        if not len(trees) or not len(asked):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own = asked["vec_id"].to_numpy()
        if observe:
            observe(len(own))
        ids, d = pickle.loads(trees["tree"][0].as_py()).search(own, _matrix(asked["v"]), asked["bound"].to_numpy(), k, factor)
        real = ids != NONE
        return pa.table({"query_id": np.repeat(own, k)[real.ravel()], "vec_id": ids[real], "score": d[real]})

    def run(asked: DataFrame, sent: DataFrame) -> DataFrame:
        """asked: vec_id, v, cell, bound; sent: cell, n, how many of them. Queries meet every shard of the cell, in blocks."""
        blocks = np.ones(n_pivots, int)
        for r in sent.collect():  # a row for each cell
            blocks[r["cell"]] = -(-r["n"] // queries)
        each = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), of(blocks)).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), of(salts) - 1)))
        trees = index.withColumn("block", F.explode(F.sequence(F.lit(0), of(blocks) - 1)))
        keys = ["cell", "salt", "block"]
        return trees.groupBy(*keys).cogroup(each.groupBy(*keys)).applyInArrow(search, FOUND)

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    top = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    home = placed.where("q").select("vec_id", "v", "cell", F.lit(float("inf")).alias("bound"))
    first = materialise(top(run(home, home.groupBy("cell").agg(F.count("*").alias("n")))), "first")
    bound = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).otherwise(float("inf")).alias("bound"))

    def others(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Every other cell that can hold a neighbour of a query."""
        v, tau = _matrix(batch.column("v")), batch.column("bound").to_numpy()
        least = _to_pivots(v, held.value) - radius
        open_ = (~(least * factor > (tau * (1 + 1e-9) + 1e-12)[:, None]) | ~np.isfinite(least)) & ~(radius < 0)
        open_[np.arange(len(v)), batch.column("cell").to_numpy()] = False
        return np.nonzero(open_)

    def spread(batches):
        for batch in batches:
            who, cell = others(batch) if batch.num_rows else ((), ())
            for i in range(0, len(who), 4096):
                part = batch.take(pa.array(who[i : i + 4096]))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), pa.array(cell[i : i + 4096], pa.int32()), part.column("bound")], names=["vec_id", "v", "cell", "bound"])

    def counts(batches):
        n = np.zeros(n_pivots, np.int64)
        for batch in batches:
            n += np.bincount(others(batch)[1], minlength=n_pivots) if batch.num_rows else 0
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], names=["cell", "n"])

    asked = placed.where("q").join(bound, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "v", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    sent = asked.mapInArrow(counts, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rest = run(asked.mapInArrow(spread, "vec_id long, v array<double>, cell int, bound double"), sent)
    return top(first.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")
