import numpy as np
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from custodia.llm import vp_search


def table(spark, v, ids=None):
    ids = list(range(len(v))) if ids is None else ids
    return spark.createDataFrame([(i, None if x is None else [None if y is None else float(y) for y in x], 1, "x") for i, x in zip(ids, v)], "vec_id long, embedding array<float>, label int, cell string")


def brute(v, q, k):
    d = np.sqrt(np.square(v.astype(np.float32).astype(float) - v[q].astype(np.float32).astype(float)).sum(1))
    d[q] = np.inf
    return [int(i) for i in np.lexsort((np.arange(len(v)), d))[:k]]


@pytest.fixture(scope="module")
def points():
    r = np.random.default_rng(1)
    v = r.normal(size=(30, 8))[r.integers(0, 30, 900)] + 0.2 * r.normal(size=(900, 8))
    v[300:400] = v[300]  # copies
    return v


@pytest.mark.parametrize(("pivots", "shard", "queries"), [(1, 5000, 100), (40, 20, 3), (8, 100, 1000)])
def test_factor_one_is_exact(spark, points, pivots, shard, queries):
    got = vp_search.nearest(table(spark, points), F.col("vec_id") % 50 == 0, 10, 1.0, pivots, shard, queries).collect()
    for q in range(0, 900, 50):
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == brute(points, q, 10)


def test_relaxed_recall(spark, points):
    got = vp_search.nearest(table(spark, points), F.col("vec_id") % 10 == 0, 10, 1.5, 20, 50).collect()
    hit = sum(r.vec_id in brute(points, r.query_id, 10) for r in got)
    assert hit >= 0.9 * 900


def test_odd_vectors(spark):
    v = [[1, 0], [0, 0], None, [float("nan"), 1], [None, 1], [float("inf"), 1], [2, 0], [1, 2, 3], [1, 0], []]
    got = vp_search.nearest(table(spark, v, [0, 100, 200, 300, 400, 500, 1, 600, None, 700]), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0)]
    assert vp_search.nearest(table(spark, []), F.lit(True)).count() == 0


@pytest.mark.parametrize("pivots", [1, 3])
def test_distances_beyond_doubles_and_repeated_ids(spark, pivots):
    v = [[1e155, 0], [1e155, 1e155], [3e200, 0], [-3e200, 1], [1, 1], [2, 1]] + [[float(i), 3e160] for i in range(20)]
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = vp_search.nearest(df, F.col("vec_id") % 5 == 0, 10, 1.0, pivots, 4, 2).collect()
    a = np.array(v)
    with np.errstate(over="ignore"):
        for q in range(0, len(v), 5):
            d = np.sqrt(np.cumsum(np.square(a - a[q]), axis=1)[:, -1])
            d[q] = np.nan
            want = [(int(i), float(d[i])) for i in np.lexsort((np.arange(len(v)), d))[:10]]
            assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == want
    twice = table(spark, [[1, 0], [1, 0], [0, 1]], [0, 0, 1])
    assert [(r.rank, r.vec_id) for r in vp_search.nearest(twice, F.col("vec_id") == 1).sort("rank").collect()] == [(1, 0), (2, 0)]


class Most(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


def test_blocks_follow_the_queries_that_are_sent(spark):
    """Few queries of a cell's own, many of others': a block has about as many as it should."""
    v = np.random.default_rng(5).normal(size=(1500, 6))
    most = spark.sparkContext.accumulator(0, Most())
    got = vp_search.nearest(table(spark, v), F.col("vec_id") % 3 == 0, 10, 1.0, 12, 100, 10, observe=most.add).collect()
    assert len(got) == 5000 and 10 <= most.value <= 30  # blocks are dealt by a hash
    for q in range(0, 1500, 300):
        assert [x.vec_id for x in sorted((x for x in got if x.query_id == q), key=lambda x: x.rank)] == brute(v, q, 10)
