"""Whitening against dense linear algebra and exact whole numbers."""

import numpy as np
import pytest
from pyspark.sql import types as T

from rowcast.llm import queries, whitening

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("component", T.StringType()), T.StructField("v", T.IntegerType()),
])


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(parts)


def clustered(n, width, seed):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((width, width)) * np.geomspace(3, 0.02, width)
    return rng.standard_normal((n, width)) @ mix + rng.standard_normal(width)


def assert_whitened(got, rows, components):
    """All rows there, with every column as dense algebra has it."""
    good = [(i, v) for i, v in rows if v is not None and all(e is not None and np.isfinite(e) for e in v)]
    x = np.floor(64.0 * np.array([v for _, v in good])).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    spread = n * x - sums
    centred = spread / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > 1e-12 * values[0]).sum()))
    want = centred @ vectors[:, :keep] / np.sqrt(values[:keep])
    assert len(got) == n * keep
    assert {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert set(by) == {i for i, _ in good}
    table = np.array([[by[i][k + 1][0].whitened for k in range(keep)] for i, _ in good])
    for k in range(keep):
        sign = np.sign(table[:, k] @ want[:, k])
        np.testing.assert_allclose(table[:, k] * sign, want[:, k], atol=1e-7)
    for (i, _), exact in zip(good, spread.astype(object)):
        assert by[i][1][0].deviation == sum(int(t) ** 2 for t in exact)
    for k in range(keep):
        assert by[good[0][0]][k + 1][0].explained == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


@pytest.mark.parametrize("n,width,components", [(400, 12, 8), (300, 40, 32), (50, 5, 32)])
def test_equals_dense_algebra(spark, n, width, components):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(n, width, n))]
    bad = [(n, None), (n + 1, [None] * width), (n + 2, [float("nan")] + [0.0] * (width - 1)),
           (n + 3, [0.0] * (width - 1) + [float("-inf")])]
    got = whitening.whiten(frame(spark, rows + bad), components=components)
    assert_whitened(got.collect(), rows + bad, components)


def test_repeated_rows_and_null_ids_count(spark):
    rows = [(i % 7 or None, v.tolist()) for i, v in enumerate(clustered(60, 4, 1))]
    got = whitening.whiten(frame(spark, rows + rows[:3]), components=2).collect()
    assert len(got) == 63 * 2 and {r.n for r in got} == {63}
    assert sum(r.vec_id is None for r in got) == 2 * sum(i is None for i, _ in rows + rows[:3])


def test_rank_below_the_components(spark):
    """A constant dimension, a repeated one, and fewer rows than dimensions."""
    rows = [(i, [v[0], v[1], v[0], 0.25]) for i, v in enumerate(clustered(40, 2, 2).tolist())]
    assert_whitened(whitening.whiten(frame(spark, rows)).collect(), rows, 32)
    few = [(i, v.tolist()) for i, v in enumerate(clustered(4, 9, 3))]
    assert {r.component for r in whitening.whiten(frame(spark, few)).collect()} == {1, 2, 3}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 0.25])] * 3, [(1, [])]):
        got = whitening.whiten(frame(spark, rows))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_lengths_and_too_large_numbers_raise(spark):
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e30]), (2, [2.0])])).collect()
    far = whitening.Whitening(10**9, np.array([0]), np.zeros(0), np.zeros((1, 0)), 0.0)
    with pytest.raises(OverflowError):
        far.deviation(far.spread(np.array([[10**4]])))


def test_values_keep_their_relative_accuracy():
    """A graded bidiagonal matrix, whose product is known entry by entry."""
    diagonal, above = np.geomspace(1, 1e-12, 13), np.full(12, 1e-3) * np.geomspace(1, 1e-12, 12)
    got = whitening.squared_singular_values(diagonal, above)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.prod(np.sqrt(got)) == pytest.approx(np.prod(diagonal), rel=1e-12)
    np.testing.assert_allclose(np.sqrt(got[:4]), np.linalg.svd(b)[1][:4], rtol=1e-12)


@pytest.mark.parametrize("above", [np.zeros(9), np.full(9, 1e-9), np.full(9, 0.5)])
def test_equal_values_get_orthonormal_directions(above):
    diagonal = np.ones(10)
    values = whitening.squared_singular_values(diagonal, above)
    v = whitening.right_vectors(diagonal, above, values, 10)
    b = np.diag(diagonal) + np.diag(above, 1)
    np.testing.assert_allclose(v.T @ v, np.eye(10), atol=1e-9)
    np.testing.assert_allclose(b.T @ b @ v, v * values, atol=1e-9)


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert_whitened(queries.queries()["op13_embedding_whitening"](spark, sf).collect(), rows, 32)
