"""Whitening against a plain version with exact sums; nulls, repeats, flat and empty tables."""

import numpy as np
import pytest

from kinweave.llm import whitening
from kinweave.llm.whitening import Moments, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n long, whitened string, x string"


def table(spark, vectors, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], v, 1, 5, "clash", "clash") for i, v in enumerate(vectors)], SCHEMA).repartition(7)


def plain(vectors):
    x = np.array([[int(np.floor(np.float64(np.float32(c)) * 1024)) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    deviation = [sum(int(v) ** 2 for v in n * row - s) for row in x]
    centred = ((n * x - s) / n).astype(float)
    values, vec = np.linalg.eigh(centred.T @ centred / n)
    values, vec = values[::-1], vec[:, ::-1]
    return n, deviation, values, centred @ vec / np.sqrt(np.maximum(values, 1e-300)), values / values.sum()


def check(got, vectors, ids, keep):
    n, deviation, _, w, share = plain(vectors)
    assert len(got) == len(vectors) * keep
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - share[r.component - 1]) < 1e-9
    for i, dev in zip(ids, deviation, strict=True):
        assert (i, dev) in by
    for c in range(1, keep + 1):
        mine = np.array([by[i, d][c][0].whitened for i, d in zip(ids, deviation, strict=True)])
        assert min(np.abs(mine - w[:, c - 1]).max(), np.abs(mine + w[:, c - 1]).max()) < 1e-6


def test_whitening_equals_the_plain_version(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(400, 12)) * np.arange(1, 13)[::-1] + 3).astype(np.float32).tolist()
    check(whiten(table(spark, vectors)).collect(), vectors, list(range(400)), 8)


def test_what_takes_no_part(spark):
    rng = np.random.default_rng(6)
    good = rng.normal(size=(50, 3)).astype(np.float32).tolist()
    bad = [None, [], [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("inf"), 0.0], [0.0, 0.0, float("-inf")]]
    got = whiten(table(spark, good + bad + good[:1], [*range(50), *range(50, 56), 0])).collect()
    check(got, good + good[:1], [*range(50), 0], 3)
    assert len(got) == 51 * 3


def test_null_ids_stay(spark):
    got = whiten(table(spark, [[1.0, 2.0], [3.0, -1.0], [0.0, 5.0]], [None, None, 1])).collect()
    assert sum(r.vec_id is None for r in got) == 4 and len(got) == 6


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]])
def test_nothing_to_whiten(spark, vectors):
    got = whiten(table(spark, vectors))
    assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_flat_dimensions_are_left_out(spark):
    vectors = [[float(i), 7.0, float(2 * i)] for i in range(9)]
    got = whiten(table(spark, vectors)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9 and got[0].identity_error < 1e-9


def test_lengths_and_sizes_are_checked(spark):
    with pytest.raises(Exception, match="vectors of"):
        whiten(table(spark, [[1.0, 2.0], [1.0]] * 9)).collect()
    with pytest.raises(Exception, match="beyond"):
        whiten(table(spark, [[1e30, 2.0], [1.0, 1.0]]))


def test_deviations_are_exact_or_refused():
    x = np.array([[1 << 38, -(1 << 38)], [0, 0]], np.int64)
    m = Moments.of(x)
    model = whitening.Whitening(m.n, m.sums, np.ones(1), np.ones((2, 1)), np.ones(1))
    with pytest.raises(ValueError, match="long"):
        whitening.distances(x, model)
    small = whitening.Whitening(2, np.array([3, 4], object), np.ones(1), np.ones((2, 1)), np.ones(1))
    assert whitening.distances(np.array([[1, 2], [2, 2]]), small)[1].tolist() == [1, 1]


def test_merging_in_any_order_is_the_same():
    rng = np.random.default_rng(7)
    x = (rng.integers(-50, 50, size=(300, 5)) + 10**9).astype(np.int64)
    whole = Moments.of(x)
    parts = [Moments.of(p) for p in np.array_split(x, 11)] + [Moments()]
    left = Moments()
    for p in parts:
        left = left.merge(p)
    tree = parts
    while len(tree) > 1:
        tree = [tree[i].merge(tree[i + 1]) if i + 1 < len(tree) else tree[i] for i in range(0, len(tree), 2)]
    for m in (left, tree[0]):
        assert m.n == 300 and (m.sums == whole.sums).all() and np.allclose(m.scatter, whole.scatter, rtol=1e-12, atol=1e-6)
