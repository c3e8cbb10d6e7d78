"""Metric partition: exact counts in any number of columns, and what it rules out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ouzel.operators import metric


def frame(spark, x):
    rows = [(i, None if v is None else [float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(5, "id")


def brute(x, D):
    return (np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)) < D).sum(1)


@pytest.fixture(scope="module")
def clustered():
    """Dense and thin clusters in 8 columns, copies, and points far from all others."""
    rng = np.random.default_rng(3)
    centers = rng.uniform(-50, 50, (25, 8))
    parts = [c + rng.normal(0, s, (n, 8)) for c, s, n in zip(centers, [.1, .5, 2, 5] * 7, [90, 60, 40, 20] * 7)]
    return np.concatenate([*parts, np.repeat(centers[:2], 150, axis=0), rng.uniform(-200, 200, (30, 8))])


@pytest.mark.parametrize("how", [{}, {"leaf": 60, "share": 20}, {"leaf": 8, "share": 4}, {"leaf": 8, "share": 200, "depth": 1}])
def test_counts_equal_the_plain_join(spark, clustered, how):
    """One cell, one split, several splits, and cells that stay large."""
    D = 1.3
    got = {r.id: r.ball for r in metric.ball_counts(frame(spark, clustered), D, **how).collect()}
    want = brute(clustered, D)
    assert got == dict(enumerate(want.tolist()))
    assert 30 <= (want <= 3).sum() < len(want) / 2


def test_what_is_replicated_and_compared(spark, clustered):
    """Each point is its own cell's once; guests and pairs stay far below those of the plain join."""
    points = metric.distinct_points(frame(spark, clustered))
    n = points.count()
    sizes = metric.cell_sizes(metric.partition(points, 1.3, leaf=60, share=20)).collect()
    assert sum(r.owned for r in sizes) == n and max(r.owned for r in sizes) <= 60
    assert sum(r.guests for r in sizes) < 3 * n
    assert sum(r.owned * (r.owned + r.guests) for r in sizes) < 0.15 * n * n


def test_copies_nulls_and_odd_numbers(spark):
    x = [[0.0, 1.0]] * 500 + [[-0.0, 1.0], None, [float("nan"), 1.0], [float("inf"), 0.0], [], [0.0, 1.5], [9.0, 9.0], [0.0, 2.0]]
    got = {r.id: r.ball for r in metric.ball_counts(frame(spark, x), 1.0, leaf=2, share=1).collect()}
    assert got == {**dict.fromkeys(range(501), 502), 505: 503, 506: 1, 507: 2}
    rows = metric.exact_outliers(frame(spark, x), 1.0, 2).collect()
    assert sorted(r.id for r in rows) == [506, 507]
    assert metric.ball_counts(frame(spark, x).limit(0), 1.0).count() == 0
    with pytest.raises(ValueError):
        metric.ball_counts(frame(spark, x), 0.0)


def test_pairs_at_the_bound_are_told_exactly():
    a = np.array([[0.0, 0.0], [1e8, 0.0]])
    b = np.array([[3.0, 4.0], [3.0 - 1e-12, 4.0], [1e8, 5.0], [1e8, 4.999999]])
    assert metric.within(a, b, np.array([1, 10, 100, 1000]), 5.0).tolist() == [10, 1000]


def test_random_directions_in_many_columns(spark):
    """No pair can be ruled out there; the counts are the same."""
    x = np.random.default_rng(4).normal(size=(300, 40))
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = {r.id: r.ball for r in metric.ball_counts(frame(spark, x), 1.2, leaf=40, share=20).collect()}
    assert got == dict(enumerate(brute(x, 1.2).tolist()))


def test_distance_to_the_first(spark, clustered):
    got = {r.id: r.d for r in metric.point_distance(frame(spark, clustered)).collect()}
    want = np.sqrt(((clustered - clustered[0]) ** 2).sum(1))
    assert len(got) == len(want) and max(abs(got[i] - w) for i, w in enumerate(want)) < 1e-9


def directions(n, columns, seed):
    x = np.random.default_rng(seed).normal(size=(n, columns))
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_no_guests_where_no_pair_can_be_ruled_out(spark):
    """A split that saves nothing is not made: the points stay one cell, whose blocks are compared in pairs."""
    x = directions(900, 40, 5)
    sizes = metric.cell_sizes(metric.partition(metric.distinct_points(frame(spark, x)), 1.2, leaf=40, share=15)).collect()
    assert sum(r.owned for r in sizes) == 900
    assert sum(r.guests for r in sizes) <= metric.COPIES * 900


@pytest.mark.parametrize("how", [{"leaf": 40, "share": 10}, {"leaf": 40, "share": 200, "depth": 1}])
def test_stored_blocks_of_large_cells(spark, clustered, how):
    """Cells of over 50 own points in files of 40 points and more: one cell without guests, and cells with guests."""
    for x, D in ((directions(500, 40, 6), 1.2), (clustered, 1.3)):
        got = {r.id: r.ball for r in metric.ball_counts(frame(spark, x), D, **how, most=50, numbers=40 * x.shape[1]).collect()}
        assert got == dict(enumerate(brute(x, D).tolist()))


def test_pairs_in_both_directions():
    """Single and double precision, tiles with few and with most pairs near, sides longer than a tile."""
    rng = np.random.default_rng(7)
    for scale, shift, D in ((1.0, 0.0, 1.3), (0.1, 0.0, 1.3), (1.0, 1e6, 1.3), (1.0, 1e12, 1.3), (1e-20, 0.0, 1.3e-20), (1e25, 0.0, 1.3e25)):
        a, b = (directions(n, 30, n) * scale + shift for n in (700, 2300))
        wa, wb = rng.integers(1, 9, 700), rng.integers(1, 9, 2300)
        near = np.sqrt(np.square(a[:, None, :] - b[None, :, :]).sum(-1)) < D
        out, other = metric.within(a, b, wb, D, wa)
        assert out.tolist() == (near @ wb).tolist() and other.tolist() == (wa @ near).tolist()
        assert metric.within(a, b, wb, D).tolist() == out.tolist()


def test_few_points_are_left_to_be_outliers(spark, clustered):
    """Points with enough of the drawn ones near them are no guests; what is left is counted in full."""
    D = 1.3
    want = brute(clustered, D)
    points = metric.distinct_points(frame(spark, clustered))
    asked = {r.id for r in metric.may_be_outliers(points, D, 3, probed=400).where("asked").collect()}
    assert set(np.flatnonzero(want <= 3).tolist()) <= asked and len(asked) < points.count() / 2
    large = {"leaf": 40, "share": 200, "depth": 1, "most": 50, "numbers": 320}
    for how in ({"probed": 400, "leaf": 60, "share": 20}, {"probed": 400, **large}, {"probed": 0, **large}, {"probed": 10 ** 6}):
        rows = metric.exact_outliers(frame(spark, clustered), D, 3, **how).collect()
        assert {r.id: r.ball for r in rows} == {i: n for i, n in enumerate(want.tolist()) if n <= 3}


def test_outliers_among_repeated_and_null_ids(spark):
    """The points of an id are told together, as their counts are; points without an id are none."""
    rows = [(1, [0.0]), (1, [50.0]), (2, [0.1]), (3, [0.2]), (4, [90.0]), (None, [70.0]), (None, [0.3])]
    x = spark.createDataFrame(rows, "id long, v array<double>")
    balls = {(r.id, r.v[0]): r.ball for r in metric.ball_counts(x, 1.0).collect()}
    for probed in (0, 100):
        got = {(r.id, r.v[0]): r.ball for r in metric.exact_outliers(x, 1.0, 2, probed=probed).collect()}
        assert got == {k: n for k, n in balls.items() if n <= 2} == {(4, 90.0): 1}
