"""k-center: FFT rules, radius bounds, coreset sizes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ouzel.operators import kcenter
from ouzel.sources.points import points_from_embeddings, points_from_orders

SF = "/root/testdata/sf0.01"


def brute_radius(xy, centers):
    c = np.array([(x, y) for (_, _, x, y) in centers])
    d = np.sqrt(((xy[:, None, :] - c[None, :, :]) ** 2).sum(axis=2))
    return d.min(axis=1).max()


def test_fft_indices_rules():
    x = np.array([0.0, 1.0, 2.0, 3.0, 3.0])
    y = np.zeros(5)
    assert kcenter.fft_indices(x, y, 3) == [0, 3, 1]   # first max wins the tie
    assert kcenter.fft_indices(x[:2], y[:2], 5) == [0, 1]   # K > points
    assert kcenter.fft_indices(x[:0], y[:0], 3) == []


def test_two_rounds_and_radius(spark):
    pe = points_from_embeddings(spark, SF)
    coreset = kcenter.fft_coreset(pe, 5, "b")
    assert coreset.groupBy("b").count().where("count != 5").count() == 0
    centers = kcenter.collect_centers(kcenter.fft_centers(coreset, 5, coreset_rows=20))
    # fixed expectation for this table (smallest id first)
    assert [c[1] for c in centers] == [0, 392, 328, 356, 336]
    r = kcenter.radius(pe, centers).collect()[0].radius
    assert abs(r - 0.26689824243476234) < 1e-12
    xy = np.array([(row.x, row.y) for row in pe.collect()])
    assert abs(brute_radius(xy, centers) - r) < 1e-12


def test_radius_bounds(spark):
    pe = points_from_embeddings(spark, SF)
    prev = None
    for K in (2, 4, 6):
        it = kcenter.fft_iterative(pe, K)
        r_it = kcenter.radius(pe, it).collect()[0].radius
        if prev is not None:
            assert r_it <= prev + 1e-12
        prev = r_it
        centers, rad = kcenter.mr_fft(pe, K, 4)
        assert rad.collect()[0].radius <= 4 * r_it + 1e-12


@pytest.mark.parametrize("candidates", [1, 40, 1 << 14])
def test_iterative_same_centers_however_few_candidates_a_pass_sends(spark, candidates, monkeypatch):
    pe = points_from_embeddings(spark, SF)
    monkeypatch.setattr(kcenter, "CANDIDATES", candidates)
    a = kcenter.fft_iterative(pe, 12)
    xy = pe.orderBy("id").select("x", "y").toPandas().to_numpy()
    idx = kcenter.fft_indices(xy[:, 0], xy[:, 1], 12)
    ids = pe.orderBy("id").select("id").toPandas()["id"].to_numpy()
    assert [c[1] for c in a] == [int(ids[i]) for i in idx]


def test_ties_copies_and_more_centers_than_points(spark, monkeypatch):
    rows = [(i, float(i % 7), float(i % 3)) for i in range(60)]
    pts = spark.createDataFrame(rows, "id long, x double, y double").repartition(5, "id")
    x, y = (np.array([r[k] for r in rows]) for k in (1, 2))
    for candidates in (1, 30, 1000):
        monkeypatch.setattr(kcenter, "CANDIDATES", candidates)
        for K in (1, 5, 25, 100):
            assert [c[1] for c in kcenter.fft_iterative(pts, K)] == kcenter.fft_indices(x, y, K)
    assert kcenter.fft_iterative(pts.limit(0), 3) == []


def test_a_pass_decides_many_centers(spark):
    """100 centers of 15,000 points in far fewer passes than centers; a bounded number of points comes to the driver."""
    po = points_from_orders(spark, SF).select(F.lit(0).cast("long").alias("b"), "id", "x", "y", F.col("id").alias("pri"))
    centers, passes = kcenter.fft_passes(po, 100, candidates=1500)
    pts = po.select("id", "x", "y").toPandas().sort_values("id")
    want = kcenter.fft_indices(pts.x.to_numpy(), pts.y.to_numpy(), 100)
    assert [c[2] for c in centers] == pts.id.to_numpy()[want].tolist() and passes <= 40


def test_nearest_center(spark):
    pe = points_from_embeddings(spark, SF)
    centers = kcenter.fft_iterative(pe, 4)
    near = kcenter.nearest_center(pe, centers).toPandas().set_index("id")
    pts = pe.toPandas().set_index("id")
    c = np.array([(x, y) for (_, _, x, y) in centers])
    cid = np.array([i for (_, i, _, _) in centers])
    d = np.sqrt(((pts[["x", "y"]].to_numpy()[:, None, :] - c[None]) ** 2).sum(axis=2))
    assert (near.loc[pts.index, "center_id"].to_numpy() == cid[d.argmin(axis=1)]).all()
    dist = kcenter.nearest_center_distance(pe, centers).toPandas().set_index("id")
    assert np.allclose(dist.loc[pts.index, "d"].to_numpy(), d.min(axis=1), rtol=0, atol=1e-15)


@pytest.mark.parametrize("limit", [1, 12, 124, 10_000])
@pytest.mark.parametrize("seed", [None, 5])
def test_same_answer_with_any_group_limit(spark, limit, seed):
    """Buckets (125 rows each) and the union of coresets, in a worker or by rounds; also K above the limit."""
    pe = points_from_embeddings(spark, SF)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    whole = kcenter.fft_coreset(pe, 5, "b", seed)
    split = kcenter.fft_coreset(pe, 5, "b", seed, max_group_rows=limit)
    assert rows(whole) == rows(split)
    assert rows(kcenter.fft_centers(whole, 5, seed)) == rows(kcenter.fft_centers(whole, 5, seed, max_group_rows=limit))


def test_small_and_large_buckets_together(spark):
    pe = points_from_embeddings(spark, SF).withColumn("b", F.when(F.col("id") < 3, 0).otherwise(1))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(kcenter.fft_coreset(pe, 5, "b")) == rows(kcenter.fft_coreset(pe, 5, "b", max_group_rows=100))
    assert rows(kcenter.fft_coreset(pe, 5, "b")) == rows(kcenter.fft_coreset(pe, 5, "b", max_group_rows=2))


def test_plan_does_not_grow_with_k(spark):
    pe = points_from_embeddings(spark, SF)
    plan = lambda k: kcenter.radius(pe, [(i, i, 0.0, float(i)) for i in range(k)])._jdf.queryExecution().toString()
    assert len(plan(200)) <= len(plan(2)) + 50


def doubling_replay(rows, K):
    """The rule applied one point at a time."""
    t, kept = 0.0, []
    d = lambda a, b: float(np.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2))
    for p in rows:
        if not kept or min(d(p, c) for c in kept) > t:
            kept.append(p)
            while len(kept) > K:
                t = max(2 * t, min(d(a, b) for i, a in enumerate(kept) for b in kept[:i]))
                old, kept = kept, []
                for c in old:
                    if not kept or min(d(c, o) for o in kept) > t:
                        kept.append(c)
    return [c[0] for c in kept], 2 * t


@pytest.mark.parametrize("K", [1, 3, 10])
def test_doubling_equals_the_replay_and_keeps_its_promises(K):
    rng = np.random.default_rng(K)
    for n in (0, 1, 5, 400):
        xy = rng.normal(size=(n, 2)) * rng.choice([0.01, 1, 50], (n, 1))
        xy[n // 2:n // 2 + 3] = 0.5                                  # copies
        own = kcenter.Doubling(K)
        for at in range(0, n, 37):
            own.add(np.arange(at, min(n, at + 37)), xy[at:at + 37])
        ids, reach = doubling_replay([(i, *p) for i, p in enumerate(xy)], K)
        assert own.ids.tolist() == ids and own.reach == pytest.approx(reach)
        if n:
            far = np.sqrt(((xy[:, None] - own.xy[None]) ** 2).sum(-1)).min(1).max()
            best = kcenter.fft_indices(xy[:, 0], xy[:, 1], K + 1)     # K + 1 points apart bound any K centers from below
            apart = min((np.linalg.norm(xy[a] - xy[b]) for i, a in enumerate(best) for b in best[:i]), default=0.0)
            assert len(own.ids) <= K and far <= own.reach + 1e-12 <= 8 * max(apart / 2, 0) * 2 + 1e-9


def test_doubling_over_partitions(spark):
    """Whatever the partitions hold, the radius is within the factor of the traversal's."""
    pe = points_from_embeddings(spark, SF)
    best = kcenter.radius(pe, kcenter.fft_iterative(pe, 5)).first().radius
    for parts in (1, 3, 9):
        pts = pe.repartition(parts, "id")
        core = kcenter.doubling_coreset(pts, 5)
        assert core.groupBy("part").count().where("count > 5").count() == 0
        centers, rad = kcenter.doubling_fft(pts, 5)
        assert 1 <= len(centers) <= 5 and best / 2 <= rad.first().radius <= kcenter.DOUBLING_FACTOR * best
