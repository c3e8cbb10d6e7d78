"""k-center clustering by farthest-first traversal (FFT).

Two distributed rounds plus a radius round:

1. ``fft_coreset``: FFT inside every bucket -> at most K points per bucket.
2. ``fft_centers``: FFT over the union of the coresets (at most K*L rows).
3. ``radius``: the largest distance from a point to its nearest center.

A bucket of at most ``max_group_rows`` points is traversed by one Python worker
(NumPy over the bucket's points); a larger one by passes of all tasks, each of which
sends a bounded number of the farthest points and so decides several centers at once
(``fft_passes``). Both choose the same centers, so the answer does not depend on the limit.

The passes over all points against the K centers (``nearest_center``, ``radius``, ...)
are Arrow batch passes: the centers travel with the function, and the plan is the
same for any K.

First center: the smallest id (default, repeatable) or a seeded draw.
Next center: the point farthest from the chosen ones, smallest id on ties.
Distances are ``sqrt(dx*dx + dy*dy)`` everywhere, so Spark, NumPy and SQL
agree to the last bit.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouzel.functions.geometry import dist
from ouzel.session import delete, shared_dir, written

# The functions below that run in Python workers, which need not have this
# package installed: ship this module's code with the functions
# (pickled by value) instead of a reference to the module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOUBLING_FACTOR = 10
CENTER_SCHEMA = "ord int, id long, x double, y double"
CORESET_SCHEMA = "b long, ord int, id long, x double, y double"
# Largest bucket one Python worker traverses (24 bytes per point in NumPy, a
# few times that in pandas).
MAX_GROUP_ROWS = 2_000_000
# Distances of a pass computed at a time (points x centers).
PASS_CELLS = 1 << 21
# Points that a pass of the traversal of large buckets sends to the driver, over all tasks and buckets.
CANDIDATES = 1 << 14
CANDIDATE_SCHEMA = "b long, id long, x double, y double, d double, last boolean"


def fft_indices(x: np.ndarray, y: np.ndarray, K: int, first: int = 0) -> list[int]:
    """Farthest-first traversal over arrays already sorted by id.

    Returns the positions of ``min(K, len(x))`` centers; ``np.argmax``
    returns the first (smallest id) of equal maxima.
    """
    n = len(x)
    k = min(K, n)
    if k == 0:
        return []
    chosen = [first]
    dx = x - x[first]
    dy = y - y[first]
    d = np.sqrt(dx * dx + dy * dy)
    for _ in range(1, k):
        c = int(np.argmax(d))
        chosen.append(c)
        dx = x - x[c]
        dy = y - y[c]
        d = np.minimum(d, np.sqrt(dx * dx + dy * dy))
    return chosen


def _priority(seed: int | None) -> Column:
    """The first center is the point with the smallest value of this, then the smallest id."""
    return F.col("id") if seed is None else F.xxhash64(F.lit(seed), "id")


def _fft_group(K: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        x, y, ids = (pdf[c].to_numpy() for c in ("x", "y", "id"))
        idx = fft_indices(x, y, K, int(np.argmin(pdf["pri"].to_numpy())))
        return pd.DataFrame({"b": pdf["b"].to_numpy()[idx], "ord": np.arange(len(idx), dtype=np.int32),
                             "id": ids[idx], "x": x[idx], "y": y[idx]})
    return run


def _farthest(centers: dict[int, np.ndarray], most: int):
    """For every bucket of a task its ``most`` points with the largest least distance to the bucket's ``centers``."""
    names = [f.split()[0] for f in CANDIDATE_SCHEMA.split(", ")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in it:
            b, ids, x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for k in np.unique(b).tolist():
                at, c = np.flatnonzero(b == k), centers[k]
                step = max(1, PASS_CELLS // len(c))
                d = np.concatenate([np.sqrt((np.square(x[part, None] - c[:, 0]) + np.square(y[part, None] - c[:, 1])).min(1))
                                    for i in range(0, len(at), step) for part in [at[i:i + step]]])
                rows = [d, ids[at], x[at], y[at]]
                held = best.get(k)
                if held is not None:
                    rows = [np.concatenate([h, r]) for h, r in zip(held[0], rows)]
                cut = len(rows[0]) > most
                if cut:
                    order = np.lexsort((rows[1], -rows[0]))[:most]
                    rows = [r[order] for r in rows]
                best[k] = rows, cut or (held is not None and held[1])
        for k, ((d, ids, x, y), cut) in best.items():
            last = np.zeros(len(d), bool)
            if cut:
                last[np.lexsort((ids, -d))[-1]] = True       # no point left out comes before it
            yield pa.record_batch([pa.array(np.full(len(d), k)), pa.array(ids), pa.array(x), pa.array(y), pa.array(d), pa.array(last)], names=names)
    return run


def _more_centers(rows: list, chosen: list[tuple], K: int) -> list[tuple]:
    """The next centers ``(b, ord, id, x, y)`` of a bucket, as far as its candidate ``rows`` decide them."""
    ids, x, y, d = (np.array([r[i] for r in rows]) for i in range(1, 5))
    order = np.argsort(ids, kind="stable")
    ids, x, y, d = ids[order], x[order], y[order], d[order]
    # what was left out comes after the first of the tasks' last points, by distance and then id
    left = min(((-r.d, r.id) for r in rows if r.last), default=None)
    new = []
    while len(chosen) + len(new) < K:
        k = int(np.argmax(d))
        if left is not None and (-d[k], ids[k]) > left:
            break
        new.append((chosen[0][0], len(chosen) + len(new), int(ids[k]), float(x[k]), float(y[k])))
        dx, dy = x - x[k], y - y[k]
        d = np.minimum(d, np.sqrt(dx * dx + dy * dy))
    return new


def fft_passes(points: DataFrame, K: int, candidates: int | None = None) -> tuple[list[tuple], int]:
    """Centers ``(b, ord, id, x, y)`` of buckets ``b, id, x, y, pri`` of any size, and the passes over the points.

    A pass sends the points farthest from the centers so far, at most about ``candidates`` over all tasks and
    buckets, and each task's last of them, beyond which nothing it left out can come. A new center can only
    lower distances, so the traversal goes on among the candidates as long as the next center is one
    that no point left out can precede; then the next pass is due. The centers travel with the pass and
    the distances are worked out anew, so nothing is stored between passes.
    """
    candidates = candidates or CANDIDATES
    spark = points.sparkSession
    folder = shared_dir(spark, "fft-points")
    pts = written(points.select(F.col("b").cast("long").alias("b"), F.col("id").cast("long").alias("id"),
                                F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "pri"), folder)
    first = F.min_by(F.struct("id", "x", "y"), F.struct("pri", "id"))
    buckets = pts.groupBy("b").agg(first.alias("c"), F.count(F.lit(1)).alias("n")).collect()
    chosen = {r.b: [(r.b, 0, r.c.id, r.c.x, r.c.y)] for r in buckets}
    wanted = {r.b: min(K, r.n) for r in buckets}
    open_, passes = [b for b in chosen if wanted[b] > 1], 0
    tasks = max(1, len(pts.inputFiles()))
    while open_:
        most = max(2, candidates // (tasks * len(open_)))
        centers = {b: np.array([c[3:] for c in chosen[b]]) for b in open_}
        own = pts.where(F.col("b").isin(open_)) if len(open_) < len(chosen) else pts
        found: dict[int, list] = {}
        for r in own.select("b", "id", "x", "y").mapInArrow(_farthest(centers, most), CANDIDATE_SCHEMA).collect():
            found.setdefault(r.b, []).append(r)
        passes += 1
        for b in list(open_):
            chosen[b] += _more_centers(found[b], chosen[b], wanted[b])    # one at least
            if len(chosen[b]) >= wanted[b]:
                open_.remove(b)
    delete(spark, folder)
    return [c for b in sorted(chosen) for c in chosen[b]], passes


def _fft_rounds(pts: DataFrame, K: int) -> DataFrame:
    """``CORESET_SCHEMA`` of buckets of any size."""
    return pts.sparkSession.createDataFrame(fft_passes(pts, K)[0], CORESET_SCHEMA)


def _fft_buckets(pts: DataFrame, K: int, max_group_rows: int, fits: bool) -> DataFrame:
    """``CORESET_SCHEMA`` for points ``b, id, x, y, pri``. ``fits``: no bucket is above the limit."""
    run = lambda df: df.groupBy("b").applyInPandas(_fft_group(K), CORESET_SCHEMA)
    if fits:
        return run(pts)
    # at most rows / max_group_rows buckets are above it
    large = [r.b for r in pts.groupBy("b").count().where(F.col("count") > max_group_rows).collect()]
    if not large:
        return run(pts)
    of_large = F.col("b").isin(large)
    return run(pts.where(~of_large)).unionByName(_fft_rounds(pts.where(of_large), K))


def fft_coreset(points: DataFrame, K: int, bucket: str | Column = "b",
                seed: int | None = None, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """K centers per bucket -> ``b, ord, id, x, y``."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    pts = points.select(b.cast("long").alias("b"), F.col("id").cast("long").alias("id"), "x", "y", _priority(seed).alias("pri"))
    return _fft_buckets(pts, K, max_group_rows, False)


def fft_centers(coreset: DataFrame, K: int, seed: int | None = None,
                coreset_rows: int | None = None, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """K centers from the coresets -> ``ord, id, x, y``.

    ``coreset_rows``: the known bound K*L; without it the coreset's rows are counted.
    """
    pts = coreset.select(F.lit(0).cast("long").alias("b"), "id", "x", "y", _priority(seed).alias("pri"))
    fits = coreset_rows is not None and coreset_rows <= max_group_rows
    return _fft_buckets(pts, K, max_group_rows, fits).select("ord", "id", "x", "y")


def collect_centers(centers: DataFrame) -> list[tuple[int, int, float, float]]:
    """Gather the K centers (K rows) as ``(ord, id, x, y)`` tuples in order."""
    rows = centers.select("ord", "id", "x", "y").orderBy("ord").collect()
    return [(int(r["ord"]), int(r["id"]), float(r["x"]), float(r["y"])) for r in rows]


def _pass(points: DataFrame, centers: Sequence[tuple], schema: str, result) -> DataFrame:
    """One Arrow pass over ``id, x, y``: ``result(id, squared distances (points, centers))`` gives the output columns."""
    if not centers:
        raise ValueError("no centers")
    cx, cy = (np.array([c[i] for c in centers], np.float64) for i in (2, 3))
    names = [f.split()[0] for f in schema.split(", ")]
    step = max(1, PASS_CELLS // len(centers))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                x, y = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                dx, dy = x[:, None] - cx, y[:, None] - cy
                cols = result(part.column(0), dx * dx + dy * dy)
                yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=names)

    return points.select("id", "x", "y").mapInArrow(run, schema)


def nearest_center_distance(points: DataFrame, centers: Sequence[tuple]) -> DataFrame:
    """Distance of every point to its closest center -> ``id, d``.

    ``sqrt(min d^2)`` equals ``min sqrt(d^2)`` exactly (sqrt is monotone and
    correctly rounded), and saves K-1 square roots per point.
    """
    return _pass(points, centers, "id long, d double", lambda i, d2: (i, np.sqrt(d2.min(1))))


def nearest_center(points: DataFrame, centers: Sequence[tuple]) -> DataFrame:
    """C4: every point against every center -> ``id, center_id, d``; the earlier center on ties."""
    ids = np.array([c[1] for c in centers], np.int64)

    def best(i, d2):
        d = np.sqrt(d2)
        k = d.argmin(1)
        return i, ids[k], d[np.arange(len(k)), k]

    return _pass(points, centers, "id long, center_id long, d double", best)


def pairwise_min(points: DataFrame, a: tuple, b: tuple) -> DataFrame:
    """Running minimum of the distances to two centers -> ``id, d``."""
    return points.select("id", F.least(dist("x", "y", F.lit(a[2]), F.lit(a[3])),
                                       dist("x", "y", F.lit(b[2]), F.lit(b[3]))).alias("d"))


def radius(points: DataFrame, centers: Sequence[tuple]) -> DataFrame:
    """Max over all points of the distance to the nearest center."""
    per_batch = _pass(points, centers, "id long, d double", lambda i, d2: (i[:1], np.sqrt(d2.min(1).max(keepdims=True))))
    return per_batch.agg(F.max("d").alias("radius"))


def mr_fft(points: DataFrame, K: int, L: int, bucket: str | Column = "b",
           seed: int | None = None) -> tuple[list[tuple], DataFrame]:
    """Rounds 1-3. Returns the centers and a one-row radius DataFrame."""
    coreset = fft_coreset(points, K, bucket, seed)
    if K * L > CANDIDATES:
        centers = collect_centers(fft_centers(coreset, K, seed, coreset_rows=K * L))
    else:                                                    # at most K * L rows
        rows = sorted(coreset.select("id", "x", "y", _priority(seed).alias("pri")).collect())
        first = min(range(len(rows)), key=lambda i: (rows[i].pri, rows[i].id), default=0)
        at = fft_indices(np.array([r.x for r in rows]), np.array([r.y for r in rows]), K, first)
        centers = [(k, rows[i].id, rows[i].x, rows[i].y) for k, i in enumerate(at)]
    return centers, radius(points, centers)


def fft_iterative(points: DataFrame, K: int, seed: int | None = None) -> list[tuple]:
    """F1e: farthest-first over the whole table, no coreset: the passes of one bucket."""
    pts = points.select(F.lit(0).cast("long").alias("b"), F.col("id").cast("long").alias("id"), "x", "y", _priority(seed).alias("pri"))
    return [c[1:] for c in fft_passes(pts, K)[0]]


class Doubling:
    """At most K of the points seen so far that cover all of them, in one pass and bounded memory (doubling algorithm).

    A point further than ``t`` from all centers becomes a center. With more than K, ``t`` becomes the larger of 2 t and the
    least distance of two centers, and centers within ``t`` of a kept one are dropped. K + 1 points further apart
    than t mean that any K centers leave some point t / 2 away, and what was covered within 2 t stays covered within
    2 t; so all points lie within ``reach`` = 2 t of the centers, at most 8 times the best radius of any K centers.
    """

    def __init__(self, K: int):
        self.K, self.t = K, 0.0
        self.ids, self.xy = np.zeros(0, np.int64), np.zeros((0, 2))

    @property
    def reach(self) -> float:
        return 2 * self.t

    def _distance(self, xy: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.sqrt(np.square(xy[:, None, 0] - to[None, :, 0]) + np.square(xy[:, None, 1] - to[None, :, 1]))

    def add(self, ids: np.ndarray, xy: np.ndarray) -> None:
        step = max(1, PASS_CELLS // (self.K + 1))
        for at in range(0, len(ids), step):
            self._add(ids[at:at + step], xy[at:at + step])

    def _add(self, ids: np.ndarray, xy: np.ndarray) -> None:
        d = self._distance(xy, self.xy).min(1) if len(self.ids) else np.full(len(ids), np.inf)
        at = 0
        while True:
            far = np.flatnonzero(d[at:] > self.t)
            if not len(far):
                return
            at += int(far[0])
            self.ids, self.xy = np.append(self.ids, ids[at]), np.concatenate([self.xy, xy[at:at + 1]])
            d = np.minimum(d, self._distance(xy, xy[at:at + 1])[:, 0])
            if len(self.ids) > self.K:
                self._merge()
                d = self._distance(xy, self.xy).min(1)
            at += 1

    def _merge(self) -> None:
        while len(self.ids) > self.K:
            apart = self._distance(self.xy, self.xy)
            self.t = max(2 * self.t, apart[np.triu_indices(len(self.ids), 1)].min())
            kept = []
            for i in range(len(self.ids)):
                if not kept or apart[i, kept].min() > self.t:
                    kept.append(i)
            self.ids, self.xy = self.ids[kept], self.xy[kept]


def doubling_coreset(points: DataFrame, K: int) -> DataFrame:
    """U2 / F1a in one pass: at most K centers of each task's points -> ``part, id, x, y, reach``.

    Points are neither shuffled nor held; which points a task sees is left to the source.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Doubling(K)
        for b in it:
            ids, x, y = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            own.add(ids, np.stack([x, y], axis=1))
        n, part = len(own.ids), TaskContext.get().partitionId()
        yield pa.record_batch([pa.array(np.full(n, part, np.int64)), pa.array(own.ids), pa.array(np.ascontiguousarray(own.xy[:, 0])),
                               pa.array(np.ascontiguousarray(own.xy[:, 1])), pa.array(np.full(n, own.reach))],
                              names=["part", "id", "x", "y", "reach"])

    return points.select(F.col("id").cast("long"), F.col("x").cast("double"), F.col("y").cast("double")).mapInArrow(
        run, "part long, id long, x double, y double, reach double")


def doubling_fft(points: DataFrame, K: int) -> tuple[list[tuple], DataFrame]:
    """F1c with the one-pass coreset: the centers and a one-row radius, at most ``DOUBLING_FACTOR`` times the best
    (8 from the pass, 2 from the traversal of what it keeps)."""
    folder = shared_dir(points.sparkSession, "doubling")
    coreset = written(doubling_coreset(points, K).select("id", "x", "y"), folder)      # K rows a task
    centers = collect_centers(fft_centers(coreset, K))
    delete(points.sparkSession, folder)
    return centers, radius(points, centers)


def centers_frame(spark, centers: Sequence[tuple]) -> DataFrame:
    """The K centers as a DataFrame ``ord, id, x, y``."""
    return spark.createDataFrame([tuple(c) for c in centers], CENTER_SCHEMA)
