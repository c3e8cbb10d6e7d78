"""Exact distance-based outliers.

The ball count of a point is the number of points (itself included) at
distance strictly below D; a point is an outlier when its ball count is at
most M. Duplicate points are separate points.

Everything works on *locations*: distinct ``(x, y)`` with a multiplicity
``w``. A group of copies, however large, is one probe and one partner row,
never ``w * w`` pairs.

Grids. Cells have side ``s = D/(2*sqrt 2)`` (diagonal D/2, the grid of the
approximate method); blocks are 3x3 cells, side ``3s > D``, so the ball of a
point lies inside the 3x3 blocks around its own block. A probe is exploded
to those 9 blocks (9 rows, not the 49 of a cell stencil) and equi-joined on
the block key with the block's cells:

* an *open* cell (at most ``OPEN_CELL_ROWS`` locations) lists its
  locations, tested one by one with ``dist < D``;
* a *closed* cell (a dense one) is one row with its count: if its whole box
  lies within D of the probe it adds the count, if it lies beyond D it adds
  nothing, and if the circle cuts it, its SUB x SUB sub-cells are tested in the
  same way on the next level, down to open ones.

So a key carries at most ``9 * OPEN_CELL_ROWS`` partner rows on the first level and
``SUB * SUB * OPEN_CELL_ROWS`` below, however the points are distributed, and two
dense spots one D apart meet only along the circles; a hot block only makes the
probe side of a key large, which AQE's skew join splits. In outlier mode, probes in
cells with more than M points are dropped up front (a cell's diagonal is D/2, so
each of its points has all the others in its ball), and after every level the probes
whose count already exceeds M. Each level is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouzel.functions.geometry import (cell_index, cell_side, dist, max_sq_dist_to_box,
                                      min_sq_dist_to_box, offsets)
from ouzel.session import shared_dir, written

# Locations a cell may hold and still be matched one by one.
OPEN_CELL_ROWS = 64
# Sub-cells per cell side, and levels: below the last one cells are no wider than the
# rounding of their bounds, and all are open.
SUB, LEVELS = 4, 20


def locations(points: DataFrame) -> DataFrame:
    """Distinct coordinates with their multiplicity ``w`` (map-side combined)."""
    return points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))


def _block(c: str) -> Column:
    return F.floor(F.col(c) / F.lit(3))


def _box_tests(side: float, D: float, ci: str, cj: str) -> tuple[Column, Column]:
    """``inside`` / ``beyond`` tests of the padded box of cell (ci, cj) of ``side``.

    Boxes are padded by far more than the rounding of ``i * side``, so
    "inside" and "beyond" are never decided wrongly; close calls go to the
    point-by-point test, which uses the same distance expression as the
    oracle.
    """
    s = F.lit(side)
    i, j = F.col(ci), F.col(cj)
    pad_i = F.lit(side * 1e-9) + (F.abs(i) + 1) * F.lit(side * 1e-12)
    pad_j = F.lit(side * 1e-9) + (F.abs(j) + 1) * F.lit(side * 1e-12)
    x0, x1 = i * s - pad_i, (i + 1) * s + pad_i
    y0, y1 = j * s - pad_j, (j + 1) * s + pad_j
    px, py = F.col("px"), F.col("py")
    d2 = F.lit(D * D)
    return (max_sq_dist_to_box(px, py, x0, x1, y0, y1) < d2,
            min_sq_dist_to_box(px, py, x0, x1, y0, y1) > d2)


def _block_neighbours(probes: DataFrame) -> DataFrame:
    """``px, py`` with every block ``(ki, kj)`` of the 3x3 around its own."""
    return (probes
            .select("px", "py", "pgi", "pgj", F.explode(offsets(1)).alias("di"))
            .select("px", "py", "pgj", (F.col("pgi") + F.col("di")).alias("ki"),
                    F.explode(offsets(1)).alias("dj"))
            .select("px", "py", "ki", (F.col("pgj") + F.col("dj")).alias("kj")))


def _ball_counts(points: DataFrame, D: float, M: int | None = None,
                 open_rows: int = OPEN_CELL_ROWS) -> DataFrame:
    """Ball count of every location -> ``px, py, ball``.

    With ``M`` (outlier mode) only locations that may be outliers are
    probed, and the result holds exactly those with ``ball <= M``.
    """
    spark, side = points.sparkSession, cell_side(D)
    kept = lambda df, name: written(df, shared_dir(spark, f"balls-{name}"))
    here = (locations(points).withColumn("i", cell_index("x", side)).withColumn("j", cell_index("y", side))
            .withColumn("ki", _block("i")).withColumn("kj", _block("j")))
    here = kept(here.select("ki", "kj", "i", "j", "x", "y", "w"), "locations")

    probes = here
    if M is not None:
        full = here.groupBy("i", "j").agg(F.sum("w").alias("n")).where(F.col("n") > M).select("i", "j")
        probes = here.join(full, ["i", "j"], "left_anti")
    pairs = _block_neighbours(probes.select(F.col("x").alias("px"), F.col("y").alias("py"),
                                            F.col("ki").alias("pgi"), F.col("kj").alias("pgj")))
    found = None
    for level in range(LEVELS):
        cells = here.groupBy("ki", "kj", "i", "j").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("m"))
        closed = cells.where(F.col("m") > open_rows).select("ki", "kj", "i", "j", "n")
        last = level == LEVELS - 1 or closed.isEmpty()
        listed = here if last else here.join(closed, ["ki", "kj", "i", "j"], "left_anti")
        hits = (pairs.join(listed.select("ki", "kj", "x", "y", "w"), ["ki", "kj"])
                .where(dist("px", "py", "x", "y") < F.lit(D)).select("px", "py", F.col("w").alias("c")))
        if last:
            found = hits if found is None else found.unionByName(hits)
            break
        inside, beyond = _box_tests(side, D, "i", "j")
        tested = kept(pairs.join(closed, ["ki", "kj"])
                      .select("px", "py", "i", "j", "n", inside.alias("inside"), beyond.alias("beyond"))
                      .where(~F.col("beyond")), "tested")
        sure = tested.where("inside").select("px", "py", F.col("n").alias("c")).unionByName(hits)
        found = sure if found is None else found.unionByName(sure)
        found = kept(found.groupBy("px", "py").agg(F.sum("c").alias("c")), "found")
        pairs = tested.where("not inside").select("px", "py", F.col("i").alias("ki"), F.col("j").alias("kj"))
        if M is not None:
            pairs = pairs.join(found.where(F.col("c") > M).select("px", "py"), ["px", "py"], "left_anti")
        pairs = kept(pairs, "pairs")
        side /= SUB
        dense = here.join(closed, ["ki", "kj", "i", "j"], "left_semi")
        here = kept(dense.select(F.col("i").alias("ki"), F.col("j").alias("kj"), cell_index("x", side).alias("i"),
                                 cell_index("y", side).alias("j"), "x", "y", "w"), "locations")
    balls = found.groupBy("px", "py").agg(F.sum("c").alias("ball"))
    return balls if M is None else balls.where(F.col("ball") <= M)


def _back_to_points(points: DataFrame, balls: DataFrame) -> DataFrame:
    """Attach ``ball`` of each location to its points -> ``id, x, y, ball``."""
    b = balls.select(F.col("px").alias("x"), F.col("py").alias("y"), "ball")
    return points.select("id", "x", "y").join(b, ["x", "y"])


def ball_counts(points: DataFrame, D: float, open_rows: int = OPEN_CELL_ROWS) -> DataFrame:
    """The ball count of every point -> ``id, x, y, ball``."""
    return _back_to_points(points, _ball_counts(points, D, open_rows=open_rows))


def exact_outliers_grid(points: DataFrame, D: float, M: int,
                        open_rows: int = OPEN_CELL_ROWS) -> DataFrame:
    """Outliers with their ball counts -> ``id, x, y, ball``.

    Grid-pruned: cells with more than M points, and probes whose sure count
    from whole cells and sub-cells exceeds M, never reach the pair test.
    """
    return _back_to_points(points, _ball_counts(points, D, M, open_rows))


def exact_outliers_band(points: DataFrame, D: float, M: int,
                        open_rows: int = OPEN_CELL_ROWS) -> DataFrame:
    """The theta self-join ``dist(a, b) < D`` -> ``id, x, y, ball`` of the outliers.

    The join condition is evaluated over the block band (equi-join on the
    3x3 neighbour blocks plus the distance filter), for the points that may have
    a ball of at most M.
    """
    return _back_to_points(points, _ball_counts(points, D, M, open_rows))


def exact_outliers_topk(outliers: DataFrame, K: int) -> DataFrame:
    """The first K outliers by ball count, ties by id."""
    return outliers.orderBy("ball", "id").limit(K)
