"""Grid approximation of distance-based outliers.

Cells have side ``D/(2*sqrt(2))`` (diagonal D/2). For an occupied cell,
``N3`` is the number of points in its 3x3 block and ``N7`` in its 7x7 block;
every point of the cell has a ball count between N3 and N7, so

* ``N3 > M``  -> non-outlier (sure)
* ``N7 <= M`` -> outlier (sure)
* otherwise   -> uncertain.

Cells of a 7x7 block with no points are class ``empty``.

Plan shape: the only point-level step is ``cell_counts`` (hash aggregate with
map-side combine, so a cell holding a third of all points costs one row per
task). Everything after works on cells: ``merge_counts`` is one explode to
the 49 stencil keys and one aggregate (at most 49 rows per key, so no key
can be skewed); it lists every stencil cell, as the per-cell outputs need.
``class_summary`` and the classes of occupied cells work on tiles of 16x16 cells:
at most 4 rows per occupied cell, at most 22x22 cells per tile, box sums by Arrow
batches. The per-square tables of ``square_counts`` use two separable passes of 7 rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouzel.functions.geometry import cell_index, cell_side, offsets

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need no installed package

# The class labels of the grid method.
OUTLIER = "outlier"
UNCERTAIN = "uncertain"
NON_OUTLIER = "non_outlier"
EMPTY = "empty"


def assign_cells(points: DataFrame, D: float) -> DataFrame:
    """B1: add the cell ``(i, j)`` of each point."""
    side = cell_side(D)
    return points.withColumn("i", cell_index("x", side)).withColumn("j", cell_index("y", side))


def cell_counts(points: DataFrame, D: float) -> DataFrame:
    """Points per occupied cell -> ``i, j, n``."""
    return (assign_cells(points.select("x", "y"), D)
            .groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")))


def expand_cells(cells: DataFrame, size: int) -> DataFrame:
    """B2: every square of side ``size`` (3 or 7) that contains each cell.

    One row per (cell, square): ``ci, cj`` the cell, ``i, j`` the square's
    center, ``n`` the cell's points and ``center`` = 1 when the cell is the
    square's center. This is the literal stencil (``size**2`` rows per
    cell); the sums below use the separable form instead.
    """
    r = size // 2
    return (cells
            .select("i", "j", "n", F.explode(offsets(r)).alias("di"))
            .select("i", "j", "n", "di", F.explode(offsets(r)).alias("dj"))
            .select(F.col("i").alias("ci"), F.col("j").alias("cj"),
                    (F.col("i") + F.col("di")).alias("si"), (F.col("j") + F.col("dj")).alias("sj"),
                    "n",
                    ((F.col("di") == 0) & (F.col("dj") == 0)).cast("int").alias("center"))
            .withColumnRenamed("si", "i").withColumnRenamed("sj", "j"))


def square_counts(cells: DataFrame, size: int) -> DataFrame:
    """Points per square of side ``size`` around every cell of the
    stencil union, with ``center`` = 1 when the center cell is occupied.

    Output ``i, j, n_sq, center``.
    """
    r = size // 2
    rows = (cells
            .select("i", "j", "n", F.explode(offsets(r)).alias("di"))
            .select((F.col("i") + F.col("di")).alias("i"), "j", "n",
                    F.when(F.col("di") == 0, F.lit(1)).otherwise(F.lit(0)).alias("c"))
            .groupBy("i", "j").agg(F.sum("n").alias("rn"), F.sum("c").alias("rc")))
    return (rows
            .select("i", "j", "rn", "rc", F.explode(offsets(r)).alias("dj"))
            .select("i", (F.col("j") + F.col("dj")).alias("j"), "rn",
                    F.when(F.col("dj") == 0, F.col("rc")).otherwise(F.lit(0)).alias("c"))
            .groupBy("i", "j")
            .agg(F.sum("rn").alias("n_sq"), F.sum("c").cast("int").alias("center")))


def merge_counts(cells: DataFrame) -> DataFrame:
    """``N3``, ``N7`` and the cell's own count ``n`` for every cell of
    the 7x7 stencil union (``n = 0`` for unoccupied cells).

    One pass: every occupied cell sends its count to the 49 cells whose 7x7
    square contains it, flagged for the 3x3 and the center, and one
    aggregate (partial before the shuffle) sums them. A key receives at most
    49 rows, so no key can be skewed. Two separable passes (7 + 7 rows)
    would shuffle the 7-row pass in addition and, on a sparse grid, as many
    rows in the second pass, so the single pass moves less data.
    """
    near = (F.abs(F.col("di")) <= 1) & (F.abs(F.col("dj")) <= 1)
    center = (F.col("di") == 0) & (F.col("dj") == 0)
    return (cells
            .select("i", "j", "n", F.explode(offsets(3)).alias("di"))
            .select("i", "j", "n", "di", F.explode(offsets(3)).alias("dj"))
            .select((F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j"),
                    F.col("n").alias("r7"),
                    F.when(near, F.col("n")).otherwise(F.lit(0)).alias("r3"),
                    F.when(center, F.col("n")).otherwise(F.lit(0)).alias("r0"))
            .groupBy("i", "j")
            .agg(F.sum("r3").alias("n3"), F.sum("r7").alias("n7"), F.sum("r0").alias("n")))


def class_expr(M: int) -> F.Column:
    """Class of a stencil cell from ``n``, ``n3``, ``n7``."""
    return (F.when(F.col("n") == 0, F.lit(EMPTY))
            .when(F.col("n3") > M, F.lit(NON_OUTLIER))
            .when(F.col("n7") <= M, F.lit(OUTLIER))
            .otherwise(F.lit(UNCERTAIN)))


def classify_cells(points: DataFrame, D: float, M: int, include_empty: bool = True) -> DataFrame:
    """``i, j, n, n3, n7, class`` for every cell of the stencil union, or
    for the occupied cells only (``include_empty=False``, computed on
    tiles, at most 4 shuffled rows per cell)."""
    if include_empty:
        merged = merge_counts(cell_counts(points, D))
    else:
        merged = _occupied(cell_counts(points, D))
    return merged.select("i", "j", "n", "n3", "n7", class_expr(M).alias("class"))


# Tiles are TILE x TILE cells; a tile's sums need the cells up to REACH beyond it.
TILE, REACH = 16, 3
SIDE = TILE + 2 * REACH
CHUNK = 512            # tiles laid out together


def _tiles(cells: DataFrame) -> DataFrame:
    """Every occupied cell, sent to the at most 2x2 tiles that its 7x7 stencil touches.

    ``ti, tj, ri, rj, n``: the tile and the cell's place in it (from -REACH on), sorted
    by tile. A tile receives at most SIDE * SIDE cells, a bound that no skew can break.
    """
    def touched(c: str) -> F.Column:
        low, high = (F.floor((F.col(c) + d) / F.lit(TILE)) for d in (-REACH, REACH))
        return F.explode_outer(F.when(low == high, F.array(low)).otherwise(F.array(low, high)))
    sent = (cells.select("i", "j", "n", touched("i").alias("ti"))
            .select("i", "j", "n", "ti", touched("j").alias("tj"))
            .select("ti", "tj", (F.col("i") - F.col("ti") * TILE).alias("ri"), (F.col("j") - F.col("tj") * TILE).alias("rj"), "n"))
    return sent.repartition("ti", "tj").sortWithinPartitions("ti", "tj")


def _box(grid: np.ndarray, r: int) -> np.ndarray:
    """Sums over the (2r+1) x (2r+1) squares around each cell of the tiles (the cells inside REACH)."""
    sums = np.zeros((len(grid), SIDE + 1, SIDE + 1), grid.dtype)
    sums[:, 1:, 1:] = grid.cumsum(1).cumsum(2)
    lo, hi = REACH - r, REACH + r + 1
    top, low = slice(lo, lo + TILE), slice(hi, hi + TILE)
    return sums[:, low, low] - sums[:, top, low] - sums[:, low, top] + sums[:, top, top]


def _per_tile(tiles: DataFrame, schema: str, result) -> DataFrame:
    """``result(ti, tj, n, n3, n7)`` over chunks of tiles: arrays (tiles, TILE, TILE) of the cells' sums."""
    def laid_out(rows: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])
        grid = np.zeros((int(new.sum()), SIDE, SIDE), np.int64)
        grid[np.cumsum(new) - 1, rows[:, 2] + REACH, rows[:, 3] + REACH] = rows[:, 4]
        inner = slice(REACH, REACH + TILE)
        return result(rows[new, 0], rows[new, 1], grid[:, inner, inner], _box(grid, 1), _box(grid, 3))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 5), np.int64)   # the last tile goes on in the next batch
        for b in it:
            rows = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1).astype(np.int64)])
            starts = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)]))
            for k in range(0, len(starts) - 1, CHUNK):
                yield laid_out(rows[starts[k]:starts[min(k + CHUNK, len(starts) - 1)]])
            held = rows[starts[-1]:] if len(starts) else rows
        if len(held):
            yield laid_out(held)

    return tiles.mapInArrow(run, schema)


def _occupied(cells: DataFrame) -> DataFrame:
    """``i, j, n, n3, n7`` of every occupied cell."""
    def result(ti, tj, n, n3, n7):
        t, i, j = np.nonzero(n)
        cols = (ti[t] * TILE + i, tj[t] * TILE + j, n[t, i, j], n3[t, i, j], n7[t, i, j])
        return pa.record_batch([pa.array(c) for c in cols], names=["i", "j", "n", "n3", "n7"])
    return _per_tile(_tiles(cells), "i long, j long, n long, n3 long, n7 long", result)


def class_summary(points: DataFrame, D: float, M: int, include_empty: bool = True) -> DataFrame:
    """Per class, the number of cells and of points.

    Same answer as grouping ``classify_cells``: each occupied cell is shuffled to the at
    most 4 tiles that need it instead of to its 49 stencil keys, the sums of a tile are
    box sums over its cells, and each chunk of tiles gives one row per class.
    """
    names = [EMPTY, NON_OUTLIER, OUTLIER, UNCERTAIN] if include_empty else [None, NON_OUTLIER, OUTLIER, UNCERTAIN]

    def result(ti, tj, n, n3, n7):
        kind = np.where(n == 0, np.where(n7 > 0, 0, -1), np.where(n3 > M, 1, np.where(n7 <= M, 2, 3)))
        rows = [(c, int((kind == k).sum()), int(n[kind == k].sum())) for k, c in enumerate(names) if c]
        return pa.record_batch([pa.array(list(c)) for c in zip(*rows)], names=["class", "cells", "points"])

    return (_per_tile(_tiles(cell_counts(points, D)), "class string, cells long, points long", result)
            .groupBy("class").agg(F.sum("cells").alias("cells"), F.sum("points").alias("points"))
            .where(F.col("cells") > 0))


def class_cells(points: DataFrame, D: float, M: int, include_empty: bool = False) -> DataFrame:
    """The cells of each class, one row per cell (``class, i, j, n``).

    The per-class list is kept distributed; a class can hold nearly every
    cell, so it is never gathered into one row.
    """
    return classify_cells(points, D, M, include_empty).select("class", "i", "j", "n")


def outlier_points(points: DataFrame, D: float, M: int) -> DataFrame:
    """Each point with the class of its cell (``id, x, y, i, j, class``).

    The cell table joins on (i, j); AQE picks a broadcast when the measured
    cell table is small and splits a skewed cell otherwise.
    """
    cls = classify_cells(points, D, M, include_empty=False).select("i", "j", "class")
    return assign_cells(points.select("id", "x", "y"), D).join(cls, ["i", "j"], "inner")


def smallest_cells(points: DataFrame, D: float, K: int) -> DataFrame:
    """The K occupied cells with the fewest points (ties by i, j)."""
    return cell_counts(points, D).orderBy("n", "i", "j").limit(K)


def square_union(points: DataFrame, D: float) -> DataFrame:
    """G1: 3x3 squares, 7x7 squares and cells stacked with a ``kind`` column."""
    cells = cell_counts(points, D)
    s3 = square_counts(cells, 3).select(F.lit("square3").alias("kind"), "i", "j", "n_sq", "center")
    s7 = square_counts(cells, 7).select(F.lit("square7").alias("kind"), "i", "j", "n_sq", "center")
    c = cells.select(F.lit("cell").alias("kind"), "i", "j", F.col("n").alias("n_sq"),
                     F.lit(1).alias("center"))
    return s3.unionByName(s7).unionByName(c)
