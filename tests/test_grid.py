"""Grid method: golden 15-point input, cell edges, properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ouzel.functions.geometry import cell_side
from ouzel.operators import exact, grid
from ouzel.sources.points import points_from_embeddings, points_from_orders, read_points_text

# The 15-point golden input (x, y), in line order.
TEST_N15 = [
    (0.4, 0.9), (0.5, 4.1), (0.8, 0.91), (0.81, 1.1), (1.1, 5.0), (1.11, 5.1),
    (1.5, 1.1), (1.52, 1.11), (1.53, 1.12), (1.54, 1.13), (1.51, 3.2), (1.52, 3.6),
    (3.21, 4.6), (4.11, 4.11), (4.32, 4.3),
]
# Expected ball counts (D=1) by line number.
BALLS = [3, 1, 7, 7, 2, 2, 6, 6, 6, 6, 2, 2, 1, 2, 2]


@pytest.fixture(scope="module")
def n15(spark, tmp_path_factory):
    p = tmp_path_factory.mktemp("n15") / "input.txt"
    p.write_text("\n".join(f"{x},{y}" for x, y in TEST_N15) + "\n")
    return read_points_text(spark, str(p)).cache()


def test_n15_read(n15):
    rows = n15.orderBy("id").collect()
    assert [(r.x, r.y) for r in rows] == TEST_N15
    assert [r.id for r in rows] == list(range(15))


def test_n15_exact(n15):
    out = {r.id: r.ball for r in exact.exact_outliers_grid(n15, 1.0, 3).collect()}
    assert out == {i: b for i, b in enumerate(BALLS) if b <= 3}
    assert len(out) == 9
    band = {r.id: r.ball for r in exact.exact_outliers_band(n15, 1.0, 3).collect()}
    assert band == out
    balls = {r.id: r.ball for r in exact.ball_counts(n15, 1.0).collect()}
    assert balls == dict(enumerate(BALLS))
    top = exact.exact_outliers_topk(exact.exact_outliers_grid(n15, 1.0, 3), 9).collect()
    assert [r.id for r in top] == [1, 12, 4, 5, 10, 11, 13, 14, 0]


def test_n15_classes(n15):
    s = {r["class"]: (r.cells, r.points) for r in grid.class_summary(n15, 1.0, 3).collect()}
    assert s == {"outlier": (6, 7), "uncertain": (4, 4), "non_outlier": (1, 4), "empty": (234, 0)}
    cells = {(r.i, r.j): (r.n, r.n3, r.n7, r["class"])
             for r in grid.classify_cells(n15, 1.0, 3, include_empty=False).collect()}
    assert cells == {
        (1, 2): (1, 3, 7, "uncertain"), (1, 11): (1, 1, 5, "uncertain"),
        (2, 2): (1, 3, 7, "uncertain"), (2, 3): (1, 3, 7, "uncertain"),
        (3, 14): (2, 2, 3, "outlier"), (4, 3): (4, 4, 7, "non_outlier"),
        (4, 9): (1, 2, 3, "outlier"), (4, 10): (1, 2, 3, "outlier"),
        (9, 13): (1, 1, 3, "outlier"), (11, 11): (1, 2, 3, "outlier"),
        (12, 12): (1, 2, 3, "outlier"),
    }
    top = grid.smallest_cells(n15, 1.0, 9).collect()
    assert len(top) == 9 and all(r.n == 1 for r in top)


def test_cell_index_edges(spark):
    D = 1.0
    s = cell_side(D)
    xs = [0.0, -0.5 * s, -s, s * (1 - 1e-12), s, -2 * s, 2.5 * s, -2.5 * s]
    df = spark.createDataFrame([(i, x, 0.0) for i, x in enumerate(xs)], "id long, x double, y double")
    got = [r.i for r in grid.assign_cells(df, D).orderBy("id").collect()]
    assert got == [0, -1, -2, 0, 1, -3, 2, -3]


def test_bad_distance(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0)], "id long, x double, y double")
    for D in (0.0, -1.0):
        with pytest.raises(ValueError):
            grid.class_summary(df, D, 3)
        with pytest.raises(ValueError):
            exact.exact_outliers_band(df, D, 3)


def test_blank_line_fails(spark, tmp_path):
    p = tmp_path / "bad.txt"
    p.write_text("1.0,2.0\n\n3.0,4.0\n")
    with pytest.raises(Exception):
        read_points_text(spark, str(p)).collect()


def test_extra_columns_ignored_one_column_fails(spark, tmp_path):
    p = tmp_path / "extra.txt"
    p.write_text("1.0,2.0,7.0\n3.0,4.0,8.0\n")
    assert [(r.x, r.y) for r in read_points_text(spark, str(p)).orderBy("id").collect()] == [(1.0, 2.0), (3.0, 4.0)]
    q = tmp_path / "one.txt"
    q.write_text("1.0\n")
    with pytest.raises(Exception):
        read_points_text(spark, str(q)).collect()


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "id long, x double, y double")
    assert grid.class_summary(empty, 1.0, 3).count() == 0
    assert exact.exact_outliers_grid(empty, 1.0, 3).count() == 0
    one = spark.createDataFrame([(7, 0.0, 0.0)], "id long, x double, y double")
    s = {r["class"]: (r.cells, r.points) for r in grid.class_summary(one, 1.0, 3).collect()}
    assert s == {"outlier": (1, 1), "empty": (48, 0)}
    assert [(r.id, r.ball) for r in exact.exact_outliers_grid(one, 1.0, 3).collect()] == [(7, 1)]


def test_duplicates_count_separately(spark):
    pts = [(i, 1.0, 1.0) for i in range(5)] + [(10, 5.0, 5.0), (11, 5.0, 5.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    balls = {r.id: r.ball for r in exact.ball_counts(df, 1.0).collect()}
    assert balls == {0: 5, 1: 5, 2: 5, 3: 5, 4: 5, 10: 2, 11: 2}
    assert {r.id for r in exact.exact_outliers_grid(df, 1.0, 3).collect()} == {10, 11}


@pytest.mark.parametrize("view,D,M", [("PO", 1.0, 3), ("PE", 0.05, 3)])
def test_bounds_and_inclusions(spark, view, D, M):
    sf = "/root/testdata/sf0.001"
    pts = points_from_orders(spark, sf) if view == "PO" else points_from_embeddings(spark, sf)
    balls = exact.ball_counts(pts, D)
    cls = grid.outlier_points(pts, D, M)
    cells = grid.classify_cells(pts, D, M, include_empty=False)
    j = (balls.join(cls.select("id", "i", "j", "class"), "id").join(cells.select("i", "j", "n3", "n7"), ["i", "j"]))
    assert j.where((F.col("ball") < F.col("n3")) | (F.col("ball") > F.col("n7"))).count() == 0
    ex = {r.id for r in exact.exact_outliers_grid(pts, D, M).collect()}
    sure = {r.id for r in cls.where(F.col("class") == "outlier").collect()}
    unc = {r.id for r in cls.where(F.col("class") == "uncertain").collect()}
    assert sure <= ex <= (sure | unc)
    total = grid.class_summary(pts, D, M).agg(F.sum("points")).collect()[0][0]
    assert total == pts.count()
    band = {r.id for r in exact.exact_outliers_band(pts, D, M).collect()}
    assert band == ex


def test_separable_equals_literal_stencil(spark):
    pts = points_from_embeddings(spark, "/root/testdata/sf0.001")
    cells = grid.cell_counts(pts, 0.05)
    for size in (3, 7):
        lit = (grid.expand_cells(cells, size).groupBy("i", "j")
               .agg(F.sum("n").alias("n_sq"), F.sum("center").alias("center")))
        a = sorted(tuple(r) for r in lit.select("i", "j", "n_sq", "center").collect())
        b = sorted(tuple(r) for r in grid.square_counts(cells, size).select("i", "j", "n_sq", "center").collect())
        assert a == b


def _brute_balls(pts, D):
    import numpy as np
    xy = np.array([(x, y) for _, x, y in pts])
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1))
    return {pid: int(c) for (pid, _, _), c in zip(pts, (d < D).sum(1))}


@pytest.mark.parametrize("open_rows", [64, 4, 0])
def test_dense_cells_match_brute_force(spark, open_rows):
    """A hot cluster, a heap of copies and sparse points; dense cells take
    the whole-cell and sub-cell path when ``open_rows`` is small."""
    import numpy as np
    rng = np.random.default_rng(7)
    hot = rng.normal(0.0, 0.15, size=(300, 2))
    sparse = rng.uniform(-3, 3, size=(200, 2))
    xy = np.vstack([hot, sparse, np.full((30, 2), 0.05)])
    pts = [(k, float(x), float(y)) for k, (x, y) in enumerate(xy)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    truth = _brute_balls(pts, 0.4)
    got = {r.id: r.ball for r in exact.ball_counts(df, 0.4, open_rows=open_rows).collect()}
    assert got == truth
    for M in (3, 40):
        want = {k: v for k, v in truth.items() if v <= M}
        out = {r.id: r.ball for r in exact.exact_outliers_grid(df, 0.4, M, open_rows=open_rows).collect()}
        assert out == want
        band = {r.id: r.ball for r in exact.exact_outliers_band(df, 0.4, M, open_rows=open_rows).collect()}
        assert band == want


def test_tile_summary_equals_stencil_grouping(spark):
    """class_summary (super-cells) equals grouping the 49-key stencil table,
    also with negative coordinates and dense cells."""
    import numpy as np
    rng = np.random.default_rng(11)
    xy = np.vstack([rng.normal(0.0, 0.3, size=(400, 2)), rng.uniform(-6, 6, size=(300, 2))])
    dense = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(xy)],
                                  "id long, x double, y double")
    sf = "/root/testdata/sf0.001"
    for pts, D, M in [(dense, 0.4, 3), (dense, 0.4, 40), (points_from_orders(spark, sf), 1.0, 3),
                      (points_from_embeddings(spark, sf), 0.05, 3)]:
        for empty in (True, False):
            want = (grid.classify_cells(pts, D, M, empty).groupBy("class")
                    .agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("points")))
            got = grid.class_summary(pts, D, M, empty)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_tile_occupied_cells_equal_stencil(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    xy = np.vstack([rng.normal(-1.0, 0.2, size=(300, 2)), rng.uniform(-5, 5, size=(300, 2))])
    pts = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(xy)],
                                "id long, x double, y double")
    want = grid.classify_cells(pts, 0.4, 3, include_empty=True).where(F.col("n") > 0)
    got = grid.classify_cells(pts, 0.4, 3, include_empty=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_two_dense_spots_one_distance_apart(spark):
    """Spots whose points are all near the others' circle, cut down level by level."""
    rng = np.random.default_rng(8)
    n, D = 700, 1.0
    xy = np.vstack([rng.normal(0, 0.02, (n, 2)), rng.normal(0, 0.02, (n, 2)) + [D, 0], rng.uniform(-2, 3, (100, 2))])
    pts = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(xy)], "id long, x double, y double")
    d = np.sqrt((xy[:, None, 0] - xy[None, :, 0]) ** 2 + (xy[:, None, 1] - xy[None, :, 1]) ** 2)
    balls = (d < D).sum(1)
    got = {r.id: r.ball for r in exact.ball_counts(pts, D, open_rows=8).collect()}
    assert got == {k: int(b) for k, b in enumerate(balls)}
    for M in (3, 900):
        out = {r.id: r.ball for r in exact.exact_outliers_band(pts, D, M, open_rows=8).collect()}
        assert out == {k: int(b) for k, b in enumerate(balls) if b <= M}


def test_closer_than_cells_can_split(spark):
    """Locations that differ only in their last bits end as listed ones."""
    xs = [1.0]
    for _ in range(30):
        xs.append(float(np.nextafter(xs[-1], 2.0)))
    pts = spark.createDataFrame([(k, x, 1.0) for k, x in enumerate(xs)], "id long, x double, y double")
    assert {r.ball for r in exact.ball_counts(pts, 1.0, open_rows=2).collect()} == {31}


def test_classes_in_all_tiles(spark):
    """Cells on both sides of tile bounds, negative ones too, and one cell per tile."""
    pts = [(k, 0.17678 + i * 0.35355, 0.17678 + j * 0.35355)
           for k, (i, j) in enumerate([(i, j) for i in range(-20, 20, 3) for j in range(-20, 20, 5)] + [(500, 500), (-500, 3)])]
    df = spark.createDataFrame(pts + [(10_000 + k, x, y) for k, x, y in pts[:40]], "id long, x double, y double")
    whole = grid.classify_cells(df, 1.0, 3)
    exp = {r["class"]: (r.cells, r.points) for r in whole.groupBy("class").agg(F.count("*").alias("cells"), F.sum("n").alias("points")).collect()}
    assert exp == {r["class"]: (r.cells, r.points) for r in grid.class_summary(df, 1.0, 3).collect()}
    cells = lambda d: sorted(tuple(r) for r in d.collect())
    assert cells(whole.where("n > 0")) == cells(grid.classify_cells(df, 1.0, 3, include_empty=False))
