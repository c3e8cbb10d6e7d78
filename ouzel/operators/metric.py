"""Exact ball counts and outliers in any number of columns, by a metric partition.

Points are rows ``id, v`` with ``v`` an array of numbers. Equal points become one row
with a multiplicity. A cell that is too large is split: some of its points, drawn by a
hash, are pivots, every point belongs to its nearest pivot, and a sub-cell's radius is
the distance of its farthest own point. A point x is also a guest of another sub-cell c,
if that may hold a point within D of it. By the triangle inequality it cannot, if
* d(x, pivot of c) >= radius of c + D, or
* d(x, pivot of c) - d(x, own pivot) >= 2 D (points of c are nearer to their pivot).
Sub-cells that are still too large, for copies of a spot say, are split again with
pivots of their own, so the cells follow the density. In the end a cell's own and guest
points are compared with its own points, in packed blocks of at most ``BLOCK`` points on
either side: a task holds two blocks at a time. Nothing is dropped or sampled: the counts
are exact.

Where distances are all alike, as between random directions in many columns, no
partition can rule pairs out, and every point would be a guest of most cells. So a split is
first tried on some points of a cell, and a cell for which guests would cost more than the
pairs they save stays as it is (as do cells after ``DEPTH`` splits). Large cells are stored in
blocks of ``CELLS`` numbers, a file each; a task reads two of them at a time, and a pair of own
blocks is compared once for both sides. That work is quadratic by nature: pairs of points
cost a few ns each, and what is read grows with the number of blocks.

Outliers need no full counts: points with more than M points nearer than D among ``PROBED``
drawn ones are none. Only the others are guests and are compared with all points.

Points that are null, empty or hold a null or a non-finite number take no part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouzel.session import shared_dir, written
from ouzel.sources.lines import open_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need no installed package

LEAF, SHARE = 1024, 256     # own points of a cell that is not split; own points for each pivot
PIVOTS, DEPTH = 512, 8      # pivots of a cell; splits in a row
BLOCK = 1024                # points of a block of a small cell
MOST, CELLS = 4096, 1 << 20 # own points of a small cell; numbers in a block of a large one
TRIED = 2048                # points of a cell that a split is tried on
COPIES, MOVED = 8, 8192     # guests of a point that any split may make; pairs that cost as much as moving a point
PROBED = 8192               # points that all are compared with before outliers are looked for
TILE = 512, 2048            # points compared at a time


def vector(*columns: Column | str) -> Column:
    """The columns of a point as one array."""
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in columns])


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays, summed from the first column on."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def finite(v: Column) -> Column:
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def matrix(lists: pa.Array) -> np.ndarray:
    """Arrays of equal length as rows."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between the rows of ``a`` and of ``b``, from differences (no cancellation)."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 21) // max(1, b.size))
    for i in range(0, len(a), step):
        out[i:i + step] = np.sqrt(np.square(a[i:i + step, None, :] - b[None, :, :]).sum(-1))
    return out


def _sides(a: np.ndarray, b: np.ndarray, D: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Matrices whose product is the squared distances, to within the third value: in single precision, if that
    tells nearly all pairs."""
    center = b.mean(0) if len(b) else np.zeros(b.shape[1])
    far = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)) * 2.0 ** -51 * np.sqrt(a.shape[1])   # rounding of the center's shift
    a, b = a - center, b - center
    aa, bb = np.square(a).sum(1), np.square(b).sum(1)
    size = aa.max(initial=0.0) + bb.max(initial=0.0)
    for kind, unit in ((np.float32, 2.0 ** -24), (np.float64, 2.0 ** -53)):
        slack = 4 * (a.shape[1] + 8) * unit * (size + D * D) + 2 * far * (D + far)
        if kind is np.float64 or (slack < D * D / 64 and D * D > 1e-30 and size < 1e30):
            left = np.column_stack([a, aa, np.ones(len(a))]).astype(kind)
            right = np.column_stack([-2 * b, np.ones(len(b)), bb]).astype(kind)
            return left, np.ascontiguousarray(right.T), slack


def within(a: np.ndarray, b: np.ndarray, weight: np.ndarray, D: float, back: np.ndarray | None = None):
    """For each row of ``a`` the weight of the rows of ``b`` nearer than D; with ``back``, the weights of ``a``, also for each
    row of ``b`` that of the rows of ``a``. Pairs that are clear are told by the product form of the distance, those near
    the bound by differences."""
    out, other = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    weight = weight.astype(float)
    back = None if back is None else back.astype(float)
    with np.errstate(over="ignore", invalid="ignore"):
        left, right, slack = _sides(a, b, D)
        low, high = left.dtype.type(D * D - slack), left.dtype.type(D * D + slack)
        for r in range(0, len(a), TILE[0]):
            for c in range(0, len(b), TILE[1]):
                square = left[r:r + TILE[0]] @ right[:, c:c + TILE[1]]
                rows, columns = square.shape
                at = np.flatnonzero(~(square > high))
                some = square.ravel()[at]
                unsure = np.flatnonzero(~(some < low))
                if len(unsure):
                    near = np.ones(len(at), bool)
                    for u in range(0, len(unsure), 8192):
                        i, j = np.divmod(at[unsure[u:u + 8192]], columns)
                        near[unsure[u:u + 8192]] = np.sqrt(np.square(a[r + i] - b[c + j]).sum(1)) < D
                    at = at[near]
                if not len(at):
                    continue
                if 8 * len(at) > square.size:        # most pairs are near
                    near = np.zeros(square.size)
                    near[at] = 1
                    near = near.reshape(rows, columns)
                    out[r:r + rows] += (near @ weight[c:c + columns]).astype(np.int64)
                    if back is not None:
                        other[c:c + columns] += (back[r:r + rows] @ near).astype(np.int64)
                    continue
                i, j = np.divmod(at, columns)
                out[r:r + rows] += np.bincount(i, weight[c + j], rows).astype(np.int64)
                if back is not None:
                    other[c:c + columns] += np.bincount(j, back[r + i], columns).astype(np.int64)
    return out if back is None else (out, other)


# own: a point that the cell's points are compared with; asked: a point whose ball is counted (each guest is)
POINT = "cell string, own boolean, asked boolean, id long, w long, v array<double>"


def _draw(salt: int) -> Column:
    """A number from 0 to 1 for each point."""
    return F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def _blocks(rows: DataFrame, sizes: DataFrame, size: int) -> DataFrame:
    """(cell, own, asked, ids, ws, vs): at most about ``size`` of a cell's rows in one. ``sizes``: (cell, n) of these rows."""
    part = F.pmod(F.xxhash64("id", "v"), F.ceil(F.col("n") / size))
    return (rows.join(sizes, "cell").groupBy("cell", "own", "asked", part.alias("part"))
            .agg(F.collect_list(F.struct("id", "w", "v")).alias("p"))
            .select("cell", "own", "asked", F.col("p.id").alias("ids"), F.col("p.w").alias("ws"), F.col("p.v").alias("vs")))


def _of_block(b: pa.RecordBatch, k: int, *names: str) -> list:
    row = b.slice(k, 1)
    return [row.column(n).flatten() for n in names]


def _nearest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of own points (cell, asked, ids, ws, vs, pivots) -> each point's sub-cell and the distance to its pivot."""
    for b in it:
        for k in range(b.num_rows):
            ids, ws, vs, pivots = _of_block(b, k, "ids", "ws", "vs", "pivots")
            d = distances(matrix(vs), matrix(pivots))
            at = d.argmin(1)
            n = len(ids)
            yield pa.record_batch([pa.array([b.column("cell")[k].as_py()] * n, pa.string()), pa.array(at.astype(np.int32)),
                                   pa.array(d[np.arange(n), at]), pa.array([b.column("asked")[k].as_py()] * n), ids, ws, vs],
                                  names=["cell", "sub", "r", "asked", "id", "w", "v"])


def _may_hold(d: np.ndarray, own: np.ndarray, radii: np.ndarray, D: float) -> np.ndarray:
    """Which sub-cells, but a point's own, may hold a point within D of each point; ``d``: the distances to the pivots."""
    may = d * (1 - 1e-12) < radii + D
    mine = np.flatnonzero(own)
    at = d[mine].argmin(1)
    may[mine] &= d[mine] - d[mine, at][:, None] < 2 * D * (1 + 1e-12)
    may[mine, at] = False
    return may


def _worth(D: float):
    """Some points of cells (cell, owned, n, p, pivots) -> the cells for which a split is expected to save more than it costs."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            cells = []
            for k in range(b.num_rows):
                own, asked, vs, pivots = _of_block(b, k, "own", "asked", "vs", "pivots")
                own, asked = (x.to_numpy(zero_copy_only=False) for x in (own, asked))
                d = distances(matrix(vs), matrix(pivots))
                at, radii = d[own].argmin(1), np.full(d.shape[1], -np.inf)
                np.maximum.at(radii, at, d[own].min(1, initial=np.inf))
                owned, scale = b.column("owned")[k].as_py(), b.column("n")[k].as_py() / len(own)
                guests = _may_hold(d, own, radii, D)[asked].sum(0) * scale
                each = np.bincount(at, minlength=d.shape[1]) / max(1, len(at)) * owned       # own points of the sub-cells
                mine = np.bincount(at, asked[own], minlength=d.shape[1]) * scale             # those whose balls are counted
                split = ((guests + mine) * each).sum() + MOVED * (guests.sum() + owned)
                if guests.sum() <= COPIES * asked.sum() * scale or split < (asked & ~own).sum() * scale * owned + mine.sum() * owned / 2:
                    cells.append(b.column("cell")[k].as_py())
            yield pa.record_batch([pa.array(cells, pa.string())], names=["cell"])
    return run


def _guests(D: float):
    """Blocks (cell, own, ids, ws, vs, pivots, radii) -> a guest row for each other sub-cell that may hold a point within D."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k in range(b.num_rows):
                cell, own = b.column("cell")[k].as_py(), b.column("own")[k].as_py()
                ids, ws, vs, pivots, radii = _of_block(b, k, "ids", "ws", "vs", "pivots", "radii")
                d, r = distances(matrix(vs), matrix(pivots)), radii.to_numpy(zero_copy_only=False)
                i, j = np.nonzero(_may_hold(d, np.full(len(d), own), r, D))
                for s in range(0, len(i), 8192):
                    at = pa.array(i[s:s + 8192])
                    yield pa.record_batch([pa.array([f"{cell}/{x}" for x in j[s:s + 8192].tolist()], pa.string()),
                                           pa.array(np.zeros(len(at), bool)), pa.array(np.ones(len(at), bool)),
                                           ids.take(at), ws.take(at), vs.take(at)], names=["cell", "own", "asked", "id", "w", "v"])
    return run


def partition(points: DataFrame, D: float, leaf: int = LEAF, share: int = SHARE, depth: int = DEPTH) -> list[DataFrame]:
    """Stored tables of rows (``POINT``) of the final cells; ``points``: distinct (id, w, v), and ``asked`` if not all balls
    are to be counted. Each point is an own row of one cell, and a guest, if asked, of each other cell that may hold a
    point within D of it."""
    spark = points.sparkSession
    keep = lambda df, name: written(df, shared_dir(spark, name))
    asked = F.col("asked") if "asked" in points.columns else F.lit(True)
    rows = keep(points.select(F.lit("").alias("cell"), F.lit(True).alias("own"), asked.alias("asked"), "id", "w", "v"), "metric-points")
    done = []
    for level in range(depth + 1):
        sizes = (rows.groupBy("cell").agg(F.count_if("own").alias("owned"), F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("wanting"))
                 .where("owned > 0 and wanting > 0"))
        sizes = keep(sizes, "metric-sizes")
        small = F.col("owned") <= (leaf if level < depth else 1 << 62)
        large = sizes.where(~small)
        if large.isEmpty():
            done.append(rows.join(sizes.select("cell"), "cell", "left_semi"))
            break
        # about as many own points as there shall be pivots, twice as many are drawn, by a hash
        wanted = F.least(F.lit(PIVOTS), F.greatest(F.lit(2), F.ceil(F.col("owned") / share)))
        drawn = (rows.where("own").join(large.select("cell", "owned", wanted.alias("wanted")), "cell")
                 .where(_draw(level) < 2.5 * (F.col("wanted") + 8) / F.col("owned")))
        pivots = (drawn.groupBy("cell", "wanted").agg(F.sort_array(F.collect_list(F.struct(_draw(level).alias("h"), "id", "v"))).alias("p"))
                  .select("cell", F.slice("p", F.lit(1), F.col("wanted").cast("int")).alias("p")))
        pivots = keep(pivots.where(F.size("p") > 1).select("cell", F.col("p.v").alias("pivots")), "metric-pivots")
        # a split is tried on some points; cells that it does not pay for stay as they are
        tried = (rows.join(large.select("cell", "owned", "n"), "cell").where(_draw(-1 - level) < float(TRIED) / F.col("n"))
                 .groupBy("cell", "owned", "n").agg(F.collect_list(F.struct("own", "asked", "v")).alias("p"))
                 .select("cell", "owned", "n", F.col("p.own").alias("own"), F.col("p.asked").alias("asked"), F.col("p.v").alias("vs")))
        worth = keep(tried.join(pivots, "cell").mapInArrow(_worth(D), "cell string"), "metric-worth")
        done.append(rows.join(sizes.join(large.join(worth, "cell", "left_semi"), "cell", "left_anti").select("cell"), "cell", "left_semi"))
        if worth.isEmpty():
            break
        pivots = pivots.join(worth, "cell", "left_semi")
        blocks = keep(_blocks(rows, large.join(worth, "cell", "left_semi").select("cell", "n"), BLOCK), "metric-blocks")
        own = keep(blocks.where("own").join(pivots, "cell").mapInArrow(
            _nearest, "cell string, sub int, r double, asked boolean, id long, w long, v array<double>"), "metric-own")
        radii = (own.groupBy("cell", "sub").agg(F.max("r").alias("r")).groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("sub", "r"))).alias("m")))
        known = (pivots.join(radii, "cell").select("cell", "pivots", F.transform(
            F.sequence(F.lit(0), F.size("pivots") - 1), lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(float("-inf")))).alias("radii")))
        guests = blocks.where("asked").join(known, "cell").mapInArrow(_guests(D), POINT)
        rows = keep(own.select(F.concat_ws("/", "cell", F.col("sub").cast("string")).alias("cell"), F.lit(True).alias("own"), "asked", "id", "w", "v")
                    .union(guests), "metric-points")
    return done


def _compare(D: float):
    """Pairs of blocks (ids, vs, mine_vs, mine_ws) -> how many points of the own block lie within D of each point."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k in range(b.num_rows):
                ids, vs, mine, ws = _of_block(b, k, "ids", "vs", "mine_vs", "mine_ws")
                yield _found(ids, within(matrix(vs), matrix(mine), ws.to_numpy(), D))
    return run


def _found(ids: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(n)
    return pa.record_batch([ids.take(pa.array(some)), pa.array(n[some])], names=["id", "n"])


def _read(folder: str, file: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The (ids, ws, vs) of a stored block."""
    fs, root = open_folder(folder)
    row = pq.read_table(f"{root}/{file}", filesystem=fs, columns=["ids", "ws", "vs"]).slice(0, 1).combine_chunks()
    ids, ws, vs = (row.column(c).chunk(0).flatten() for c in ("ids", "ws", "vs"))
    return ids, ws.to_numpy(), matrix(vs)


def _compare_stored(folder: str, D: float):
    """Pairs of stored blocks (a, b, mutual): as ``_compare`` the points of ``a`` with those of ``b``; if mutual, the other way as well."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for p in batch.to_pylist():
                ids, ws, vs = _read(folder, p["a"])
                if p["a"] == p["b"]:
                    yield _found(ids, within(vs, vs, ws, D))
                    continue
                mine, mine_ws, mine_vs = _read(folder, p["b"])
                if p["mutual"]:
                    n, other = within(vs, mine_vs, mine_ws, D, ws)
                    yield _found(mine, other)
                else:
                    n = within(vs, mine_vs, mine_ws, D)
                yield _found(ids, n)
    return run


def _large_counts(rows: DataFrame, sizes: DataFrame, D: float, mutual: bool, cells: int) -> DataFrame:
    """(id, n) of the cells (cell, owned, columns) whose own points are compared in pairs of stored blocks."""
    spark, folder = rows.sparkSession, shared_dir(rows.sparkSession, "metric-large")
    most = F.greatest(F.lit(1), F.floor(F.lit(cells) / F.col("columns")))
    parts = lambda n: F.greatest(F.ceil(n / most), F.least(F.lit(8), F.ceil(n * 8 / most)))  # noqa: E731  several for the cores
    # if all balls are counted, own blocks are compared with one another; else the points asked for stand in blocks of their own
    apart = rows.where("not own" if mutual else "asked").select("cell", F.lit(False).alias("own"), "id", "w", "v")
    dealt = rows.where("own").select("cell", "own", "id", "w", "v").union(apart).join(sizes, "cell")
    count = F.when(F.col("own"), F.col("owned")).otherwise(F.col("apart"))
    part = F.pmod(F.xxhash64("id", "v"), parts(count)).alias("part")
    blocks = (dealt.groupBy("cell", "own", part).agg(F.collect_list(F.struct("id", "w", "v")).alias("p"))
              .select("cell", "own", "part", F.col("p.id").alias("ids"), F.col("p.w").alias("ws"), F.col("p.v").alias("vs")))
    blocks.write.option("maxRecordsPerFile", 1).parquet(folder)
    index = spark.read.schema(blocks.schema).parquet(folder).select("cell", "own", "part", F.col("_metadata.file_name").alias("file"))
    index = written(index, shared_dir(spark, "metric-index"))
    own = index.where("own").select("cell", F.col("part").alias("mine"), F.col("file").alias("b"))
    pairs = index.where("not own").join(own, "cell").select(F.col("file").alias("a"), "b", F.lit(False).alias("mutual"))
    if mutual:
        pairs = pairs.union(index.where("own").join(own, "cell").where("part <= mine").select(F.col("file").alias("a"), "b", F.lit(True).alias("mutual")))
    pairs = written(pairs, shared_dir(spark, "metric-pairs"))
    n = pairs.count()
    return pairs.repartition(max(1, min(n, max(256, n // 8)))).mapInArrow(_compare_stored(folder, D), "id long, n long")


def cell_sizes(cells: list[DataFrame]) -> DataFrame:
    """(cell, owned, guests): what each final cell compares."""
    return _union([c.groupBy("cell").agg(F.count_if("own").alias("owned"), F.count_if(~F.col("own")).alias("guests")) for c in cells])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def distinct_points(points: DataFrame) -> DataFrame:
    """(id, w, v): equal points as one row, with the smallest id and how many they are."""
    whole = points.where(finite(F.col("v"))).select("id", F.transform("v", lambda x: x.cast("double") + F.lit(0.0)).alias("v"))   # no -0.0
    return whole.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w")).select("id", "w", "v")


def _counts(cells: list[DataFrame], D: float, mutual: bool, most: int, numbers: int) -> DataFrame:
    """(id, ball) of the points asked for; ``mutual``: that is all points."""
    rows = _union(cells)
    sizes = rows.groupBy("cell").agg(F.count_if("own").alias("owned"), F.count_if(F.expr("not own" if mutual else "asked")).alias("apart"),
                                     F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("columns"))
    sizes = written(sizes, shared_dir(rows.sparkSession, "metric-cells"))
    large = sizes.where(F.col("owned") > most).select("cell", "owned", "apart", "columns")
    small = sizes.where(F.col("owned") <= most)
    probes = _blocks(rows.where("asked"), small.select("cell", "n"), BLOCK).select("cell", "ids", "vs")
    mine = (_blocks(rows.where("own").withColumn("asked", F.lit(True)), small.select("cell", F.col("owned").alias("n")), BLOCK)
            .select("cell", F.col("vs").alias("mine_vs"), F.col("ws").alias("mine_ws")))
    counts = probes.join(mine, "cell").mapInArrow(_compare(D), "id long, n long")
    if not large.isEmpty():
        counts = counts.union(_large_counts(rows, large, D, mutual, numbers))
    return counts.groupBy("id").agg(F.sum("n").alias("ball"))


def _with_balls(points: DataFrame, cells: list[DataFrame], counts: DataFrame) -> DataFrame:
    found = _union(cells).where("own").select("id", "v").join(counts, "id").select(F.col("v").alias("at"), "ball")
    whole = F.transform("v", lambda x: x.cast("double") + F.lit(0.0))
    return points.where(finite(F.col("v"))).join(found, whole == F.col("at")).select("id", "v", "ball")


def _checked(D: float) -> None:
    if not D > 0:
        raise ValueError(f"distance D must be > 0, got {D!r}")


def ball_counts(points: DataFrame, D: float, leaf: int = LEAF, share: int = SHARE, depth: int = DEPTH, most: int = MOST,
                numbers: int = CELLS) -> DataFrame:
    """D6 in any number of columns: for each of ``id, v`` the points nearer than D, itself included -> ``id, v, ball``.

    Two points are compared column by column, so all have to have the same number of columns.
    """
    _checked(D)
    cells = partition(distinct_points(points), D, leaf, share, depth)
    return _with_balls(points, cells, _counts(cells, D, True, most, numbers))


def _compare_drawn(folder: str, files: list[str], D: float):
    """Points (id, w, v) -> (id, n): the drawn points within D, or the point's own copies, if they are more."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = [_read(folder, f) for f in files]
        for b in it:
            ids, n, vs = b.column("id"), b.column("w").to_numpy(), matrix(b.column("v"))
            yield _found(ids, np.maximum(n, sum(within(vs, x, ws, D) for _, ws, x in drawn)))
    return run


def may_be_outliers(points: DataFrame, D: float, M: int, probed: int = PROBED) -> DataFrame:
    """Distinct points (id, w, v), stored, with ``asked``: false if more than M points within D are known from some drawn ones."""
    spark = points.sparkSession
    points = written(points, shared_dir(spark, "metric-distinct"))
    n = points.count()
    folder = shared_dir(spark, "metric-drawn")
    drawn = points.where(_draw(-100) < probed / max(1, n)).groupBy().agg(F.collect_list(F.struct("id", "w", "v")).alias("p"))
    drawn = drawn.where(F.size("p") > 0).select(F.col("p.id").alias("ids"), F.col("p.w").alias("ws"), F.col("p.v").alias("vs"))
    drawn.write.option("maxRecordsPerFile", 1).parquet(folder)
    files = [r[0] for r in spark.read.schema(drawn.schema).parquet(folder).select(F.col("_metadata.file_name")).collect()]   # one, or none
    many = (points.mapInArrow(_compare_drawn(folder, files, D), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
            .where(F.col("n") > M).select(F.col("id").alias("full")))
    return points.join(many, F.col("id") == F.col("full"), "left").select("id", "w", "v", (F.col("full").isNull() & F.col("id").isNotNull()).alias("asked"))


def exact_outliers(points: DataFrame, D: float, M: int, probed: int = PROBED, leaf: int = LEAF, share: int = SHARE, depth: int = DEPTH,
                   most: int = MOST, numbers: int = CELLS) -> DataFrame:
    """C1 in any number of columns: the points with at most M points nearer than D -> ``id, v, ball``."""
    _checked(D)
    cells = partition(may_be_outliers(distinct_points(points), D, M, probed), D, leaf, share, depth)
    return _with_balls(points, cells, _counts(cells, D, False, most, numbers).where(F.col("ball") <= M))


def point_distance(points: DataFrame) -> DataFrame:
    """B4 in any number of columns: the distance of each point to that with the smallest id -> ``id, d``."""
    whole = points.where(finite(F.col("v")))
    first = whole.orderBy("id").select("v").first()          # one point
    at = F.array(*map(F.lit, first.v)).cast("array<double>") if first else F.col("v")
    return whole.select("id", distance(F.col("v"), at).alias("d"))
