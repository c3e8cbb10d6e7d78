"""Registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the standard views and runs
over the whole table; only ``stream_prefix`` and ``stop_after_items``, whose
feature it is, end after a part of the stream.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ouzel.functions.geometry import dist
from ouzel.operators import exact, frequent, grid, kcenter, metric
from ouzel.plans import params as P
from ouzel.session import shared_dir
from ouzel.sources.points import (items_from_events, points_from_embeddings, points_from_orders,
                                  read_points_text, vectors_from_embeddings, write_points_text)
from ouzel.sources.lines import line_source
from ouzel.streaming import frequent_stream as fs
from ouzel.streaming import state_store as ss
from ouzel.streaming.state import BatchLog

Query = Callable[[SparkSession, str], DataFrame]


def _po(spark, sf):
    return points_from_orders(spark, sf)


def _pe(spark, sf):
    return points_from_embeddings(spark, sf, P.PE_L)


def _ev(spark, sf):
    return items_from_events(spark, sf)


def _n(spark, sf) -> int:
    """All arrivals."""
    return frequent.stream_length(_ev(spark, sf))


def _n_prefix(spark, sf) -> int:
    """The n of the two queries whose feature is a part of the stream."""
    return frequent.stream_length(_ev(spark, sf), P.PREFIX_NUM, P.PREFIX_DEN)


# ---------------------------------------------------------------- sources

def points_csv_scan(spark, sf):
    path = shared_dir(spark, "points-text")
    write_points_text(_po(spark, sf), path)
    return read_points_text(spark, path, with_id=False)


def points_repartition(spark, sf):
    """A2: bucket b of the L buckets is partition b."""
    pe = _pe(spark, sf).repartitionById(P.PE_L, F.col("b").cast("int"))
    return pe.groupBy(F.spark_partition_id().alias("part"), "b").agg(F.count(F.lit(1)).alias("rows"))


def points_count(spark, sf):
    return _po(spark, sf).agg(F.count(F.lit(1)).alias("n_points"))


def stream_items_scan(spark, sf):
    out = BatchLog(spark, shared_dir(spark, "stream-scan") + "/rows", "seq long, item long")
    work = shared_dir(spark, "stream-scan-ckpt")

    def sink(df, batch_id):
        out.write(df, batch_id)

    fs.run_stream(fs.item_stream(spark, sf), sink, f"{work}/checkpoint")
    return out.rows().select("seq", "item")


# ---------------------------------------------------------------- grid

def grid_assign(spark, sf):
    return grid.assign_cells(_po(spark, sf), P.PO_D).select("id", "i", "j")


def cell_counts(spark, sf):
    return grid.cell_counts(_po(spark, sf), P.PO_D)


def grid_expand_3(spark, sf):
    return grid.expand_cells(grid.cell_counts(_po(spark, sf), P.PO_D), 3)


def grid_expand_7(spark, sf):
    return grid.expand_cells(grid.cell_counts(_po(spark, sf), P.PO_D), 7)


def square3_counts(spark, sf):
    return grid.square_counts(grid.cell_counts(_po(spark, sf), P.PO_D), 3)


def square7_counts(spark, sf):
    return grid.square_counts(grid.cell_counts(_po(spark, sf), P.PO_D), 7)


def grid_merge(spark, sf):
    return grid.merge_counts(grid.cell_counts(_po(spark, sf), P.PO_D))


def grid_classify(spark, sf):
    return grid.classify_cells(_po(spark, sf), P.PO_D, P.PO_M)


def class_summary(spark, sf):
    return grid.class_summary(_po(spark, sf), P.PO_D, P.PO_M)


def class_cells(spark, sf):
    return grid.class_cells(_po(spark, sf), P.PO_D, P.PO_M)


def outlier_points(spark, sf):
    return grid.outlier_points(_po(spark, sf), P.PO_D, P.PO_M)


def smallest_cells_topk(spark, sf):
    return grid.smallest_cells(_po(spark, sf), P.PO_D, P.TOP_K)


def square_union(spark, sf):
    return grid.square_union(_po(spark, sf), P.PO_D)


# ---------------------------------------------------------------- exact

def exact_outliers_theta(spark, sf):
    return exact.exact_outliers_band(_pe(spark, sf), P.PE_D, P.PE_M)


def exact_outliers_grid(spark, sf):
    return exact.exact_outliers_grid(_po(spark, sf), P.PO_D, P.PO_M)


def ball_counts(spark, sf):
    return exact.ball_counts(_pe(spark, sf), P.PE_D)


def ball_counts_columns(spark, sf):
    """D6 over every column of the embeddings."""
    return metric.ball_counts(vectors_from_embeddings(spark, sf), P.PEC_D).select("id", "ball")


def exact_outliers_columns(spark, sf):
    """C1 over every column of the embeddings."""
    return metric.exact_outliers(vectors_from_embeddings(spark, sf), P.PEC_D, P.PEC_M).select("id", "ball")


def point_distance_columns(spark, sf):
    """B4 over every column of the embeddings."""
    return metric.point_distance(vectors_from_embeddings(spark, sf))


def exact_outliers_topk(spark, sf):
    return exact.exact_outliers_topk(exact.exact_outliers_grid(_po(spark, sf), P.PO_D, P.PO_M),
                                     P.TOP_K)


# ---------------------------------------------------------------- k-center

def _first_point(pe: DataFrame):
    """Coordinates of the smallest-id point as scalar subqueries (no driver trip)."""
    first = pe.orderBy("id").limit(1)
    return first.select("x").scalar(), first.select("y").scalar()


def point_distance(spark, sf):
    pe = _pe(spark, sf)
    x0, y0 = _first_point(pe)
    return pe.select("id", dist("x", "y", x0, y0).alias("d"))


def farthest_point(spark, sf):
    pe = _pe(spark, sf)
    x0, y0 = _first_point(pe)
    d = dist("x", "y", x0, y0)
    return pe.select("id", d.alias("d")).orderBy(F.col("d").desc(), F.col("id")).limit(1)


def _two_round_centers(spark, sf):
    pe = _pe(spark, sf)
    return pe, kcenter.mr_fft(pe, P.PE_K, P.PE_L)[0]


def _orders_bucketed(spark, sf, L: int):
    return _po(spark, sf).withColumn("b", F.pmod(F.col("id"), F.lit(L)))


def fft_coreset(spark, sf):
    return kcenter.fft_coreset(_pe(spark, sf), P.PE_K, "b")


def fft_centers(spark, sf):
    coreset = kcenter.fft_coreset(_pe(spark, sf), P.PE_K, "b")
    return kcenter.fft_centers(coreset, P.PE_K, coreset_rows=P.PE_K * P.PE_L)


def fft_radius(spark, sf):
    pe, centers = _two_round_centers(spark, sf)
    return kcenter.radius(pe, centers)


def fft_radius_orders(spark, sf):
    """F1c on the points from orders (bucket ``id mod L``)."""
    return kcenter.mr_fft(_orders_bucketed(spark, sf, P.PE_L), P.PE_K, P.PE_L)[1]


def fft_radius_orders_k100(spark, sf):
    """F1c at the size of the published runs: 100 centers, 16 buckets."""
    return kcenter.mr_fft(_orders_bucketed(spark, sf, P.ORD_L), P.ORD_K, P.ORD_L)[1]


def fft_doubling(spark, sf):
    """F1c with the one-pass coreset, in a form that does not depend on the cut: whether there are 1 to K centers, and whether the
    radius is within its proven factor of that of the traversal of all points."""
    po = _po(spark, sf)
    centers, rad = kcenter.doubling_fft(po, P.PE_K)
    best = kcenter.radius(po, kcenter.fft_iterative(po, P.PE_K)).select("radius").scalar()
    return rad.select(F.lit(0 < len(centers) <= P.PE_K).alias("at_most_k"),
                      (F.col("radius") <= kcenter.DOUBLING_FACTOR * best).alias("within"))


def nearest_center_distance(spark, sf):
    pe, centers = _two_round_centers(spark, sf)
    return kcenter.nearest_center_distance(pe, centers)


def center_cross_join(spark, sf):
    pe, centers = _two_round_centers(spark, sf)
    return kcenter.nearest_center(pe, centers)


def pairwise_min(spark, sf):
    pe, centers = _two_round_centers(spark, sf)
    return kcenter.pairwise_min(pe, centers[0], centers[1])


def cluster_radius(spark, sf):
    """The radius of the clustering around the iterative centers."""
    pe = _pe(spark, sf)
    return kcenter.radius(pe, kcenter.fft_iterative(pe, P.PE_K))


def fft_outliers(spark, sf):
    pe, centers = _two_round_centers(spark, sf)
    r = kcenter.radius(pe, centers).collect()[0]["radius"]
    return grid.class_summary(pe, float(r), P.PE_FFT_M)


def fft_iterative(spark, sf):
    centers = kcenter.fft_iterative(_pe(spark, sf), P.PE_K)
    return kcenter.centers_frame(spark, centers)


# ---------------------------------------------------------------- frequent items

def stream_prefix(spark, sf):
    return frequent.prefix(_ev(spark, sf), _n_prefix(spark, sf))


def item_counts(spark, sf):
    return frequent.item_counts(_ev(spark, sf))


def frequent_exact(spark, sf):
    return frequent.frequent_exact(_ev(spark, sf), _n(spark, sf), P.EV_PHI)


def frequent_sorted(spark, sf):
    return frequent.frequent_sorted(_ev(spark, sf), _n(spark, sf), P.EV_PHI)


def exact_table_size(spark, sf):
    return frequent.exact_table_size(_ev(spark, sf), _n(spark, sf), P.EV_PHI)


def random_coin(spark, sf):
    _, p = frequent.sticky_rate(_n(spark, sf), P.EV_PHI, P.EV_EPSILON, P.EV_DELTA)
    return frequent.random_coin(_ev(spark, sf), p, P.EV_SEED)


def reservoir_sample(spark, sf):
    return frequent.reservoir_sample(_ev(spark, sf), P.EV_PHI, P.EV_SEED)


def sample_to_table(spark, sf):
    return frequent.sample_counts(reservoir_sample(spark, sf))


def reservoir_distinct(spark, sf):
    return frequent.reservoir_distinct(reservoir_sample(spark, sf))


def reservoir_flagged(spark, sf):
    ev, n = _ev(spark, sf), _n(spark, sf)
    sample = frequent.reservoir_distinct(frequent.reservoir_sample(ev, P.EV_PHI, P.EV_SEED))
    return frequent.flag_true(sample, frequent.frequent_exact(ev, n, P.EV_PHI))


def _sticky(spark, sf):
    ev, n = _ev(spark, sf), _n(spark, sf)
    table = frequent.sticky_table(ev, n, P.EV_PHI, P.EV_EPSILON, P.EV_DELTA, P.EV_SEED)
    return ev, n, table


def sticky_sample(spark, sf):
    return _sticky(spark, sf)[2]


def sticky_report(spark, sf):
    _, n, table = _sticky(spark, sf)
    return frequent.sticky_report(table, n, P.EV_PHI, P.EV_EPSILON)


def sticky_flagged(spark, sf):
    ev, n, table = _sticky(spark, sf)
    rep = frequent.sticky_report(table, n, P.EV_PHI, P.EV_EPSILON)
    return frequent.flag_true(rep, frequent.frequent_exact(ev, n, P.EV_PHI))


def false_positives(spark, sf):
    ev, n, table = _sticky(spark, sf)
    rep = frequent.sticky_report(table, n, P.EV_PHI, P.EV_EPSILON)
    return frequent.false_positives(rep, frequent.frequent_exact(ev, n, P.EV_PHI))


def true_frequent_hit(spark, sf):
    ev, n, table = _sticky(spark, sf)
    rep = frequent.sticky_report(table, n, P.EV_PHI, P.EV_EPSILON)
    return frequent.true_hits(rep, frequent.frequent_exact(ev, n, P.EV_PHI))


def distinct_items(spark, sf):
    return frequent.distinct_items(_ev(spark, sf))


def largest_item(spark, sf):
    return frequent.largest_item(_ev(spark, sf))


def frequent_report(spark, sf):
    return frequent.frequent_report(_ev(spark, sf), _n(spark, sf), P.EV_PHI, P.EV_EPSILON,
                                    P.EV_DELTA, P.EV_SEED)


# ---------------------------------------------------------------- streams

def stream_item_counts(spark, sf):
    return fs.stream_item_counts(spark, fs.item_stream(spark, sf))


def stream_reservoir(spark, sf):
    return fs.stream_reservoir(spark, fs.item_stream(spark, sf), P.EV_PHI, P.EV_SEED)


def stream_sticky(spark, sf):
    return fs.stream_sticky(spark, fs.item_stream(spark, sf), _n(spark, sf), P.EV_PHI,
                            P.EV_EPSILON, P.EV_DELTA, P.EV_SEED)


def stream_distinct(spark, sf):
    return fs.stream_distinct(spark, fs.item_stream(spark, sf))


def stream_frequent_report(spark, sf):
    return fs.stream_frequent_report(spark, fs.item_stream(spark, sf), _n(spark, sf),
                                     P.EV_PHI, P.EV_EPSILON, P.EV_DELTA, P.EV_SEED)


def stream_line_report(spark, sf):
    """S5 from text lines: the items of ``events`` in arrival order, one number a line."""
    lines = _lines_written(spark, sf, "stream-lines")
    return fs.stream_frequent_report(spark, fs.line_stream(spark, lines), _n(spark, sf),
                                     P.EV_PHI, P.EV_EPSILON, P.EV_DELTA, P.EV_SEED)


def _lines_written(spark, sf, name):
    """The items of ``events`` as a folder of lines in arrival order."""
    lines = shared_dir(spark, name)
    (_ev(spark, sf).repartitionByRange("seq").sortWithinPartitions("seq")
     .select(F.col("item").cast("string")).write.text(lines))
    return lines


def stream_source_report(spark, sf):
    """S5 from the package's own line source."""
    lines = _lines_written(spark, sf, "stream-source")
    return fs.stream_frequent_report(spark, line_source(spark, lines), _n(spark, sf),
                                     P.EV_PHI, P.EV_EPSILON, P.EV_DELTA, P.EV_SEED)


def stream_counts_state(spark, sf):
    return ss.stream_counts_state(spark, fs.item_stream(spark, sf))


def stream_distinct_state(spark, sf):
    return ss.stream_distinct_state(spark, fs.item_stream(spark, sf))


def stream_sticky_state(spark, sf):
    return ss.stream_sticky_state(spark, fs.item_stream(spark, sf), _n(spark, sf), P.EV_PHI,
                                  P.EV_EPSILON, P.EV_DELTA, P.EV_SEED)


def stream_batch_sizes_observed(spark, sf):
    """S8 by observed metrics: the rows of all batches, and whether any was seen twice."""
    sizes = fs.stream_batch_sizes_observed(spark, fs.item_stream(spark, sf, max_files_per_trigger=1))
    return sizes.agg(F.sum("rows").alias("rows"), (F.count("batch_id") - F.count_distinct("batch_id")).alias("repeated"))


def stream_batch_sizes(spark, sf):
    """S8 in a form that does not depend on the cut: the rows of all batches, and whether any was seen twice."""
    sizes = fs.stream_batch_sizes(spark, fs.item_stream(spark, sf, max_files_per_trigger=1))
    return sizes.agg(F.sum("rows").alias("rows"), (F.count("batch_id") - F.count_distinct("batch_id")).alias("repeated"))


def stop_after_items(spark, sf):
    """S6 in a form that does not depend on the cut: n, whether n rows went through, and the
    batches that ran although those before them had n rows already."""
    n = _n_prefix(spark, sf)
    sizes = fs.stream_until(spark, fs.item_stream(spark, sf, max_files_per_trigger=1), n)
    before = F.sum("rows").over(Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1))   # a row per batch
    return sizes.withColumn("before", F.coalesce(before, F.lit(0))).agg(
        F.lit(n).cast("long").alias("n"), (F.sum("rows") >= n).alias("reached"),
        F.count_if(F.col("before") >= n).alias("batches_after"))


QUERIES: dict[str, Query] = {
    # sources
    "points_csv_scan": points_csv_scan,
    "points_repartition": points_repartition,
    "points_count": points_count,
    "stream_items_scan": stream_items_scan,
    "sample_to_table": sample_to_table,
    # grid
    "grid_assign": grid_assign,
    "grid_expand_3": grid_expand_3,
    "grid_expand_7": grid_expand_7,
    "grid_classify": grid_classify,
    "outlier_points": outlier_points,
    "grid_merge": grid_merge,
    "cell_counts": cell_counts,
    "square3_counts": square3_counts,
    "square7_counts": square7_counts,
    "class_summary": class_summary,
    "class_cells": class_cells,
    "smallest_cells_topk": smallest_cells_topk,
    "square_union": square_union,
    # exact
    "exact_outliers_theta": exact_outliers_theta,
    "exact_outliers_grid": exact_outliers_grid,
    "ball_counts": ball_counts,
    "exact_outliers_topk": exact_outliers_topk,
    "ball_counts_columns": ball_counts_columns,
    "exact_outliers_columns": exact_outliers_columns,
    "point_distance_columns": point_distance_columns,
    # k-center
    "point_distance": point_distance,
    "nearest_center_distance": nearest_center_distance,
    "pairwise_min": pairwise_min,
    "center_cross_join": center_cross_join,
    "cluster_radius": cluster_radius,
    "farthest_point": farthest_point,
    "fft_coreset": fft_coreset,
    "fft_centers": fft_centers,
    "fft_radius": fft_radius,
    "fft_radius_orders": fft_radius_orders,
    "fft_radius_orders_k100": fft_radius_orders_k100,
    "fft_doubling": fft_doubling,
    "fft_outliers": fft_outliers,
    "fft_iterative": fft_iterative,
    # frequent items
    "stream_prefix": stream_prefix,
    "random_coin": random_coin,
    "item_counts": item_counts,
    "frequent_exact": frequent_exact,
    "frequent_sorted": frequent_sorted,
    "exact_table_size": exact_table_size,
    "distinct_items": distinct_items,
    "largest_item": largest_item,
    "reservoir_sample": reservoir_sample,
    "reservoir_distinct": reservoir_distinct,
    "reservoir_flagged": reservoir_flagged,
    "sticky_sample": sticky_sample,
    "sticky_report": sticky_report,
    "sticky_flagged": sticky_flagged,
    "false_positives": false_positives,
    "true_frequent_hit": true_frequent_hit,
    "frequent_report": frequent_report,
    # streams
    "stream_item_counts": stream_item_counts,
    "stream_reservoir": stream_reservoir,
    "stream_sticky": stream_sticky,
    "stream_distinct": stream_distinct,
    "stream_frequent_report": stream_frequent_report,
    "stream_line_report": stream_line_report,
    "stream_source_report": stream_source_report,
    "stream_counts_state": stream_counts_state,
    "stream_distinct_state": stream_distinct_state,
    "stream_sticky_state": stream_sticky_state,
    "stream_batch_sizes_observed": stream_batch_sizes_observed,
    "stream_batch_sizes": stream_batch_sizes,
    "stop_after_items": stop_after_items,
}
