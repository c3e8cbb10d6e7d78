"""Broadcast and shuffle joins (AQE's choice, by measured size) give the same answers,
and no query leaves a cached table behind."""

import numpy as np
import pytest

from ouzel.operators import exact, frequent
from ouzel.plans.registry import QUERIES
from ouzel.sources.points import items_from_events

SF = "/root/testdata/sf0.01"


def _dense(spark):
    rng = np.random.default_rng(3)
    xy = np.vstack([rng.normal(0.0, 0.15, size=(200, 2)), rng.uniform(-3, 3, size=(150, 2)),
                    np.full((20, 2), 0.05)])
    return spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(xy)],
                                 "id long, x double, y double")


def test_shuffle_joins_give_the_same_answers(spark):
    pts = _dense(spark)
    ev = items_from_events(spark, SF)
    n = frequent.stream_length(ev)

    def run():
        out = {r.id: r.ball for r in exact.exact_outliers_grid(pts, 0.4, 40, open_rows=4).collect()}
        balls = {r.id: r.ball for r in exact.ball_counts(pts, 0.4, open_rows=4).collect()}
        sticky = {r.item: (r.entry, r["count"])
                  for r in frequent.sticky_table(ev, n, 0.015, 0.01, 0.1, 42).collect()}
        return out, balls, sticky

    broadcast = run()
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        shuffled = run()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert shuffled == broadcast
    assert len(broadcast[0]) > 0 and len(broadcast[2]) > 0


@pytest.mark.parametrize("key", ["exact_outliers_grid", "exact_outliers_theta", "ball_counts", "sticky_sample",
                                 "fft_iterative", "stream_sticky", "stream_frequent_report"])
def test_no_cached_table_is_left(spark, key):
    persistent = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = persistent()
    QUERIES[key](spark, "/root/testdata/sf0.001").count()
    assert persistent() == before
