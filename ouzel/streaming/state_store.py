"""Frequent items with the state in Spark's state store.

The same results as the operators of ``frequent_stream``, from Spark's own stateful
operators: the state is partitioned by item over the executors, kept with
the checkpoint and restored by a restart; a batch touches the items that it holds.

* ``stream_counts_state``: streaming aggregation in update mode.
* ``stream_distinct_state``: streaming deduplication for the distinct items, and a
  streaming aggregate of one row for their total and the largest.
* ``stream_sticky_state``: arbitrary state, one (entry, count) for each tracked item.

What a batch changes goes to a ``StateTable``, which holds the newest values as a
table with a bounded number of files.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ouzel.functions.random import coin
from ouzel.operators import frequent
from ouzel.session import shared_dir
from ouzel.streaming.frequent_stream import run_stream
from ouzel.streaming.state import StateTable, totals

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need no installed package

PACKED = "item long, passed boolean, entry long, late long, seqs binary"
TRACKED = "item long, entry long, count long"


def stream_counts_state(spark: SparkSession, stream: DataFrame, workdir: str | None = None, trigger: dict | None = None) -> DataFrame:
    """S1 as a streaming aggregate -> ``item, count``."""
    workdir = workdir or shared_dir(spark, "stream-counts-state")
    table = StateTable(spark, f"{workdir}/counts", "item long, count long", totals("item", count="max"))
    counts = stream.groupBy("item").agg(F.count(F.lit(1)).alias("count"))
    run_stream(counts, table.write, f"{workdir}/checkpoint", "update", trigger)
    return table.before()


def stream_distinct_state(spark: SparkSession, stream: DataFrame, workdir: str | None = None, trigger: dict | None = None) -> DataFrame:
    """S4 by streaming deduplication and a running total -> ``items_total, distinct_items, largest_item``."""
    workdir = workdir or shared_dir(spark, "stream-distinct-state")
    new = StateTable(spark, f"{workdir}/new", "distinct_items long", totals(distinct_items="sum"))
    total = StateTable(spark, f"{workdir}/total", "items_total long, largest_item long", totals(items_total="max", largest_item="max"))

    def count_new(items: DataFrame, batch_id: int) -> None:
        new.write(items.agg(F.count(F.lit(1)).alias("distinct_items")), batch_id)

    first = stream.select("item").where(F.col("item").isNotNull()).dropDuplicates(["item"])
    run_stream(first, count_new, f"{workdir}/checkpoint-new", "append", trigger)
    whole = stream.agg(F.count(F.lit(1)).alias("items_total"), F.max("item").alias("largest_item"))
    run_stream(whole, total.write, f"{workdir}/checkpoint-total", "update", trigger)
    n = new.before().agg(F.coalesce(F.sum("distinct_items"), F.lit(0)).alias("distinct_items"))
    t = total.before().agg(F.coalesce(F.max("items_total"), F.lit(0)).alias("items_total"), F.max("largest_item").alias("largest_item"))
    return t.select("items_total", n.scalar().alias("distinct_items"), "largest_item")


def _packed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (item, seq, pass) -> a row for each item of a batch: whether a coin came up, the least ``seq`` whose did, the
    rows without ``seq``, and the others' as packed numbers. So a hot item is a few rows for each task."""
    for b in it:
        item, ok = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False).astype(bool)
        late = np.asarray(b.column(1).is_null())
        seq = b.column(1).fill_null(0).to_numpy()
        order = np.argsort(item, kind="stable")
        cut = np.flatnonzero(np.diff(item[order])) + 1
        rows = []
        for at in np.split(order, cut) if len(order) else []:
            there, up = at[~late[at]], at[ok[at] & ~late[at]]
            rows.append((int(item[at[0]]), bool(ok[at].any()), int(seq[up].min()) if len(up) else None, int(late[at].sum()),
                         seq[there].astype("<i8").tobytes()))
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 5, (
            pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))], names=["item", "passed", "entry", "late", "seqs"])


def _track(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """An item that is tracked counts its arrivals from its entry on; another enters at the first whose coin came up."""
    rows = [r for c in chunks for r in c.itertuples(index=False)]
    if state.exists:
        entry, count = state.get
    elif any(r.passed for r in rows):
        entry, count = min((int(r.entry) for r in rows if not pd.isna(r.entry)), default=None), 0
    else:
        return
    for r in rows:
        count += int(r.late)
        if entry is not None:
            count += int((np.frombuffer(r.seqs, "<i8") >= entry).sum())
    state.update((entry, count))
    yield pd.DataFrame({"item": [key[0]], "entry": pd.array([entry], "Int64"), "count": [count]})


def stream_sticky_state(spark: SparkSession, stream: DataFrame, n: int, phi: float, epsilon: float, delta: float, seed: int,
                        workdir: str | None = None, trigger: dict | None = None) -> DataFrame:
    """S3 with one state value for each tracked item -> ``item, entry, count``. Arrivals come in ``seq`` order across batches."""
    workdir = workdir or shared_dir(spark, "stream-sticky-state")
    table = StateTable(spark, f"{workdir}/table", TRACKED, totals("item", entry="min", count="max"))
    _, p = frequent.sticky_rate(n, phi, epsilon, delta)
    drawn = stream.where(F.col("item").isNotNull()).select("item", "seq", coin("seq", seed, p).alias("pass"))
    tracked = (drawn.mapInArrow(_packed, PACKED).groupBy("item")
               .applyInPandasWithState(_track, TRACKED, "entry long, count long", "update", GroupStateTimeout.NoTimeout))
    run_stream(tracked, table.write, f"{workdir}/checkpoint", "update", trigger)
    return table.before()
