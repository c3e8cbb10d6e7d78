"""State in Spark's state store, listeners, observed metrics and the line source: equal to the batch answers, also after a restart."""

import json
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ouzel.operators import frequent
from ouzel.sources.lines import LineReader, line_source
from ouzel.sources.points import items_from_event_rows, items_from_events
from ouzel.streaming import frequent_stream as fs
from ouzel.streaming import state_store as ss
from ouzel.streaming.listen import listening

SF = "/root/testdata/sf0.01"
N, PHI, EPS, DELTA, SEED = 10_000, 0.015, 0.01, 0.1, 42


def write_part(folder, k):
    t = pq.read_table(f"{SF}/events.parquet")
    pq.write_table(t.slice(k * 2500, 2500), os.path.join(folder, f"events_{k}.parquet"))
    time.sleep(1.1)   # file order of the source follows modification time


@pytest.fixture(scope="module")
def batch(spark):
    return items_from_events(spark, SF)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_four_batches_with_a_restart(spark, batch, tmp_path):
    """Two files, a restart, two more: counts, distinct items and sticky table equal D8, D10 and F3."""
    src = str(tmp_path)
    work = [str(tmp_path / w) for w in ("wc", "wd", "ws")]
    for parts in ((0, 1), (2, 3)):
        for k in parts:
            write_part(src, k)
        stream = lambda: fs.item_stream(spark, src, 1)
        with listening(spark) as batches:
            counts = ss.stream_counts_state(spark, stream(), work[0])
            distinct = ss.stream_distinct_state(spark, stream(), work[1])
            sticky = ss.stream_sticky_state(spark, stream(), N, PHI, EPS, DELTA, SEED, work[2])
            assert sum(len(batches.of(r)) for r in list(batches.rows)) >= 4
    assert rows(counts, "item", "count") == rows(frequent.item_counts(batch), "item", "count")
    assert tuple(distinct.first()) == tuple(frequent.distinct_items(batch).select("items_total", "distinct_items", "largest_item").first())
    want = frequent.sticky_table(batch, N, PHI, EPS, DELTA, SEED)
    assert rows(sticky, "item", "entry", "count") == rows(want, "item", "entry", "count")


def test_the_state_holds_the_tracked_items_only(spark, batch, tmp_path):
    """One value for each item of the table, read from the checkpoint's state store."""
    work = str(tmp_path / "w")
    got = ss.stream_sticky_state(spark, fs.item_stream(spark, SF), N, PHI, EPS, DELTA, SEED, work)
    state = spark.read.format("statestore").load(f"{work}/checkpoint")
    assert state.count() == got.count() == 151


def test_ids_with_gaps_and_nulls(spark, tmp_path):
    src = str(tmp_path)
    t = pq.read_table(f"{SF}/events.parquet").to_pandas()
    t["event_id"] = (2 * t.event_id + 1).where(t.event_id % 97 > 0).astype("Int64")
    t.loc[t.index % 53 == 0, "value"] = None
    t.to_parquet(os.path.join(src, "events_0.parquet"))
    batch = items_from_event_rows(spark.read.parquet(src))
    want = frequent.sticky_table(batch, N, PHI, EPS, DELTA, SEED)
    got = ss.stream_sticky_state(spark, fs.item_stream(spark, src), N, PHI, EPS, DELTA, SEED, str(tmp_path / "w"))
    assert rows(got, "item", "entry", "count") == rows(want, "item", "entry", "count")
    distinct = ss.stream_distinct_state(spark, fs.item_stream(spark, src), str(tmp_path / "d")).first()
    assert (distinct.items_total, distinct.distinct_items) == (batch.count(), batch.select("item").where("item is not null").distinct().count())


def test_batch_sizes_by_observed_metrics(spark, tmp_path):
    src = str(tmp_path)
    for k in range(3):
        write_part(src, k)
    counted = fs.stream_batch_sizes(spark, fs.item_stream(spark, src, 1), str(tmp_path / "a"))
    observed = fs.stream_batch_sizes_observed(spark, fs.item_stream(spark, src, 1), str(tmp_path / "b"))
    assert rows(observed, "batch_id", "rows") == rows(counted, "batch_id", "rows") == [(0, 2500), (1, 2500), (2, 2500)]


@pytest.mark.parametrize("before,n", [(True, 1200), (False, 200)])
def test_stop_after_more_batches_than_a_query_remembers(spark, tmp_path, before, n):
    """More batches than a query remembers."""
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "10").option("numPartitions", "1").load()
    start = lambda: stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="40 milliseconds").start()
    with listening(spark) as batches:
        q = start()
        seen = fs.stop_after_items(q, n, 120, batches if before else None)
        got = batches.of(str(q.runId))
    assert seen >= n and not q.isActive
    if before:
        assert len(got) >= n // 10 and seen <= sum(got.values())


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_lines_from_a_growing_folder(spark, batch, tmp_path, piece):
    """Files are added and grow between runs, a line is cut in the middle: the report equals the batch report."""
    src, work = tmp_path / "src", str(tmp_path / "w")
    src.mkdir()
    n = 300 if piece < 100 else 10_000
    items = [r.item for r in batch.orderBy("seq").limit(n).collect()]
    first, second, third = (items[a * n // 3:(a + 1) * n // 3] for a in range(3))
    half = len(second) // 2
    text = lambda xs: "".join(f"{i}\n" for i in xs)
    run = lambda: fs.stream_frequent_report(spark, line_source(spark, str(src), piece), n, PHI, EPS, DELTA, SEED, work)
    (src / "a.txt").write_text(text(first))
    (src / "_tmp").write_text("not a number\n")
    cut = text(second[:half])
    (src / "b.txt").write_text(cut + str(second[half]))        # the line's end is not written yet
    run()
    (src / "b.txt").write_text(cut + text(second[half:]))
    run()
    (src / "c.txt").write_text(text(third).replace("\n", "\r\n"))
    got = run()
    again = run()                                              # nothing new
    want = frequent.frequent_report(batch.where(F.col("seq") < n), n, PHI, EPS, DELTA, SEED)
    cols = ("item", "exact_count", "in_sample", "sticky_count", "is_true")
    assert rows(got, *cols) == rows(want, *cols) == rows(again, *cols)


def test_pieces_hold_every_line_once(tmp_path):
    """Any piece size, empty lines, long lines, a file without a last line's end."""
    lines = ["", "a", "", "x" * 50, "é" * 9, "end"]
    (tmp_path / "f").write_bytes("\n".join(lines).encode() + b"\n" + b"open")
    for piece in (1, 2, 3, 10, 64, 1000):
        r = LineReader(str(tmp_path), piece)
        end = json.loads(json.dumps(r.latestOffset()))
        got = [x for p in r.partitions({}, end) for b in r.read(p) for x in b.to_pylist()]
        assert [x["value"] for x in got] == lines
        whole = (tmp_path / "f").read_bytes()
        assert all(whole[x["place"]:].startswith(x["value"].encode() + b"\n") for x in got)
        assert r.latestOffset() == end and r.partitions(end, end) == []
