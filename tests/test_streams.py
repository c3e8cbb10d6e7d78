"""Streams: several batches equal the batch answer; a restart continues."""

import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ouzel.operators import frequent
from ouzel.sources.points import items_from_event_rows, items_from_events
from ouzel.session import shared_dir
from ouzel.streaming import frequent_stream as fs
from ouzel.streaming.state import StateTable, totals

SF = "/root/testdata/sf0.01"
N, PHI, EPS, DELTA, SEED = 8000, 0.015, 0.01, 0.1, 42


def write_parts(folder, parts, start=0):
    t = pq.read_table(f"{SF}/events.parquet")
    rows = t.num_rows
    step = (rows + 3) // 4
    for k in parts:
        pq.write_table(t.slice(k * step, step), os.path.join(folder, f"events_{k}.parquet"))
        time.sleep(1.1)   # file order of the source follows modification time


@pytest.fixture(scope="module")
def four_files(tmp_path_factory):
    d = tmp_path_factory.mktemp("ev4")
    write_parts(str(d), range(4))
    return str(d)


@pytest.fixture(scope="module")
def batch(spark):
    return items_from_events(spark, SF)


@pytest.fixture(scope="module")
def gaps(spark, tmp_path_factory):
    """Items with ids 1, 3, 5, ... and some without, in two files."""
    d = str(tmp_path_factory.mktemp("gaps"))
    t = pq.read_table(f"{SF}/events.parquet").to_pandas()
    t["event_id"] = (2 * t.event_id + 1).where(t.event_id < 9000).astype("Int64")
    for k in range(2):
        t.iloc[k * 5000:(k + 1) * 5000].to_parquet(os.path.join(d, f"events_{k}.parquet"))
        time.sleep(1.1)
    return d


def test_ids_with_gaps_give_all_rows(spark, gaps, tmp_path):
    rows = fs.item_stream(spark, gaps, 1)
    batch = items_from_event_rows(spark.read.parquet(gaps))
    assert batch.where("seq is null").count() == 1000
    counts = fs.stream_item_counts(spark, rows, str(tmp_path / "c"))
    assert as_dict(counts, "item", "count") == as_dict(frequent.item_counts(batch), "item", "count")
    table = fs.stream_sticky(spark, rows, 10_000, PHI, EPS, DELTA, SEED, str(tmp_path / "s"))
    want = frequent.sticky_table(batch, 10_000, PHI, EPS, DELTA, SEED)
    assert as_dict(table, "item", "count") == as_dict(want, "item", "count")


def as_dict(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def test_counts_four_batches(spark, four_files, batch, tmp_path):
    got = fs.stream_item_counts(spark, fs.item_stream(spark, four_files, 1), str(tmp_path / "w"))
    assert as_dict(got, "item", "count") == as_dict(frequent.item_counts(batch), "item", "count")
    sizes = fs.stream_batch_sizes(spark, fs.item_stream(spark, four_files, 1), str(tmp_path / "b"))
    assert sizes.count() == 4 and sizes.agg(F.sum("rows")).collect()[0][0] == 10000


def test_reservoir_four_batches(spark, four_files, batch, tmp_path):
    got = fs.stream_reservoir(spark, fs.item_stream(spark, four_files, 1), PHI, SEED, str(tmp_path / "w"))
    exp = frequent.reservoir_sample(batch, PHI, SEED)
    assert sorted(tuple(r) for r in got.select("seq", "item", "pri").collect()) == \
        sorted(tuple(r) for r in exp.select("seq", "item", "pri").collect())


def test_sticky_four_batches(spark, four_files, batch, tmp_path):
    got = fs.stream_sticky(spark, fs.item_stream(spark, four_files, 1), N, PHI, EPS, DELTA, SEED,
                           str(tmp_path / "w"))
    exp = frequent.sticky_table(batch, N, PHI, EPS, DELTA, SEED)
    assert sorted(tuple(r) for r in got.select("item", "entry", "count").collect()) == \
        sorted(tuple(r) for r in exp.select("item", "entry", "count").collect())


def test_distinct_four_batches(spark, four_files, batch, tmp_path):
    got = fs.stream_distinct(spark, fs.item_stream(spark, four_files, 1), str(tmp_path / "w")).collect()[0]
    exp = frequent.distinct_items(batch).collect()[0]
    assert (got.items_total, got.distinct_items, got.largest_item) == \
        (exp.items_total, exp.distinct_items, exp.largest_item)


def test_restart_from_checkpoint(spark, batch, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    work = str(tmp_path / "w")
    write_parts(str(src), [0, 1])
    fs.stream_sticky(spark, fs.item_stream(spark, str(src), 1), N, PHI, EPS, DELTA, SEED, work)
    fs.stream_item_counts(spark, fs.item_stream(spark, str(src), 1), work + "-c")
    write_parts(str(src), [2, 3])
    got = fs.stream_sticky(spark, fs.item_stream(spark, str(src), 1), N, PHI, EPS, DELTA, SEED, work)
    exp = frequent.sticky_table(batch, N, PHI, EPS, DELTA, SEED)
    assert sorted(tuple(r) for r in got.select("item", "entry", "count").collect()) == \
        sorted(tuple(r) for r in exp.select("item", "entry", "count").collect())
    counts = fs.stream_item_counts(spark, fs.item_stream(spark, str(src), 1), work + "-c")
    assert as_dict(counts, "item", "count") == as_dict(frequent.item_counts(batch), "item", "count")


def test_stop_after_items(spark, four_files, tmp_path):
    sizes = fs.stream_until(spark, fs.item_stream(spark, four_files, 1), 5000, str(tmp_path / "w"))
    total = sizes.agg(F.sum("rows")).collect()[0][0]
    assert total >= 5000


def test_stop_raises_when_the_stream_is_short(spark, four_files, tmp_path):
    with pytest.raises(TimeoutError, match="10000 of 20000"):
        fs.stream_until(spark, fs.item_stream(spark, four_files), 20_000, str(tmp_path / "w"), timeout_seconds=8)


def test_stop_raises_when_a_batch_fails(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.txt").write_text("1\n2\nthree\n")
    bad = fs.line_stream(spark, str(src)).select(F.col("value").cast("bigint").alias("item"))
    out = str(tmp_path / "out")
    q = (bad.writeStream.option("checkpointLocation", str(tmp_path / "c"))
         .foreachBatch(lambda df, k: df.write.mode("overwrite").parquet(out)).start())
    with pytest.raises(RuntimeError, match="failed"):
        fs.stop_after_items(q, 3, timeout_seconds=60)


def test_lines_in_one_pass_with_a_restart(spark, batch, tmp_path):
    """Bare numbers, numbered as they arrive over two runs, give the batch report."""
    src, work = tmp_path / "src", str(tmp_path / "w")
    src.mkdir()
    items = [r.item for r in batch.orderBy("seq").collect()]

    def run(k):
        (src / f"part{k}.txt").write_text("".join(f"{i}\n" for i in items[k * 2500:(k + 1) * 2500]))
        time.sleep(1.1)
        return fs.stream_frequent_report(spark, fs.line_stream(spark, str(src), 1), len(items), PHI, EPS, DELTA, SEED, work)

    for k in range(4):
        got = run(k)
    exp = frequent.frequent_report(batch, len(items), PHI, EPS, DELTA, SEED)
    rows = lambda df: sorted((tuple(r) for r in df.select("item", "exact_count", "in_sample", "sticky_count", "is_true").collect()), key=str)
    assert rows(got) == rows(exp)


def test_state_keeps_a_bounded_number_of_versions(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "s"), "item long, count long", totals("item", count="sum"), every=3)
    most = 0
    for k in range(20):
        change = spark.createDataFrame([(k % 4, 1)], "item long, count long")
        state.write(change, k)
        if k % 5 == 0:
            state.write(change, k)   # a batch that is replayed
        most = max(most, state.versions())
        assert as_dict(state.before(k + 1), "item", "count") == {i: len(range(i, k + 1, 4)) for i in range(4) if i <= k}
    assert most <= 2 + 2 * 3


def test_no_folder_without_a_setting_on_a_cluster():
    from types import SimpleNamespace as N

    cluster = N(conf=N(get=lambda *a: None), sparkContext=N(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(cluster, "x")
