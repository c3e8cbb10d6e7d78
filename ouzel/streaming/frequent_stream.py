"""Frequent items over a stream (Structured Streaming).

The source is any streaming DataFrame with ``seq bigint, item bigint``
(``item_stream`` reads parquet files), or a line stream with the text column
``value`` (``line_stream`` reads text files; a socket or Kafka source has the same
shape), whose lines are cast to numbers and numbered as they arrive. Each
operator runs one query with a checkpoint in the shared folder and
``trigger(availableNow=True)`` by default, then returns its result as a table read
back from the shared folder (never through the driver).

* ``stream_item_counts``: counts per item, added up batch by batch.
* ``stream_reservoir``: the bottom-m sample merged batch by batch.
* ``stream_sticky``: the sticky table; each batch adds entries from its coin
  arrivals and counts arrivals from the entries on.
* ``stream_frequent_report``: the three methods in one pass over the stream.
* ``stream_distinct``: distinct items, item total and largest item.
* ``stream_batch_sizes``: rows per batch, from a table; ``stream_batch_sizes_observed``: from
  observed metrics.
* ``stop_after_items``: stop a running query once n rows went through.

The states are ``StateTable``s: a batch writes the keys it changes, not the whole
state, and old versions go, so a long stream keeps a bounded number of files. A
batch that is used by several steps is kept for the batch only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ouzel.functions.random import coin
from ouzel.operators import frequent
from ouzel.session import shared_dir
from ouzel.sources.points import items_from_event_rows
from ouzel.streaming.listen import Batches, listening
from ouzel.streaming.state import BatchLog, StateTable, totals

Step = Callable[[DataFrame, int], None]


def item_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None,
                pattern: str = "events*.parquet") -> DataFrame:
    """EV as a stream: parquet files of ``events`` -> ``seq, item``.

    A glob is used because a single-file path is not a valid stream source.
    """
    base = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{base}/{pattern}").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return items_from_event_rows(reader.parquet(f"{base}/{pattern}"))


def line_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files as a stream of lines: ``value``, and where the line's piece of a file starts."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(folder).select("value", F.col("_metadata.file_path").alias("file"),
                                      F.col("_metadata.file_block_start").alias("block"))


def numbered(lines: DataFrame, first: int) -> DataFrame:
    """A batch of lines as ``seq, item``: cast (a bad line fails the batch), numbered from ``first``.

    The order is that of the files' names and the places in them, or, from a source
    without files, that of the batch's partitions; the first number of a piece is
    ``first`` plus the rows of the pieces before it.
    """
    place = F.monotonically_increasing_id()
    part = F.struct("file", "block") if "file" in lines.columns else F.struct(F.shiftright(place, 33).alias("part"))
    rows = lines.select(F.trim("value").cast("bigint").alias("item"), part.alias("part"), place.alias("at"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))   # a row per piece
    starts = (rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least"))
              .select("part", (F.lit(first) + F.coalesce(before, F.lit(0)) - F.col("least")).alias("start")))
    return rows.join(starts, "part").select((F.col("start") + F.col("at")).alias("seq"), "item")


def run_stream(stream: DataFrame, fn: Step, checkpoint: str, output_mode: str = "append", trigger: dict | None = None) -> None:
    writer = (stream.writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint)
              .foreachBatch(fn))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# ------------------------------------------------ the steps of a batch (seq, item)

def _counts(spark: SparkSession, workdir: str) -> tuple[StateTable, Step]:
    state = StateTable(spark, f"{workdir}/counts", "item long, count long", totals("item", count="sum"))

    def step(batch: DataFrame, batch_id: int) -> None:
        state.write(batch.groupBy("item").agg(F.count(F.lit(1)).alias("count")), batch_id)
    return state, step


def _reservoir(spark: SparkSession, workdir: str, phi: float, seed: int) -> tuple[StateTable, Step]:
    m = frequent.reservoir_size(phi)
    state = StateTable(spark, f"{workdir}/sample", "seq long, item long, pri string",
                       lambda rows: rows.orderBy("pri", "seq", "item").limit(m))

    def step(batch: DataFrame, batch_id: int) -> None:
        state.write(frequent.drawn(batch, seed).orderBy("pri", "seq", "item").limit(m), batch_id)
    return state, step


def _sticky(spark: SparkSession, workdir: str, p: float, seed: int) -> tuple[StateTable, Step]:
    state = StateTable(spark, f"{workdir}/table", "item long, entry long, count long",
                       totals("item", entry="min", count="sum"))

    def step(batch: DataFrame, batch_id: int) -> None:
        # an item of an earlier batch counts all its arrivals, a new one those from its entry on
        known = state.before(batch_id).select("item", "entry")
        fresh = (batch.where(coin("seq", seed, p)).groupBy("item").agg(F.min("seq").alias("entry"))
                 .join(known.select("item"), "item", "left_anti"))
        counted = (batch.join(known.unionByName(fresh), "item").where(frequent.arrives_by("entry"))
                   .groupBy("item").agg(F.min("entry").alias("entry"), F.count(F.lit(1)).alias("count")))
        state.write(counted, batch_id)
    return state, step


def _kept(steps: list[Step], prepare: Callable[[DataFrame, int], DataFrame]) -> Step:
    """Runs the steps on one read of the batch, which is dropped at its end."""
    def run(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            batch = prepare(df, batch_id)
            for step in steps:
                step(batch, batch_id)
        finally:
            df.unpersist()
    return run


def _items(df: DataFrame, _: int) -> DataFrame:
    return df.select("seq", "item")


# ------------------------------------------------ operators

def stream_item_counts(spark: SparkSession, stream: DataFrame, workdir: str | None = None,
                       trigger: dict | None = None) -> DataFrame:
    """Exact counts as streaming state -> ``item, count``."""
    workdir = workdir or shared_dir(spark, "stream-counts")
    state, step = _counts(spark, workdir)
    run_stream(stream, step, f"{workdir}/checkpoint", trigger=trigger)
    return state.before()


def stream_reservoir(spark: SparkSession, stream: DataFrame, phi: float, seed: int,
                     workdir: str | None = None, trigger: dict | None = None) -> DataFrame:
    """The reservoir sample kept across batches -> ``seq, item, pri``."""
    workdir = workdir or shared_dir(spark, "stream-reservoir")
    state, step = _reservoir(spark, workdir, phi, seed)
    run_stream(stream, step, f"{workdir}/checkpoint", trigger=trigger)
    return state.before()


def stream_sticky(spark: SparkSession, stream: DataFrame, n: int, phi: float, epsilon: float,
                  delta: float, seed: int, workdir: str | None = None,
                  trigger: dict | None = None) -> DataFrame:
    """S3: the sticky table as keyed state -> ``item, entry, count``.

    Arrivals come in ``seq`` order across batches.
    """
    workdir = workdir or shared_dir(spark, "stream-sticky")
    state, step = _sticky(spark, workdir, frequent.sticky_rate(n, phi, epsilon, delta)[1], seed)
    run_stream(stream, _kept([step], _items), f"{workdir}/checkpoint", trigger=trigger)
    return state.before()


def stream_distinct(spark: SparkSession, stream: DataFrame, workdir: str | None = None,
                    trigger: dict | None = None) -> DataFrame:
    """Distinct items, item total and largest item over the whole stream."""
    counts = stream_item_counts(spark, stream, workdir, trigger)
    return counts.agg(F.sum("count").alias("items_total"),
                      F.count(F.lit(1)).alias("distinct_items"),
                      F.max("item").alias("largest_item"))


def stream_frequent_report(spark: SparkSession, stream: DataFrame, n: int, phi: float, epsilon: float, delta: float,
                           seed: int, workdir: str | None = None, trigger: dict | None = None) -> DataFrame:
    """The three methods side by side, from one pass over ``seq, item`` or over lines (``value``).

    Same columns as ``frequent_report``. Lines are numbered from the count of the
    lines before the batch, which is kept like the other states.
    """
    workdir = workdir or shared_dir(spark, "stream-report")
    counts, count = _counts(spark, workdir)
    sample, draw = _reservoir(spark, workdir, phi, seed)
    sticky, stick = _sticky(spark, workdir, frequent.sticky_rate(n, phi, epsilon, delta)[1], seed)
    seen = StateTable(spark, f"{workdir}/seen", "rows long", totals(rows="sum"))

    def prepare(df: DataFrame, batch_id: int) -> DataFrame:
        if "seq" in df.columns:
            return _items(df, batch_id)
        had = seen.before(batch_id).agg(F.sum("rows")).first()[0] or 0
        seen.write(df.agg(F.count(F.lit(1)).alias("rows")), batch_id)
        return numbered(df, had)

    run_stream(stream, _kept([count, draw, stick], prepare), f"{workdir}/checkpoint", trigger=trigger)
    exact = (counts.before().where(F.col("count") >= F.lit(float(n * phi)))
             .select("item", F.col("count").alias("exact_count")))
    st = (frequent.sticky_report(sticky.before(), n, phi, epsilon)
          .select("item", F.col("count").alias("sticky_count")))
    return (exact.join(frequent.sample_counts(sample.before()), ["item"], "full_outer").join(st, ["item"], "full_outer")
            .withColumn("is_true", F.col("exact_count").isNotNull()))


def stream_batch_sizes(spark: SparkSession, stream: DataFrame, workdir: str | None = None,
                       trigger: dict | None = None) -> DataFrame:
    """Rows of every non-empty batch -> ``batch_id, rows``."""
    workdir = workdir or shared_dir(spark, "stream-batches")
    out = BatchLog(spark, f"{workdir}/sizes", "rows long")

    def step(df: DataFrame, batch_id: int) -> None:
        out.write(df.agg(F.count(F.lit(1)).alias("rows")), batch_id)

    run_stream(stream, step, f"{workdir}/checkpoint", trigger=trigger)
    return out.rows().where(F.col("rows") > 0).select("batch_id", "rows")


def stream_batch_sizes_observed(spark: SparkSession, stream: DataFrame, workdir: str | None = None,
                                trigger: dict | None = None) -> DataFrame:
    """S8 by observed metrics -> ``batch_id, rows`` of the run's non-empty batches.

    The count travels with the batch's own job and comes with its progress: no job and no table for each batch.
    """
    workdir = workdir or shared_dir(spark, "stream-observed")
    seen = stream.observe("arrivals", F.count(F.lit(1)).alias("rows"))
    with listening(spark, "arrivals") as batches:
        q = (seen.writeStream.format("noop").option("checkpointLocation", f"{workdir}/checkpoint")
             .trigger(**(trigger or {"availableNow": True})).start())
        q.awaitTermination()
        batches.wait(str(q.runId))          # the last batch's report may come after the end
        rows = sorted((k, n) for k, n in batches.of(str(q.runId)).items() if n)
    return spark.createDataFrame(rows, "batch_id long, rows long")      # two numbers a batch


def stop_after_items(query, n: int, timeout_seconds: float = 600.0, batches: Batches | None = None) -> int:
    """Stop ``query`` once at least n input rows went through.

    A listener adds up the batches' rows and wakes the calling thread, which stops the query (stopping from inside the
    batch function could deadlock). ``batches``: a listener from before the query's start; without one, the batches
    that are over already are taken from the query, which remembers a hundred. Returns the rows seen. A query that
    fails, ends early or does not get there in time is stopped and raises.
    """
    if batches is None:
        with listening(SparkSession.active()) as own:
            return stop_after_items(query, n, timeout_seconds, own)
    run = str(query.runId)
    before = {p["batchId"]: int(p.get("numInputRows", 0)) for p in query.recentProgress}
    seen = batches.wait(run, n, timeout_seconds, before)
    ended = not query.isActive
    failed = query.exception()
    query.stop()
    if failed is not None:
        raise RuntimeError(f"the stream failed after {seen} rows: {failed}")
    if seen < n:
        raise TimeoutError(f"the stream ended after {seen} of {n} rows" if ended else f"{seen} of {n} rows after {timeout_seconds:g} s")
    return seen


def stream_until(spark: SparkSession, stream: DataFrame, n: int, workdir: str | None = None,
                 timeout_seconds: float = 600.0) -> DataFrame:
    """S6 as a query: run with a processing-time trigger, stop after n rows.

    Returns ``batch_id, rows`` of the batches processed before the stop.
    """
    workdir = workdir or shared_dir(spark, "stream-until")
    out = BatchLog(spark, f"{workdir}/sizes", "rows long")

    def step(df: DataFrame, batch_id: int) -> None:
        out.write(df.agg(F.count(F.lit(1)).alias("rows")), batch_id)

    with listening(spark) as batches:
        q = (stream.writeStream.option("checkpointLocation", f"{workdir}/checkpoint")
             .foreachBatch(step).trigger(processingTime="10 milliseconds").start())
        stop_after_items(q, n, timeout_seconds, batches)
    return out.rows().where(F.col("rows") > 0).select("batch_id", "rows")
