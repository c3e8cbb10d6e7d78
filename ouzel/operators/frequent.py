"""Frequent items of a stream held as a table ``seq, item``.

``seq`` is the arrival order; it may have gaps, repeat or be negative, and rows
without one arrive last. All rows count: ``n``, the length of the stream, is a
parameter of the thresholds and rates only. ``prefix`` cuts a stream to its first
``n`` arrivals, by their numbers, not by the values of ``seq``.

* exact: count per item; frequent when ``count >= n * phi``.
* reservoir: a uniform sample of ``m = ceil(1/phi)`` arrivals, taken as the
  ``m`` arrivals with the smallest seeded random priority (bottom-m). That
  is the distribution of reservoir sampling, and it is mergeable: every
  partition keeps its own bottom-m and the merge keeps the bottom-m of
  those (``TakeOrderedAndProject``), so no arrival order is needed.
* sticky: ``r = ln(1/(delta*phi))/epsilon``, ``p = r/n``. An untracked item
  enters the table with probability ``p`` at each arrival, and then counts
  every later arrival. So an item's entry is its first arrival whose coin
  came up, and its count is the number of its arrivals from there on.
  Reported when ``count >= (phi - epsilon) * n``.

Coins and priorities are md5 draws of ``seed:seq`` (``ouzel.functions.random``), of the
empty text for rows without ``seq``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouzel.functions.random import HEX_DIGITS, coin, draw_hex
from ouzel.operators.numbering import numbered


def stream_length(items: DataFrame, num: int = 1, den: int = 1) -> int:
    """n as a fraction ``num/den`` of the rows (all of them by default)."""
    return items.count() * num // den


def reservoir_size(phi: float) -> int:
    """m = ceil(1/phi)."""
    return int(math.ceil(1 / phi))


def sticky_rate(n: int, phi: float, epsilon: float, delta: float) -> tuple[float, float]:
    """(r, p) of sticky sampling."""
    r = math.log(1 / (delta * phi)) / epsilon
    return r, r / n


def arrivals(items: DataFrame, out: str = "arrival") -> DataFrame:
    """``items`` with the number of each arrival, 0, 1, ...: by ``seq`` (rows without one last), then ``item``.

    The numbers come from ranges of the order and their counts (``numbered``), so
    ids need not be dense and no task sees more than its range.
    """
    return numbered(items, [F.col("seq").asc_nulls_last(), F.col("item").asc_nulls_last()], out=out)


def prefix(items: DataFrame, n: int) -> DataFrame:
    """The first n arrivals, exactly n rows if there are as many -> ``seq, item``."""
    return arrivals(items.select("seq", "item")).where(F.col("arrival") < F.lit(n)).drop("arrival")


def arrives_by(entry: Column | str) -> Column:
    """Whether a row counts for an item that is tracked from ``entry`` on."""
    entry = F.col(entry) if isinstance(entry, str) else entry
    return F.col("seq").isNull() | (F.col("seq") >= entry)


def item_counts(items: DataFrame) -> DataFrame:
    """Count per item -> ``item, count``."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("count"))


def frequent_exact(items: DataFrame, n: int, phi: float) -> DataFrame:
    """Items with ``count >= n*phi`` -> ``item, count`` (at most 1/phi rows)."""
    return item_counts(items).where(F.col("count") >= F.lit(float(n * phi)))


def frequent_sorted(items: DataFrame, n: int, phi: float) -> DataFrame:
    """The true frequent items in ascending order."""
    return frequent_exact(items, n, phi).orderBy("item")


def exact_table_size(items: DataFrame, n: int, phi: float) -> DataFrame:
    """Tracked items and frequent items -> ``items, frequent``."""
    return (item_counts(items)
            .agg(F.count(F.lit(1)).alias("items"),
                 F.count_if(F.col("count") >= F.lit(float(n * phi))).alias("frequent")))


def random_coin(items: DataFrame, p: float, seed: int) -> DataFrame:
    """The per-arrival draw and coin -> ``seq, item, draw, pass``."""
    return items.select(
        "seq", "item",
        F.substring(draw_hex("seq", seed), 1, HEX_DIGITS).alias("draw"),
        coin("seq", seed, p).alias("pass"))


def reservoir_sample(items: DataFrame, phi: float, seed: int) -> DataFrame:
    """uniform sample of m arrivals -> ``seq, item, pri``."""
    return drawn(items, seed).orderBy("pri", "seq", "item").limit(reservoir_size(phi))


def drawn(items: DataFrame, seed: int) -> DataFrame:
    """The priority of each arrival -> ``seq, item, pri``."""
    return items.select("seq", "item", draw_hex("seq", seed).alias("pri"))


def sample_counts(sample: DataFrame) -> DataFrame:
    """The sample as a table, one row per sampled item -> ``item, in_sample``."""
    return sample.groupBy("item").agg(F.count(F.lit(1)).alias("in_sample"))


def reservoir_distinct(sample: DataFrame) -> DataFrame:
    """Distinct items of the sample."""
    return sample.select("item").distinct()


def sticky_table(items: DataFrame, n: int, phi: float, epsilon: float, delta: float,
                 seed: int) -> DataFrame:
    """the sticky hash table -> ``item, entry, count``.

    Entries come from the arrivals whose coin came up (about ``r`` rows):
    one aggregate gives each item's first such arrival. AQE joins it from its
    measured size: map-side while it is small, else by a shuffle whose hot
    items it splits; the count then combines map-side.
    """
    _, p = sticky_rate(n, phi, epsilon, delta)
    entries = (items.where(coin("seq", seed, p))
               .groupBy("item").agg(F.min("seq").alias("entry")))
    joined = items.select("seq", "item").join(entries, ["item"])
    return (joined.where(arrives_by("entry"))
            .groupBy("item").agg(F.min("entry").alias("entry"), F.count(F.lit(1)).alias("count")))


def sticky_report(table: DataFrame, n: int, phi: float, epsilon: float) -> DataFrame:
    """Sticky items with ``count >= (phi - epsilon) * n`` -> ``item, count``."""
    return (table.where(F.col("count") >= F.lit(float((phi - epsilon) * n)))
            .select("item", "count"))


def flag_true(estimated: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``is_true`` (the item is truly frequent)."""
    t = truth.select("item", F.lit(True).alias("_t"))
    return (estimated.join(t, ["item"], "left")
            .withColumn("is_true", F.col("_t").isNotNull()).drop("_t"))


def false_positives(estimated: DataFrame, truth: DataFrame) -> DataFrame:
    """Estimated items that are not truly frequent (``-``)."""
    return estimated.join(truth.select("item"), ["item"], "left_anti")


def true_hits(estimated: DataFrame, truth: DataFrame) -> DataFrame:
    """Estimated items that are truly frequent (``+``)."""
    return estimated.join(truth.select("item"), ["item"], "left_semi")


def distinct_items(items: DataFrame) -> DataFrame:
    """Arrivals, distinct items and the largest item."""
    return items.agg(F.count(F.lit(1)).alias("items_total"),
                     F.count_distinct("item").alias("distinct_items"),
                     F.max("item").alias("largest_item"))


def largest_item(items: DataFrame) -> DataFrame:
    """E5: the largest item (NULL for an empty stream)."""
    return items.agg(F.max("item").alias("largest_item"))


def frequent_report(items: DataFrame, n: int, phi: float, epsilon: float, delta: float,
                    seed: int) -> DataFrame:
    """exact, reservoir and sticky results side by side.

    ``item, exact_count, in_sample, sticky_count, is_true``; all three inputs
    are small (1/phi, m and the sticky report).
    """
    exact = frequent_exact(items, n, phi).select("item", F.col("count").alias("exact_count"))
    res = sample_counts(reservoir_sample(items, phi, seed))
    sticky = (sticky_report(sticky_table(items, n, phi, epsilon, delta, seed), n, phi, epsilon)
              .select("item", F.col("count").alias("sticky_count")))
    return (exact.join(res, ["item"], "full_outer").join(sticky, ["item"], "full_outer")
            .withColumn("is_true", F.col("exact_count").isNotNull()))
