"""Consecutive row numbers, and running totals, without a window over all rows.

``numbered`` deals the rows by ranges of the order, sorts each range where it is,
counts each range's rows, adds up the counts of the ranges before it and adds the
sum to the rows' own places. So no task sees more than its range, however large
the table or a group is; only one row for each range (and group) is summed in
order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ouzel.session import shared_dir, written


def in_ranges(df: DataFrame, keys: Sequence[str | Column], at: str, name: str) -> DataFrame:
    """``df`` sorted in ranges of ``keys`` and stored; ``at`` is the range's number times 2^33 plus the place in it."""
    tie = f"{at}_tie"
    keys = [F.col(f"`{c}`") if isinstance(c, str) else c for c in keys]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
    return written(dealt.drop(tie).withColumn(at, F.monotonically_increasing_id()), shared_dir(df.sparkSession, name))


def numbered(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), out: str = "number", first: int = 0,
             size: str | None = None) -> DataFrame:
    """``df`` with the column ``out``: ``first``, ``first`` + 1, ... in ``order``, anew in each group of ``by``
    (nulls are a group); and, if asked for, the rows of the group as ``size``.

    Rows that are equal in the whole order get different numbers: their places in
    ``df`` decide, which also spreads a large group of ties over the ranges. For this
    ``df`` should be a stored table, so that a task that is run again sees its rows
    in the same places.
    """
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    at, part, shift, total = (prefix + n for n in ("at", "part", "shift", "total"))
    rows = in_ranges(df, [*by, *order], at, "numbered").withColumn(part, F.shiftright(at, 33))

    own = [F.col(f"`{c}`").alias(f"{prefix}by_{k}") for k, c in enumerate(by)]
    group = [f"{prefix}by_{k}" for k in range(len(by))]
    counts = rows.groupBy(*own, F.col(part)).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("least"))
    whole = Window.partitionBy(*group)                      # a row for each range that the group reaches into
    starts = counts.select(*group, F.col(part).alias(f"{part}_"),
                           (F.sum("n").over(whole.orderBy(part)) - F.col("n") - F.col("least") + F.lit(first)).alias(shift),
                           F.sum("n").over(whole).alias(total))
    same = F.col(part) == F.col(f"{part}_")
    for c, g in zip(by, group):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(g))
    found = rows.join(starts, same)
    extra = [F.col(total).alias(size)] if size else []
    return found.select(*[F.col(f"`{c}`") for c in df.columns if c not in (out, size)], (F.col(at) + F.col(shift)).alias(out), *extra)


def running(df: DataFrame, order: Sequence[str | Column], weight: str, out: str = "before") -> DataFrame:
    """``df``, a stored table, with the column ``out``: the sum of ``weight`` over the rows before, in ``order``; of ties those
    that stand earlier in ``df`` come first. Summed within ranges of the order, and from range to range."""
    at, part, shift = (f"{out}_{n}" for n in ("at", "part", "shift"))
    rows = in_ranges(df, order, at, "running").withColumn(part, F.shiftright(at, 33))
    own = F.sum(weight).over(Window.partitionBy(part).orderBy(at))
    sums = rows.groupBy(F.col(part).alias(f"{part}_")).agg(F.sum(weight).alias("total"))
    starts = sums.select(f"{part}_", (F.sum("total").over(Window.orderBy(f"{part}_")) - F.col("total")).alias(shift))   # a row a range
    return (rows.withColumn(out, own - F.col(f"`{weight}`")).join(starts, F.col(part) == F.col(f"{part}_"))
            .select(*[F.col(f"`{c}`") for c in df.columns if c != out], (F.col(out) + F.col(shift)).alias(out)))
