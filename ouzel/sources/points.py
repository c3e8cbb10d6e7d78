"""Point and item sources.

* ``read_points_text``: a text file with one ``x,y[,...]`` record per line,
  parsed with ``split`` + ANSI casts, so a blank or malformed line fails the
  job, extra columns are kept but ignored, and a one-column line fails.
* ``points_from_orders`` / ``points_from_embeddings`` / ``vectors_from_embeddings`` /
  ``items_from_events``: the standard views over the driver tables (PO, PE, PEC, EV).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def points_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PO: one point per order; x = days since 1995-01-01 / 10, y = price/1000 - 100."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("double")
         / F.lit(10.0)).alias("x"),
        (F.col("o_totalprice") / F.lit(1000.0) - F.lit(100.0)).alias("y"),
    )


def points_from_embeddings(spark: SparkSession, sf_dir: str, L: int = 4) -> DataFrame:
    """PE: the first two embedding coordinates, and bucket ``b = id mod L``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"),
        F.pmod(F.col("vec_id"), F.lit(L)).alias("b"),
    )


def vectors_from_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PEC: the embeddings with all their columns -> ``id, v``."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))


def items_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV: the item stream in arrival order; ``item = floor(value)``."""
    ev = table(spark, sf_dir, "events")
    return items_from_event_rows(ev)


def items_from_event_rows(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("event_id").alias("seq"),
                     F.floor(F.col("value")).cast("bigint").alias("item"))


def read_points_text(spark: SparkSession, path: str, with_id: bool = True) -> DataFrame:
    """Text lines ``x,y[,...]`` -> ``id, x, y``.

    Parsing uses ANSI casts: a blank line or a non-number raises at run time
    (as the line parser of the original job), a line with one value raises
    on the missing ``y``. ``id`` is unique but not dense (partition offset +
    row number), stable for a given file and split size.
    """
    parts = F.split(F.col("value"), ",")
    df = spark.read.text(path).select(
        parts.getItem(0).cast("double").alias("x"),
        F.element_at(parts, 2).cast("double").alias("y"),
    )
    if with_id:
        df = df.select(F.monotonically_increasing_id().alias("id"), "x", "y")
    return df


def write_points_text(points: DataFrame, path: str) -> None:
    """Write ``x,y`` lines (no header), the input format of ``read_points_text``.

    Doubles are written with Java's shortest round-trip form, so reading
    them back gives the same values.
    """
    (points.select(F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"))
                   .alias("value"))
     .write.mode("overwrite").text(path))
