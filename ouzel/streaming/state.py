"""State tables for ``foreachBatch`` operators.

``StateTable`` keeps a keyed state as small changes and, every ``every`` batches, one
full version: batch ``k`` writes only what it changes, below ``changes/batch_id=k``,
and reads the newest full version before ``k`` with the changes since. ``merge`` says
how several rows of a key become one. A batch that is replayed after a failure
reads the same versions and overwrites its own folder, so the result is
exactly-once over an at-least-once sink. What a full version has replaced is
deleted one full version later, so that a replay still finds its input: at most
two full versions and 2 * ``every`` changes are on disk, however long the stream.

``BatchLog`` is the plain output of a stream: the rows of every batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ouzel.session import delete, hadoop_path


def batches_in(spark: SparkSession, path: str) -> list[int]:
    """The ids of the ``batch_id=<k>`` folders, by one listing, without reading data."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(int(n[len("batch_id="):]) for n in names if n.startswith("batch_id="))


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def rows(self) -> DataFrame:
        """All rows with their ``batch_id``."""
        schema = self.schema + ", batch_id long"
        if not batches_in(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)


class StateTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame],
                 every: int = 8):
        self.spark, self.path, self.schema, self.merge, self.every = spark, path, schema, merge, every

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/batch_id={batch_id}"

    def before(self, batch_id: int | None = None) -> DataFrame:
        """The state before batch ``batch_id`` (now, if None)."""
        upto = lambda kind: [k for k in batches_in(self.spark, f"{self.path}/{kind}") if batch_id is None or k < batch_id]
        full = upto("full")[-1:]
        changes = [k for k in upto("changes") if not full or k > full[0]]
        paths = [self._folder("full", k) for k in full] + [self._folder("changes", k) for k in changes]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        return self.merge(rows) if changes else rows

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """What batch ``batch_id`` changes; now and then a full version, and the clearing up."""
        changes.write.mode("overwrite").parquet(self._folder("changes", batch_id))
        if (batch_id + 1) % self.every:
            return
        own = self.spark.read.schema(self.schema).parquet(self._folder("changes", batch_id))
        whole = self.merge(self.before(batch_id).unionByName(own))   # not from a full version of this batch, if it is replayed
        whole.write.mode("overwrite").parquet(self._folder("full", batch_id))
        old = [k for k in batches_in(self.spark, f"{self.path}/full") if k < batch_id]
        for kind, keep in (("full", old[-1:]), ("changes", [])):
            for k in batches_in(self.spark, f"{self.path}/{kind}"):
                if old and k <= old[-1] and k not in keep:
                    delete(self.spark, self._folder(kind, k))

    def versions(self) -> int:
        """Folders on disk."""
        return sum(len(batches_in(self.spark, f"{self.path}/{kind}")) for kind in ("full", "changes"))


def totals(*keys: str, **sums: str) -> Callable[[DataFrame], DataFrame]:
    """Merge by an aggregate for each column: ``totals("item", count="sum")``."""
    return lambda rows: rows.groupBy(*keys).agg(*[getattr(F, how)(c).alias(c) for c, how in sums.items()])
