"""Batches of running queries, as Spark reports them.

``Batches`` is a ``StreamingQueryListener``: Spark calls it after each batch, so no
batch is missed however many there are (a query itself remembers only its last hundred).
"""

from __future__ import annotations

import threading
import time
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Batches(StreamingQueryListener):
    """Rows per batch of every run, from the input or, with ``metric``, from an observed count ``rows`` of that name."""

    def __init__(self, metric: str | None = None):
        self.metric, self.rows, self.ended, self.changed = metric, {}, set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.metric:
            seen = p.observedMetrics.get(self.metric)
            n = seen["rows"] if seen is not None else 0
        else:
            n = p.numInputRows
        with self.changed:
            self.rows.setdefault(str(p.runId), {})[p.batchId] = int(n)
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, run: str) -> dict[int, int]:
        """Rows by batch of a run so far."""
        with self.changed:
            return dict(self.rows.get(run, {}))

    def wait(self, run: str, n: int | None = None, timeout: float = 600.0, also: dict[int, int] | None = None) -> int:
        """Waits until at least ``n`` rows went through (if given), the run has ended or the time is over; returns the rows.
        ``also``: batches that were over before this listener was there."""
        end = time.monotonic() + timeout
        with self.changed:
            while True:
                rows = sum(((also or {}) | self.rows.get(run, {})).values())
                left = end - time.monotonic()
                if (n is not None and rows >= n) or run in self.ended or left <= 0:
                    return rows
                self.changed.wait(left)


@contextmanager
def listening(spark: SparkSession, metric: str | None = None):
    """A ``Batches`` for the time of the block."""
    batches = Batches(metric)
    spark.streams.addListener(batches)
    try:
        yield batches
    finally:
        spark.streams.removeListener(batches)
