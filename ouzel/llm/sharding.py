"""Sharding by Karmarkar-Karp differencing: shards of nearly equal bytes, equal texts together.

A group (equal texts) is indivisible. Differencing keeps a heap of partial partitions,
each a row of ``shards`` sums in falling order; at first one for each item, with all its
bytes in the first place. The two with the largest spread are combined, one in the
opposite order of the other, so that large sums meet small ones; what all places have
in common is dropped. When one is left, the combinations are walked back to give
every item its place.

Groups are summed by Spark (with map-side sums, so a group of a third of all rows is a row
for each task). One pass in one task differences at most 2 * ``shards`` * ``fine`` items, however
many groups there are: a group of at least the ``fine``-th part of a shard's bytes is an item, of
which there are at most ``shards`` * ``fine``; the smaller ones go by their hash into
as many bundles. The plan, of that bounded size, is broadcast, so documents are not
shuffled at all. ``slots`` numbers the rows of each shard without a single-task window.

Law: ``bytes``. A group larger than a shard's share fills a shard alone, as it must.

Defined results: null text is the empty text, and of its group; sizes are taken as they are given (here
the text's bytes and 8); repeated rows are counted each; with fewer groups than shards some
shards are empty; ties go by size, then hash, so the plan does not depend on how rows are
dealt; an empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import free_name, hash128, table, written
from ouzel.operators.numbering import numbered

SHARDS, FINE = 24, 1024
PLAN = "h1 long, h2 long, bundle long, bytes long, shard int"


def differenced(weights: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, by differencing; of equal spreads the earlier item or combination comes first."""
    n = len(weights)
    if not n:
        return np.zeros(0, np.int64)
    sums: list[np.ndarray | None] = [np.array([w] + [0] * (shards - 1), np.int64) for w in weights.tolist()]
    heap = [(-w if shards > 1 else 0, i) for i, w in enumerate(weights.tolist())]
    heapq.heapify(heap)
    pairs, orders = [], []
    for new in range(n, 2 * n - 1):
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        s = sums[a] + sums[b][::-1]
        order = np.argsort(-s, kind="stable")
        s = s[order]
        s -= s[-1]
        sums[a] = sums[b] = None
        sums.append(s)
        pairs.append((a, b))
        orders.append(order)
        heapq.heappush(heap, (-int(s[0]), new))
    places: dict[int, np.ndarray] = {2 * n - 2: np.arange(shards)}      # the shard of each place of a combination
    for new in range(2 * n - 2, n - 1, -1):
        (a, b), order, of = pairs[new - n], orders[new - n], places.pop(new)
        places[a], places[b] = np.empty_like(of), np.empty_like(of)
        places[a][order] = of
        places[b][shards - 1 - order] = of
    return np.array([places[i][0] for i in range(n)])


def _planner(shards: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(it)
        if not got:
            return
        items = pa.Table.from_batches(got).sort_by([("bytes", "descending"), ("h1", "ascending"), ("h2", "ascending"), ("bundle", "ascending")])
        shard = differenced(items.column("bytes").to_numpy(), shards)
        yield from items.append_column("shard", pa.array(shard.astype(np.int32))).combine_chunks().to_batches()
    return run


def plan(groups: DataFrame, shards: int = SHARDS, fine: int = FINE) -> DataFrame:
    """(h1, h2, bundle, bytes, shard) of the items that groups (h1, h2, bytes) make: h1 and h2 name a group that is an
    item, else ``bundle`` does."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    least = -(-total // (shards * fine)) or 1
    large = F.col("bytes") >= least
    items = (groups.groupBy(F.when(large, F.col("h1")).alias("h1"), F.when(large, F.col("h2")).alias("h2"),
                            F.when(~large, F.pmod("h1", F.lit(shards * fine))).alias("bundle"))
             .agg(F.sum("bytes").alias("bytes")))
    return written(items.repartition(1).mapInArrow(_planner(shards), PLAN), "sharding-plan")


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def balanced(docs: DataFrame, shards: int = SHARDS, size: Column | None = None, text: str = "text", fine: int = FINE,
             out: str = "shard") -> DataFrame:
    """``docs`` with the column ``out``, in place of one of that name: the shard of each row, 0 .. ``shards`` - 1."""
    docs = docs.drop(out)
    h1, h2 = hash128(F.coalesce(F.col(text), F.lit("")))
    groups = written(docs.select(h1.alias("h1"), h2.alias("h2"), (text_bytes(text) if size is None else size).alias("bytes"))
                     .groupBy("h1", "h2").agg(F.sum("bytes").alias("bytes")), "sharding-groups")
    made = plan(groups, shards, fine)
    a, b, c = (free_name(docs, n) for n in ("group_1", "group_2", "bundle"))
    d, e = (free_name(docs, n) for n in ("own_shard", "bundle_shard"))
    own = made.where("bundle is null").select(F.col("h1").alias(a), F.col("h2").alias(b), F.col("shard").alias(d))
    bundles = made.where("bundle is not null").select(F.col("bundle").alias(c), F.col("shard").alias(e))
    keyed = docs.withColumns({a: h1, b: h2}).withColumn(c, F.pmod(F.col(a), F.lit(shards * fine)))
    # both tables have at most shards * fine rows
    return (keyed.join(F.broadcast(own), [a, b], "left").join(F.broadcast(bundles), c, "left")
            .select(*[F.col(f"`{x}`") for x in docs.columns], F.coalesce(d, e).alias(out)))


def slots(rows: DataFrame, order: str, shard: str = "shard", out: str = "slot") -> DataFrame:
    """Stored ``rows`` with their place in their shard, 0, 1, ... in ``order``."""
    return numbered(rows, [order], by=[shard], out=out)


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    docs = balanced(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    rows = written(docs.select("doc_id", text_bytes().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "shard"),
                   "sharding-rows")
    return slots(rows, "doc_id").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))
