"""Exact top-k search by MaxScore over signed term weights.

A vector is a document whose terms are its dimensions. Candidates are dealt into
shards by a hash of their id, each packed as term-major postings; queries are
packed into blocks, a file each in the shared folder. A shard stays in one task, which
reads the query blocks one after the other (with fewer shards than cores, a few tasks
share a shard's query blocks), so the vectors are shuffled once. A query goes
through the shard's posting blocks with the k-th best score so far as its bar:

* a term's contribution in a posting block lies between its smallest and largest
  product; by the width of that range the terms are ordered;
* the widest terms without which no document reaches the bar are essential:
  their postings are added up for the whole block;
* the others are probed from the widest down, only for documents whose sum plus
  the bounds of what is left still reaches the bar.

The shards' top k are merged per query. Nothing is approximate; ties go to the
smaller id.

Defined results: rows with a null id, a null vector or a null or non-finite
component take no part; missing trailing components count as absent terms; a
candidate row that repeats is ranked again, rows of the query's own id never;
of query rows that share an id the smallest vector asks; an empty table gives
no rows. Scores must stay below 2^53 in magnitude, else an error is raised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ouzel.llm.common import batch, filed, pack, read_row, table, unpack, written

SHARD, QUERY_BLOCK, POSTING_BLOCK = 16384, 1024, 4096
PROBED = 16            # terms probed between two comparisons with the bar
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v array<long>): floor(scale * x) of each component, for the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v")))


def packed(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks (block, dim, ids, m) of about ``size`` rows: ids ascending, m the term-major matrix."""
    blocks = max(1, -(-rows.count() // size))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        dim = max(map(len, pdf["v"]))
        m = np.zeros((dim, len(pdf)), np.int64)
        for k, v in enumerate(pdf["v"]):
            m[:len(v), k] = v
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "dim": [dim], "ids": [pack(pdf["id"].to_numpy(np.int64))],
                             "m": [pack(m.reshape(-1))]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(one, "block long, dim int, ids binary, m binary"), blocks


def added(q: np.ndarray, m: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The sums over the postings of ``terms``, for every document of a block."""
    if len(terms) == len(q):
        return q @ m
    own = np.zeros_like(q)
    own[terms] = q[terms]
    return own @ m


def maxscore(q: np.ndarray, qid: int, ids: np.ndarray, postings: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the best k of a shard, best first, ties to the smaller id.

    ``postings``: (first row, term-major block, smallest and largest weight of each term).
    """
    top_s, top_i = np.zeros(0), np.zeros(0, np.int64)
    for at, m, low, high in postings:
        bar = top_s[-1] if len(top_s) == k else -np.inf
        a, b = q * low, q * high
        most, least = np.maximum(a, b), np.minimum(a, b)
        order = np.argsort(least - most, kind="stable")           # widest range first
        most, least = most[order], least[order]
        rest_most = np.append(np.cumsum(most[::-1])[::-1], 0.0)   # largest sum of the terms from here on
        if rest_most[0] < bar:
            continue
        # non-essential: the tail whose widths together, above every term's least, stay under the bar
        width = np.append(np.cumsum((most - least)[::-1])[::-1], 0.0)
        cut = int(np.argmax(least.sum() + width < bar)) if least.sum() < bar else len(q)
        score, live = added(q, m, order[:cut]), np.arange(m.shape[1])
        while True:
            keep = score + rest_most[cut] >= bar
            live, score = live[keep], score[keep]
            if cut == len(q) or not len(live):
                break
            # few are left: probe their next terms; else their postings are added up like essential ones
            until = min(len(q), cut + PROBED) if 3 * len(live) < m.shape[1] else len(q)
            terms = order[cut:until]
            score = score + (q[terms] @ m[np.ix_(terms, live)] if until < len(q) or 3 * len(live) < m.shape[1] else added(q, m, terms)[live])
            cut = until
        found = ids[at + live]
        own = found != qid
        s, i = np.concatenate([top_s, score[own]]), np.concatenate([top_i, found[own]])
        if len(s) > 4 * k:   # the k-th best and what ties with it
            good = s >= np.partition(s, -k)[-k]
            s, i = s[good], i[good]
        best = np.lexsort((i, -s))[:k]
        top_s, top_i = s[best], i[best]
    return top_s, top_i


def _searcher(k: int, folder: str, files: list[str]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(b.num_rows):
                yield from search(b.slice(at, 1).to_pylist()[0])

    def search(r: dict) -> Iterator[pa.RecordBatch]:
        ids = unpack(r["ids"], np.int64)
        whole = unpack(r["m"], np.int64).reshape(r["dim"], len(ids)).astype(np.float64)
        postings: dict[int, list] = {}        # by the number of terms
        for file in files[r["share"]::r["shares"]]:
            asked = read_row(folder, file)
            qids = unpack(asked["ids"], np.int64)
            qs = unpack(asked["m"], np.int64).reshape(asked["dim"], len(qids))
            dim = min(r["dim"], asked["dim"])
            m, qs = whole[:dim], qs[:dim].T.astype(np.float64)
            if m.size and qs.size and np.abs(m).max() * np.abs(qs).max() * dim >= 2.0 ** 53:
                raise OverflowError("scores beyond 2^53 would not be exact")
            if dim not in postings:
                postings = {dim: [(at, p, p.min(1), p.max(1)) for at in range(0, len(ids), POSTING_BLOCK)
                                  for p in [np.ascontiguousarray(m[:, at:at + POSTING_BLOCK])]]}
            rows = []
            for q, qid in zip(qs, qids.tolist()):
                s, i = maxscore(q, qid, ids, postings[dim], k)
                rows += [(qid, int(y), int(x)) for x, y in zip(s, i)]
            yield batch(rows, HITS)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for (id, v) rows; candidates are all ``vectors`` but the query's own id."""
    shards, n = packed(vectors, SHARD)
    asked, _ = packed(queries.groupBy("id").agg(F.min("v").alias("v")), QUERY_BLOCK)
    folder, files = filed(asked.select("dim", "ids", "m"), "queries")
    # a shard goes to several tasks only where there are more cores than shards
    shares = max(1, min(len(files), -(-vectors.sparkSession.sparkContext.defaultParallelism // n)))
    share = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    work = written(shards, "shards").select("*", share.alias("share"), F.lit(shares).alias("shares"))
    work = work.repartitionById(n * shares, (F.col("block") * shares + F.col("share")).cast("int"))
    hits = work.mapInArrow(_searcher(k, folder, files), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op4_maxscore(spark, sf_dir: str) -> DataFrame:
    rows = quantised(table(spark, sf_dir, "embeddings"), 64)
    return top_k(rows, rows.where(F.col("id") % 20 == 0), 20)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
