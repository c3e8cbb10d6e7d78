"""MaxScore against sorting all scores."""

import random

import numpy as np
import pytest

from ouzel.llm import maxscore as M


def plain(rows, is_query, k):
    live = [(i, [int(np.floor(64.0 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asks = {}
    for i, v in live:
        if is_query(i):
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, qv in asks.items():
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in live if i != q)
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("k,shard", [(20, M.SHARD), (5, 16), (300, 50)])
def test_against_sorting(spark, monkeypatch, k, shard):
    monkeypatch.setattr(M, "SHARD", shard)
    monkeypatch.setattr(M, "QUERY_BLOCK", max(4, shard // 4))
    monkeypatch.setattr(M, "POSTING_BLOCK", max(8, shard // 3))
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, -0.01, rng.gauss(0, .2)]) for _ in range(12)]) for i in range(150)]
    rows += [(i, rows[i][1]) for i in (0, 3, 20)]                       # repeated rows
    rows += [(200, None), (220, []), (240, [None] * 12), (260, [float("nan")] * 12), (280, [float("inf")] + [0.0] * 11),
             (300, [0.5, 0.5]), (None, [0.1] * 12)] + [(400 + i, [0.25] * 12) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    q = M.quantised(df)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in M.top_k(q, q.where("id % 20 = 0"), k).collect())
    assert got == plain(rows, lambda i: i % 20 == 0, k)
    assert M.top_k(q.limit(0), q.limit(0), k).count() == 0


def test_scores_that_would_not_be_exact(spark):
    df = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e9, 2.0])], "vec_id long, embedding array<double>")
    q = M.quantised(df)
    with pytest.raises(Exception, match="2\\^53"):
        M.top_k(q, q, 1).collect()


def test_vectors_are_shuffled_once(spark, monkeypatch):
    """A shard is a row of work, or a few where cores outnumber shards, whatever the number of queries."""
    monkeypatch.setattr(M, "SHARD", 50)
    monkeypatch.setattr(M, "QUERY_BLOCK", 10)
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)]) for i in range(1000)], "vec_id long, embedding array<double>")
    q = M.quantised(df)
    seen = []
    monkeypatch.setattr(M, "_searcher", lambda k, folder, files: seen.append(len(files)) or
                        (lambda it: ([M.batch([(0, r["block"], r["share"]) for b in it for r in b.to_pylist()], M.HITS)])))
    rows = M.top_k(q, q, 10_000).collect()
    assert seen[0] > 50 and len(rows) == 20
