"""Differencing against a plain one and against the best partition; the laws of the shards."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, make_docs
from ouzel.llm import sharding as S


def plain_spread(weights, k):
    """Karmarkar-Karp with sorted lists of subsets' sums."""
    parts = [sorted([w] + [0] * (k - 1)) for w in weights]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts[0], parts[1]
        parts = parts[2:] + [sorted(x + y for x, y in zip(a, reversed(b)))]
    return parts[0][-1] - parts[0][0]


def sums_of(weights, shard, k):
    return np.bincount(shard, weights, k).astype(int)


def test_equals_plain_differencing():
    rng = random.Random(1)
    for k in (2, 3, 5, 24):
        for n in (1, 2, 7, 40, 150):
            w = np.array(rng.sample(range(10 ** 6, 10 ** 9), n), np.int64)
            sums = sums_of(w, S.differenced(w, k), k)
            assert sums.sum() == w.sum() and sums.max() - sums.min() == plain_spread(w.tolist(), k)


def test_close_to_the_best_and_better_than_greedy():
    rng = random.Random(2)
    kk = greedy = 0
    for _ in range(60):
        w = [rng.randrange(1, 1000) for _ in range(9)]
        best = min(max(sum(x for x, s in zip(w, c) if s == j) for j in range(3)) for c in itertools.product(range(3), repeat=9))
        sums = sums_of(np.array(w, np.int64), S.differenced(np.array(w, np.int64), 3), 3)
        assert best <= sums.max() <= 4 / 3 * best
        lpt = [0] * 3
        for x in sorted(w, reverse=True):
            lpt[lpt.index(min(lpt))] += x
        kk, greedy = kk + sums.max() - best, greedy + max(lpt) - best
    assert kk < greedy


def test_one_shard_and_no_items():
    assert S.differenced(np.array([5, 3], np.int64), 1).tolist() == [0, 0]
    assert S.differenced(np.array([], np.int64), 4).tolist() == []
    assert sorted(S.differenced(np.array([5, 3], np.int64), 4).tolist()) != [0, 0]


@pytest.mark.parametrize("fine,most", [(1024, 0.002), (64, 0.005), (8, 0.05)])
def test_laws(spark, fine, most):
    """Equal texts together, every row once, bytes near equal; with ``fine`` 8 nearly all groups are bundled."""
    rng = random.Random(4)
    texts = ["x" * rng.randrange(2000) + str(i % 1500) for i in range(2000)] + ["copy"] * 400 + AWKWARD
    rows = S.written(S.balanced(make_docs(spark, texts), 3, fine=fine), "test-rows")
    assert rows.columns == [*make_docs(spark, ["a"]).columns, "shard"]
    out = S.slots(rows, "doc_id").select("doc_id", "text", "shard", "slot").collect()
    assert sorted(r.doc_id for r in out) == list(range(len(texts)))
    by_text, by_shard, size = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in out:
        by_text[r.text or ""].add(r.shard)
        by_shard[r.shard].append((r.slot, r.doc_id))
        size[r.shard] += len((r.text or "").encode()) + 8
    assert all(len(s) == 1 for s in by_text.values()) and sorted(by_shard) == list(range(3))
    for got in by_shard.values():
        got.sort()
        assert [s for s, _ in got] == list(range(len(got))) and [d for _, d in got] == sorted(d for _, d in got)
    assert max(size.values()) - min(size.values()) <= most * sum(size.values()) / 3


def test_a_group_beyond_a_shards_share_stands_alone(spark):
    texts = ["big" * 50] * 300 + [f"t{i}" * 3 for i in range(500)]
    rows = S.balanced(make_docs(spark, texts), 4).groupBy("shard").agg(F.collect_set("text").alias("t"), F.sum(S.text_bytes()).alias("b")).collect()
    alone = [r for r in rows if "big" * 50 in r.t]
    assert len(alone) == 1 and len(alone[0].t) == 1
    rest = [r.b for r in rows if r is not alone[0]]
    assert len(rest) == 3 and max(rest) - min(rest) <= 20


def test_does_not_depend_on_how_rows_are_dealt(spark):
    docs = make_docs(spark, [f"{i % 90} {'y' * (i * 31 % 77)}" for i in range(300)])
    a, b = ({r.doc_id: r.shard for r in S.balanced(d, 5, fine=4).collect()} for d in (docs, docs.repartition(7, "text")))
    assert a == b


def test_empty_table_and_own_sizes(spark):
    docs = make_docs(spark, ["a", "b", "a", None])
    assert S.balanced(docs.limit(0)).count() == 0
    got = {r.doc_id: r.shard for r in S.balanced(docs, 2, size=F.lit(1).cast("long")).collect()}
    assert got[0] == got[2] and got[1] == got[3] != got[0]
