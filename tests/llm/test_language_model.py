"""The language model: exact counts, probabilities that sum to one, held-out gain, seating."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ouzel.llm import language_model as L
from ouzel.llm.common import fold, table
from cases import AWKWARD

SF = "/root/testdata/sf0.01"
SMALL = dict(block=30_000, shard=40_000, part=20_000, hot=5_000)


def plain(rows):
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    c = Counter()
    for _, held, t in rows:
        if not held:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    return n, {i: (held, len(w := tokens(t)), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in w))
               for i, held, t in rows}


@pytest.mark.parametrize("sizes", [{}, SMALL])
def test_counts_base_score_and_gain(spark, sizes):
    docs = table(spark, SF, "documents").select("doc_id", (fold(F.col("doc_id")) == 1).alias("held"), "text")
    got = L.score(docs, **sizes).toPandas()
    n, exp = plain([tuple(r) for r in docs.collect()])
    assert len(got) == len(exp) and set(got.train_tokens) == {n}
    for r in got.itertuples():
        assert (r.held_out, r.n_tokens, r.n_known) == exp[r.doc_id][:3]
        assert r.base_score == pytest.approx(exp[r.doc_id][3], abs=1e-6)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() * 0.9


def test_long_texts_over_several_blocks_and_awkward_ones(spark, docs_of, words):
    texts = AWKWARD + [" ".join(words)] * 3
    docs = docs_of(texts).withColumn("held", F.col("doc_id") % 4 == 1)
    got = {r.doc_id: r for r in L.score(docs, block=999, shard=5_000, part=300, hot=2_000).collect()}
    n, exp = plain([(r.doc_id, r.held, r.text) for r in docs.collect()])
    whole = {r.doc_id: r for r in L.score(docs).collect()}
    for i, e in exp.items():
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (*e[:3], n)
        assert got[i].base_score == pytest.approx(e[3], abs=1e-6)
        assert got[i].score == pytest.approx(whole[i].score, rel=0.05, abs=1.5) and got[i].score < 0
    assert L.score(docs.limit(0)).count() == 0
    none = L.score(docs.withColumn("held", F.lit(True))).collect()
    assert len(none) == len(texts) and {r.train_tokens for r in none} == {0} and {r.score for r in none} == {0.0}


def test_probabilities_of_the_parent_sum_to_one():
    parent = L.Parent(4, 0.5, 20.0, 6.0)
    c, t = np.array([9, 6, 4, 1]), np.array([2, 2, 1, 1])
    assert parent.p(c, t).sum() + parent.p(np.array([0]), np.array([0]))[0] == pytest.approx(1.0)


def test_sum_over_words_given_a_context(spark):
    shard = {"hot": 0, "s": 0, "keys": L.pack_sorted(np.array([(7 << 32) | w for w in (1, 2, 3)], np.uint64)), "counts": L.pack(np.array([5, 1, 0], np.uint32))}
    s = L.Shard(shard, 1)
    base, d = np.array([.2, .3, .1]), 0.6
    t = s.tables(np.array([2]))
    p = (np.maximum(s.c - d * t, 0) + (L.THETA + d * s.by_context(t)) * base) / (L.THETA + s.by_context(s.c))
    rest = (L.THETA + d * 3) * (1 - base.sum()) / (L.THETA + 6)      # words never seen after this context
    assert p.sum() + rest == pytest.approx(1.0)


def test_tables_of_a_dish_follow_the_restaurant():
    """The drawn number of tables against the exact distribution from seating plans one by one."""
    d, theta, n, base, others = 0.4, 1.5, 6, 0.3, 3
    seat = L.Seating(d, theta)
    rng = np.random.default_rng(16)
    got = seat.draw(np.full(60_000, n), np.full(60_000, others), np.full(60_000, base), rng)
    plans = {(1,): 1.0 * base * (theta + d * others)}               # weights of the tables' sizes
    for _ in range(n - 1):
        new = Counter()
        for sizes, w in plans.items():
            for k, x in enumerate(sizes):
                new[(*sizes[:k], x + 1, *sizes[k + 1:])] += w * (x - d)
            new[(*sizes, 1)] += w * base * (theta + d * (others + len(sizes)))
        plans = new
    exp = Counter()
    for sizes, w in plans.items():
        exp[len(sizes)] += w
    total = sum(exp.values())
    for t in range(1, n + 1):
        assert (got == t).mean() == pytest.approx(exp[t] / total, abs=0.01)


def log_stirling(d, n, most):
    """log S_d(n, t) for t = 1 .. most, by the recurrence."""
    row, t = np.full(most + 1, -np.inf), np.arange(1, most + 1)
    row[0] = 0.0
    for k in range(n):
        with np.errstate(divide="ignore"):
            row = np.concatenate([[-np.inf], np.logaddexp(row[:-1], row[1:] + np.log(np.maximum(k - t * d, 0)))])
    return row[1:]


@pytest.mark.parametrize("d", [0.05, 0.5, 0.8, 0.95])
def test_stirling_numbers_from_the_integral(d):
    for n in (65, 700, 10_000):
        t = np.arange(1, min(n, 400) + 1)
        lg = np.array([math.lgamma(x + 1) for x in t])
        got = math.lgamma(n + 1) - lg - t * math.log(d) + L.log_sizes(d, n, t)
        off = np.abs(got - log_stirling(d, n, len(t)))
        assert off.max() < 0.01 and off[t < 0.8 * n].max() < 1e-4
    x = np.array([0.1, 0.9, 1.0, 2.5, 7.9, 30.0, 1e6])
    assert np.allclose(L.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


@pytest.mark.parametrize("d,theta,n,base,others", [
    (0.8, 1.0, 65, 0.05, 50), (0.8, 1.0, 500, 0.05, 50), (0.8, 1.0, 1500, 0.05, 50), (0.5, 1.0, 1500, 0.05, 50),
    (0.8, 1.0, 10_000, 0.0005, 50), (0.7, 10.0, 10_000, 0.02, 9000), (0.3, 1.0, 200, 0.2, 3000), (0.9, 1.0, 4000, 0.1, 100_000)])
def test_tables_of_frequent_dishes_follow_the_restaurant(d, theta, n, base, others):
    """Above EXACT customers: mean, deviation and distribution against Stirling numbers by recurrence."""
    t = np.arange(1, min(n, 4000 if others > 50_000 else 700) + 1)
    w = log_stirling(d, n, len(t)) + np.cumsum(np.log(base) + np.log(theta + d * (others + np.arange(len(t)))))
    p = np.exp(w - w.max())
    p /= p.sum()
    assert p[-1] < 1e-9 or len(t) == n
    draws = 4000
    got = L.Seating(d, theta).draw(np.full(draws, n), np.full(draws, others), np.full(draws, base), np.random.default_rng(5))
    mean = (p * t).sum()
    sd = math.sqrt((p * (t - mean) ** 2).sum())
    assert got.min() >= 1 and got.max() <= n
    assert got.mean() == pytest.approx(mean, abs=5 * sd / math.sqrt(draws) + 1e-9)
    assert got.std() == pytest.approx(sd, rel=0.08, abs=1e-6)
    gap = np.abs(np.cumsum(np.bincount(got, minlength=len(t) + 1)[1:len(t) + 1]) / draws - np.cumsum(p)).max()
    assert gap < 0.035


def test_millions_of_customers_reach_the_limit():
    """Then the tables beyond the first are negative binomial."""
    d, base, others, n = 0.8, 0.02, 400, 50_000_000
    got = L.Seating(d, 1.0).draw(np.full(8000, n), np.full(8000, others), np.full(8000, base), np.random.default_rng(6)) - 1
    r = 1.0 / d + others + 1
    assert got.mean() == pytest.approx(r * base / (1 - base), rel=0.03)
    assert got.var() == pytest.approx(r * base / (1 - base) ** 2, rel=0.08)


def test_hot_contexts_are_dealt_like_any_other():
    rng = np.random.default_rng(17)
    keys = np.unique(rng.integers(0, 2 ** 63, 500, np.uint64) * np.uint64(2))
    keys = np.unique(np.concatenate([keys, (np.uint64(5) << np.uint64(32)) + rng.integers(0, 2 ** 32, 300, np.uint64)]))
    got = list(L.dealt(keys, 4, {5: 950}, 100))
    assert np.array_equal(np.sort(np.concatenate([x[2] for x in got])), np.arange(len(keys)))
    assert sum(x[0] == 6 for x in got) == 10 and all((keys[a] >> np.uint64(32) == 5).all() == (h == 6) for h, _, a in got)
