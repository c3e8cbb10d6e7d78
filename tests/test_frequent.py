"""Frequent items: exact, reservoir and sticky against a sequential replay."""

import math

import pytest
from pyspark.sql import functions as F

from ouzel.functions.random import coin_threshold_hex
from ouzel.operators import frequent
from ouzel.sources.points import items_from_events

SF = "/root/testdata/sf0.01"


def md5hex(seed, seq):
    import hashlib
    return hashlib.md5(f"{seed}:{seq}".encode()).hexdigest()


def sticky_replay(items, n, phi, eps, delta, seed):
    """The sticky rule applied one arrival at a time."""
    r = math.log(1 / (delta * phi)) / eps
    th = coin_threshold_hex(r / n)
    table = {}
    for seq, item in items[:n]:
        if item in table:
            table[item] += 1
        elif md5hex(seed, seq)[:13] <= th:
            table[item] = 1
    return table


@pytest.fixture(scope="module")
def ev(spark):
    return items_from_events(spark, SF)


@pytest.fixture(scope="module")
def ev8(ev):
    """The first 8000 arrivals."""
    return ev.where(F.col("seq") < 8000)


@pytest.fixture(scope="module")
def rows(ev):
    return [(r.seq, r.item) for r in ev.orderBy("seq").collect()]


def test_exact(ev, ev8, rows):
    assert frequent.stream_length(ev) == 10000
    n = frequent.stream_length(ev, 4, 5)
    assert n == 8000
    counts = {r.item: r["count"] for r in frequent.item_counts(ev8).collect()}
    ref = {}
    for _, it in rows[:n]:
        ref[it] = ref.get(it, 0) + 1
    assert counts == ref
    all_freq = frequent.frequent_exact(ev, 10000, 0.015).count()
    assert all_freq == 12
    assert frequent.distinct_items(ev).collect()[0].distinct_items == 293


@pytest.mark.parametrize("n,phi,eps,size", [(8000, 0.015, 0.01, 148), (10000, 0.015, 0.01, 151)])
def test_sticky_equals_replay(ev, rows, n, phi, eps, size):
    first = ev.where(F.col("seq") < n)
    t = {r.item: r["count"] for r in frequent.sticky_table(first, n, phi, eps, 0.1, 42).collect()}
    assert t == sticky_replay(rows, n, phi, eps, 0.1, 42)
    assert len(t) == size
    exact = {r.item: r["count"] for r in frequent.item_counts(first).collect()}
    assert all(t[k] <= exact[k] for k in t)


def test_sticky_epsilon_above_phi(ev8):
    n, phi, eps = 8000, 0.015, 0.02
    table = frequent.sticky_table(ev8, n, phi, eps, 0.1, 42)
    assert frequent.sticky_report(table, n, phi, eps).count() == table.count()


def test_reservoir(ev, rows):
    n, phi = 8000, 0.015
    s = frequent.reservoir_sample(ev.where(F.col("seq") < n), phi, 42).collect()
    assert len(s) == frequent.reservoir_size(phi) == 67
    ref = sorted(rows[:n], key=lambda r: (md5hex(42, r[0]), r[0]))[:67]
    assert [(r.seq, r.item) for r in s] == ref
    tiny = frequent.reservoir_sample(ev.where(F.col("seq") < 10), phi, 42).count()
    assert tiny == 10


def test_reservoir_is_uniform_over_seeds(ev):
    # each of the first 200 arrivals should be drawn about m/n of the time
    n, phi = 200, 0.05       # m = 20
    hits = {}
    seeds = range(60)
    few = ev.where(F.col("seq") < n)
    for seed in seeds:
        for r in frequent.reservoir_sample(few, phi, seed).select("seq").collect():
            hits[r.seq] = hits.get(r.seq, 0) + 1
    mean = sum(hits.values()) / n
    assert abs(mean - 20 * len(seeds) / n) < 1e-9
    assert max(hits.values()) < 20   # expected 6, far tail would be ~20


def test_flags_and_report(ev8):
    n, phi, eps = 8000, 0.015, 0.01
    truth = frequent.frequent_exact(ev8, n, phi)
    table = frequent.sticky_table(ev8, n, phi, eps, 0.1, 42)
    rep = frequent.sticky_report(table, n, phi, eps)
    flagged = frequent.flag_true(rep, truth)
    assert flagged.where("is_true").count() == frequent.true_hits(rep, truth).count() == 12
    assert flagged.where("not is_true").count() == frequent.false_positives(rep, truth).count()
    report = frequent.frequent_report(ev8, n, phi, eps, 0.1, 42)
    assert report.where("is_true").count() == 12
    assert report.where(F.col("sticky_count").isNotNull()).count() == rep.count()


def test_sticky_reports_true_items_with_high_probability(ev8, rows):
    """Over many seeds every truly frequent item is reported (count >=
    (phi - eps) * n) in at least a 1 - delta share of the runs; no reported
    count exceeds the true count."""
    n, phi, eps, delta = 8000, 0.015, 0.01, 0.1
    true = {}
    for _, it in rows[:n]:
        true[it] = true.get(it, 0) + 1
    frequent_items = [it for it, c in true.items() if c >= phi * n]
    seeds = range(40)
    hits = {it: 0 for it in frequent_items}
    for seed in seeds:
        table = sticky_replay(rows, n, phi, eps, delta, seed)
        for it, c in table.items():
            assert c <= true[it]
            if it in hits and c >= (phi - eps) * n:
                hits[it] += 1
    assert all(h >= (1 - delta) * len(seeds) for h in hits.values())
    for seed in (3, 17):   # the distributed form is the same draw
        t = {r.item: r["count"] for r in frequent.sticky_table(ev8, n, phi, eps, delta, seed).collect()}
        assert t == sticky_replay(rows, n, phi, eps, delta, seed)


@pytest.fixture(scope="module")
def gaps(spark, rows):
    """The items with ids 1, 3, 5, ..., some negative, tied or missing."""
    odd = [(None if i % 97 == 0 else -i if i % 89 == 0 else 2 * (i - i % 2) + 1, item) for i, item in rows]
    return odd, spark.createDataFrame(odd, "seq long, item long").repartition(5, "item")


def test_ids_with_gaps_give_all_rows(gaps, ev):
    odd, df = gaps
    n, phi, eps = len(odd), 0.015, 0.01
    counts = lambda d: {r.item: r["count"] for r in d.collect()}
    assert counts(frequent.item_counts(df)) == counts(frequent.item_counts(ev))
    assert frequent.frequent_exact(df, n, phi).count() == 12
    assert frequent.random_coin(df, 0.5, 42).where("pass is not null and draw is not null").count() == n
    key = lambda r: (md5hex(42, "" if r[0] is None else r[0]), r[0] is not None, r[0] or 0, r[1])
    assert [(r.seq, r.item) for r in frequent.reservoir_sample(df, phi, 42).collect()] == sorted(odd, key=key)[:67]
    p = coin_threshold_hex(frequent.sticky_rate(n, phi, eps, 0.1)[1])
    entry, want = {}, {}
    for seq, item in odd:
        if md5hex(42, "" if seq is None else seq)[:13] <= p:
            entry.setdefault(item, []).append(seq)
    for seq, item in odd:
        if item in entry:
            first = min((x for x in entry[item] if x is not None), default=None)
            want[item] = want.get(item, 0) + (seq is None or first is not None and seq >= first)
    assert counts(frequent.sticky_table(df, n, phi, eps, 0.1, 42)) == {i: c for i, c in want.items() if c}


@pytest.mark.parametrize("n", [0, 1, 4567, 10_000, 20_000])
def test_the_prefix_is_exactly_n_arrivals(gaps, n):
    odd, df = gaps
    order = sorted(odd, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = sorted(((r.seq, r.item) for r in frequent.prefix(df, n).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == order[:n]
