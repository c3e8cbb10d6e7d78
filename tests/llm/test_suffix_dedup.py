"""Suffix-array dedup against all windows."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from ouzel.llm import suffix_dedup as S
from cases import AWKWARD

L = 400


def plain(texts):
    data = [(t or "").encode() for t in texts]
    c = Counter(hashlib.blake2b(t[i:i + L], digest_size=12).digest() for t in data for i in range(len(t) - L + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - L + 1):
            if c[hashlib.blake2b(t[i:i + L], digest_size=12).digest()] > 1:
                gone[i:i + L] = b"\1" * L
        spans = sum(x and not p for p, x in zip(b"\0" + gone, gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, x in zip(t, gone) if not x)).hexdigest()))
    return out


def test_against_all_windows(spark, docs_of):
    rng = random.Random(6)
    rnd = lambda n: "".join(rng.choice("abcdefghij klmnopqé") for _ in range(n))
    texts = [t if t is None or len(t) < 9000 else t[:3000] for t in AWKWARD] + [rnd(rng.randrange(0, 1500)) for _ in range(30)]
    passages = [rnd(rng.randrange(380, 900)) for _ in range(5)]
    for _ in range(60):
        p = rng.choice(passages)
        texts.append(rnd(rng.randrange(0, 300)) + p[rng.randrange(0, 60):len(p) - rng.randrange(0, 60)] + rnd(rng.randrange(0, 300)))
    texts += ["a" * 399, "a" * 400, "a" * 1000, "ab" * 700, texts[20], texts[60], texts[60], rnd(450) * 3, "abc" * 300]
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in S.remove_repeats(docs_of(texts), L).collect()}
    assert got == dict(enumerate(plain(texts)))
    kept = {r.doc_id: hashlib.sha256(r.kept).hexdigest() for r in S.remove_repeats(docs_of(texts[:20]), L).collect()}
    assert kept == {i: x[3] for i, x in enumerate(plain(texts[:20]))}


def test_anchors_do_not_depend_on_chunks_or_neighbours(monkeypatch):
    rng = random.Random(7)
    texts = [bytes(rng.randrange(97, 101) for _ in range(rng.randrange(0, 3000))) for _ in range(12)]
    one, two = S.Rolling(1, S.CHUNK + 2 * L), S.Rolling(2, S.CHUNK + 2 * L)

    def found(group):
        data, ends = np.frombuffer(b"".join(group), np.uint8), np.cumsum([len(t) for t in group])
        return sorted((int(t), int(p), int(c), int(r)) for a in S.anchors(data, ends, L, one, two)
                      for t, p, c, r in zip(a["text"], a["pos"], a["core"], a["reach"]))
    whole = found(texts)
    alone = sorted((i, *a[1:]) for i, t in enumerate(texts) for a in found([t]))
    assert whole == alone
    monkeypatch.setattr(S, "CHUNK", 333)
    assert found(texts) == whole


def test_every_window_holds_an_anchor():
    rng = random.Random(8)
    t = bytes(rng.randrange(256) for _ in range(5000))
    one, two = S.Rolling(1, S.CHUNK + 2 * L), S.Rolling(2, S.CHUNK + 2 * L)
    at = np.concatenate([a["pos"] for a in S.anchors(np.frombuffer(t, np.uint8), np.array([len(t)]), L, one, two)])
    assert all(((at >= p) & (at <= p + L - S.GRAM)).any() for p in range(len(t) - L + 1))
    assert len(at) < len(t) / 60


def test_short_length_is_refused_and_empty_table(spark, docs_of):
    with pytest.raises(ValueError):
        S.remove_repeats(docs_of(["a"]), 100).count()
    assert S.remove_repeats(docs_of(["a"]).limit(0), L).count() == 0


def test_anchors_hold_little_memory():
    data = np.random.default_rng(9).integers(97, 123, 3 << 20, np.uint8)
    tracemalloc.start()
    try:
        one, two = S.Rolling(1, S.CHUNK + 2 * L), S.Rolling(2, S.CHUNK + 2 * L)
        found = sum(len(a["pos"]) for a in S.anchors(data, np.array([len(data)]), L, one, two))
        assert found > len(data) / 110
        assert tracemalloc.get_traced_memory()[1] < 32e6
    finally:
        tracemalloc.stop()


def test_edges_of_passages_come_to_few_rows(spark, docs_of, monkeypatch):
    rng = random.Random(10)
    rnd = lambda n: "".join(rng.choice("abcdefghij klmnopq") for _ in range(n))
    passage = rnd(1200)
    texts = [rnd(500) + passage[rng.randrange(0, 300):1200 - rng.randrange(0, 300)] + rnd(500) for _ in range(40)]
    levels, neighbours = [], S.neighbours

    def counted(rows, n):
        if "place" in rows.columns:
            levels.append((rows.count(), rows.select("place").distinct().count()))
        return neighbours(rows, n)
    monkeypatch.setattr(S, "neighbours", counted)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in S.remove_repeats(docs_of(texts, False), L).collect()}
    assert got == dict(enumerate(plain(texts)))
    assert sum(rows for rows, _ in levels) < 25 * levels[0][1]
