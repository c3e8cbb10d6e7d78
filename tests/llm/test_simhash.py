"""SimHash: fingerprints and components against all pairs; the masks cover every pair."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ouzel.llm import simhash as S
from cases import AWKWARD


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, d in enumerate(ids)}


def test_every_pair_within_the_radius_shares_a_bucket():
    rng = random.Random(1)
    for radius in (1, 2, 4):
        masks = S.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            diff = sum(1 << i for i in rng.sample(range(64), rng.randrange(1, radius + 1)))
            assert any(m & diff == 0 for m in masks)


def test_spanning_links_connect_what_all_links_do():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2 ** 63, 5, np.uint64)
    fps = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 60, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60, np.uint64))
                                    ^ (np.uint64(1) << rng.integers(0, 64, 60, np.uint64)) for b in base]))
    links = S.spanning_links(fps, 4)
    assert len(links) < len(fps) and all(int(a ^ b).bit_count() <= 4 for a, b in links)
    ids = [int(f) for f in fps]
    exp = plain_components(ids, ids, 4)
    got = dict(zip(ids, ids))
    for _ in range(len(fps)):
        for a, b in links:
            got[int(a)] = got[int(b)] = min(got[int(a)], got[int(b)])
    assert got == exp


@pytest.mark.parametrize("block", [S.BLOCK, 7])
def test_against_all_pairs(spark, docs_of, words, block):
    rng = random.Random(3)
    text = lambda n: [rng.choice(words) for _ in range(n)]
    texts = list(AWKWARD)
    for _ in range(12):
        a = text(rng.randrange(5, 400))
        for _ in range(rng.randrange(1, 12)):
            b = list(a)
            for _ in range(rng.randrange(0, 3)):
                b[rng.randrange(len(b))] = rng.choice(words)
            texts.append(" ".join(b).title() if rng.random() < .3 else "  ".join(b))
    got = S.near_duplicates(docs_of(texts), 4, 4, block=block).collect()
    fps = [plain_fingerprint(t) for t in texts]
    assert {r.doc_id: r.fp % 2 ** 64 for r in got} == dict(enumerate(fps))
    assert {r.doc_id: r.component_id for r in got} == plain_components(list(range(len(texts))), fps, 4)


def test_long_text_in_chunks(monkeypatch):
    t = " ".join(str(i * i % 977) for i in range(5000)).encode()
    whole = S.fingerprint(t)
    monkeypatch.setattr(S, "CHUNK", 100)
    assert S.fingerprint(t) == whole == plain_fingerprint(t.decode())


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000 + 7 * i, 1000 + 7 * (i + 1)) for i in range(50)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in S.components(links).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[1000 + 7 * i] for i in range(51)} == {1000}


def test_nulls_and_empty(spark, docs_of):
    docs = docs_of(["a b c d e", "a b c d e", "f g h i j"]).withColumn("doc_id", F.when(F.col("doc_id") == 1, F.col("doc_id")))
    got = {(r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect()}
    assert got == {(None, 1), (1, 1), (None, None)}
    assert S.near_duplicates(docs.limit(0)).count() == 0
