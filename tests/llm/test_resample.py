"""Importance resampling against plain Python; brackets that miss; ties; the cases each operator has to define."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, make_docs
from ouzel.llm import resample as R

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    raw = (text or "").encode()
    words = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in raw))
    return words, [b" ".join(words[i:i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def brute(rows, targets, percent, seed, min_words, runs, buckets):
    code = lambda f: zlib.crc32(f) % buckets
    s = Counter(code(f) for _, t in rows for f in features(t, runs)[1])
    t = Counter(code(f) for x in targets for f in features(x, runs)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        words, fs = features(text, runs)
        w = sum(gain[code(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    able = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    k = percent * len(able) // 100
    rank = {id(x): r for r, x in enumerate(able[:k], 1)}
    return sorted((tuple(x) + (rank.get(id(x)),) for x in out), key=str)


@pytest.fixture(scope="module")
def texts(words):
    return [" ".join(words[(i * k) % 300] for k in range(i % 60)) + ("! Some,punctuation" if i % 2 else "") for i in range(500)] + AWKWARD


@pytest.mark.parametrize("runs,percent,min_words,buckets", [(1, 10, 20, 10_000), (3, 40, 1, 97), (1, 0, 20, 50)])
def test_against_plain_python(spark, texts, words, runs, percent, min_words, buckets):
    targets = [" ".join(words[k] for k in range(9)), None, "", texts[33]]
    rows = spark.createDataFrame([(t,) for t in targets], "text string")
    out = R.resample(make_docs(spark, texts), rows, percent, 7, min_words, runs, buckets)
    got = sorted((tuple(r) for r in out.select("id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)
    assert got == brute(list(enumerate(texts)), targets, percent, 7, min_words, runs, buckets)


def test_the_bracket_is_widened_until_it_holds_the_cutoff(spark):
    """Many equal scores, and brackets of no width: the draw is the same, and of exactly k rows."""
    rows = [(None if i % 50 == 0 else i // 2, (i * 7919) % 13 if i % 3 else 5, i % 10 > 0) for i in range(4000)]
    scored = R.written(spark.createDataFrame(rows, "id long, score long, may_draw boolean").repartition(6, "id"), "test-scores")
    able = sorted((r for r in rows if r[2]), key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    for k in (1, 700, 2000, len(able)):
        for eps in (R.EPS, (0.0, 1.0), (1.0,)):
            got = [tuple(r) for r in R.draw(scored, k, len(able), eps).where("rank is not null").orderBy("rank").select("rank", "score", "id").collect()]
            assert got == [(n, s, i) for n, (i, s, _) in enumerate(able[:k], 1)]
    assert R.draw(scored, 7, len(able)).count() == len(rows)


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    text = " ".join(f"w{i % 977} {i}" for i in range(3000))
    whole = [c for _, c, _ in R.codes_of([text.encode()], 1, R.Codes(1000))]
    cut = [w for ws in R.pieces(text.encode(), 50) for w in ws]
    assert cut == text.encode().split() and sum(map(len, whole)) == 6000
    monkeypatch.setattr(R, "PIECE", 400)
    for runs in (1, 3):
        got = Counter(int(c) for _, cs, _ in R.codes_of([b"", text.encode(), b"a b"], runs, R.Codes(1000)) for c in cs)
        want = Counter(zlib.crc32(f) % 1000 for t in (text, "a b") for f in features(t, runs)[1])
        assert got == want


def test_repeated_rows_and_empty_tables(spark):
    same = make_docs(spark, ["a b c"]).union(make_docs(spark, ["a b c"])).withColumn("doc_id", F.lit(None).cast("long"))
    nothing = spark.createDataFrame([], "text string")
    out = R.resample(same, nothing, percent=50, min_words=1).collect()
    assert sorted(r.rank or 0 for r in out) == [0, 1]
    assert R.resample(same.limit(0), nothing).count() == 0
