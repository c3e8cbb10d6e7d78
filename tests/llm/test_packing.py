"""Packing: every id once, no padding, and the mixture of every window."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ouzel.llm import packing as P
from cases import AWKWARD


@pytest.fixture(scope="module")
def plain_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.tokenizer_path())


def test_ids_of_words_are_ids_of_texts(plain_tokenizer):
    rng = random.Random(10)
    signs = "ab Zz09'.,!?-é ̈ß中日\t\n\r\x0b\x1c\x85\xa0 ​<|endoftext|>I'M don't ½ﬁ\U0001f600"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    texts += ["<|startoftext|>a <|endoftext|>", "a<|endoftext|>b", "x" * 500, "", " "]
    got = P.Words(P.tokenizer_path(), keep=50)
    for t in texts:
        ids = plain_tokenizer.encode(t, add_special_tokens=False).ids + [2]
        assert got.encode([t.encode()], 2) == [np.array(ids, "<u4").tobytes()], t


def test_plain_words_go_to_the_model_at_once(plain_tokenizer, monkeypatch):
    """Words of lower-case letters, of a-z and of Latin-1, get the tokenizer's ids without its normalising and splitting."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(40)) for _ in range(50)]
    words, whole = P.Words(P.tokenizer_path()), []
    monkeypatch.setattr(words, "tokenizer", type("Counting", (), {"encode": lambda self, x, **how: whole.append(x) or plain_tokenizer.encode(x, **how)})())
    for t in texts:
        ids = plain_tokenizer.encode(t, add_special_tokens=False).ids + [2]
        assert words.encode([t.encode()], 2) == [np.array(ids, "<u4").tobytes()], t
    assert not whole
    assert words.encode([b"x-1 \xc3\x89a"], 2) and whole


def check_pieces(rows, texts, tok, window):
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(own) and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
    assert set(by_doc) == set(ids)
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[i])
    total = sum(map(len, ids.values()))
    for s, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window if s < total // window else at & (at - 1) == 0 and at < window
    assert sorted(by_seq) == list(range(len(by_seq)))
    return by_seq, total


@pytest.mark.parametrize("window", [4096, 64])
def test_pieces(spark, docs_of, words, plain_tokenizer, window):
    rng = random.Random(11)
    texts = AWKWARD + [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 300))) for _ in range(80)]
    rows = P.pack_documents(docs_of(texts), P.tokenizer_path(), window=window).collect()
    by_seq, total = check_pieces(rows, texts, plain_tokenizer, window)
    share = defaultdict(int)
    for r in rows:
        share[r.source] += r.length
    done = defaultdict(int)
    for s in range(total // window):
        for p in by_seq[s]:
            done[p.source] += p.length
        for src, n in share.items():   # at every window's end each source is within a token of its share
            if n * window < 8 * total:
                continue                # it may share the queue of the small ones
            assert abs(done[src] - (s + 1) * window * n / total) <= 2, (s, src)


def test_targets_and_many_small_sources(spark, docs_of, words, plain_tokenizer):
    rng = random.Random(12)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    docs = docs_of(texts).withColumn("source", F.when(F.col("doc_id") < 40, "a").when(F.col("doc_id") < 80, "b")
                                     .otherwise(F.concat(F.lit("s"), F.col("doc_id").cast("string"))))
    rows = P.pack_documents(docs, P.tokenizer_path(), window=64, targets={"a": 3, "b": 1}).collect()
    by_seq, _ = check_pieces(rows, texts, plain_tokenizer, 64)
    first = defaultdict(int)
    for s in range(8):
        for p in by_seq[s]:
            first[p.source] += p.length
    assert dict(first) == {"a": 8 * 48, "b": 8 * 16}
    check_pieces(P.pack_documents(docs, P.tokenizer_path(), window=64).collect(), texts, plain_tokenizer, 64)
    assert P.pack_documents(docs.limit(0), P.tokenizer_path()).count() == 0


def test_a_tiny_named_source_keeps_its_target(spark, docs_of, words, plain_tokenizer):
    rng = random.Random(14)
    texts = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(60)] + ["tiny one", None]
    docs = docs_of(texts).withColumn("source", F.when(F.col("doc_id") < 60, "big").when(F.col("doc_id") == 60, "tiny"))
    rows = P.pack_documents(docs, P.tokenizer_path(), window=64, targets={"big": 1, "tiny": 1, None: 2}).collect()
    by_seq, _ = check_pieces(rows, texts, plain_tokenizer, 64)
    assert {r.sequence_id for r in rows if r.source == "tiny"} == {0} == {r.sequence_id for r in rows if r.source is None}
    with pytest.raises(ValueError, match="at most 2"):
        P.pack_documents(docs, P.tokenizer_path(), window=4, targets={"big": 1, "tiny": 1, "c": 1})
    with pytest.raises(ValueError, match="tiny"):
        P.pack_documents(docs, P.tokenizer_path(), window=64, targets={"big": 1000, "tiny": 1})


def test_pooled_sources_are_served_side_by_side(spark, docs_of, words, plain_tokenizer):
    """400 sources of a few documents: each half of the sequences holds about half of every source."""
    rng = random.Random(15)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 9))) for _ in range(1600)]
    docs = docs_of(texts).withColumn("source", F.when(F.col("doc_id") % 400 > 0, (F.col("doc_id") % 400).cast("string")))
    rows = P.pack_documents(docs, P.tokenizer_path(), window=64).collect()
    by_seq, total = check_pieces(rows, texts, plain_tokenizer, 64)
    n, first, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        n[r.source] += r.length
        first[r.source] += r.length * (r.sequence_id < total // 128)
        longest[r.source] = max(longest[r.source], r.doc_tokens)
    assert len(n) == 400 and all(abs(first[s] - n[s] / 2) <= longest[s] + 2 for s in n)


def test_bytes_that_are_not_utf8(spark, plain_tokenizer):
    raw = [b"good \xff\xfebad caf\xc3", b"\xc3\x28 x", b"plain"]
    docs = (spark.createDataFrame(list(enumerate(raw)), "doc_id long, raw binary")
            .select("doc_id", F.col("raw").cast("string").alias("text"), F.col("raw").cast("string").alias("source")))
    rows = P.pack_documents(docs, P.tokenizer_path(), window=64).collect()
    check_pieces(rows, [t.decode("utf-8", "replace") for t in raw], plain_tokenizer, 64)


def test_schedule_of_any_window_equals_the_replay():
    """The closed form against deficit round-robin played window by window."""
    rng = random.Random(13)
    for _ in range(30):
        tokens = [rng.randrange(300, 5000) for _ in range(rng.randrange(1, 6))]
        s = P.Schedule(tokens, None, 128)
        total, taken, deficit = sum(tokens), [0] * len(tokens), [0] * len(tokens)
        for k in range(1, s.windows + 1):
            for i, t in enumerate(tokens):
                deficit[i] += 128 * t                      # in units of 1 / total
                got = deficit[i] // total if deficit[i] > 0 else 0
                taken[i] += got
                deficit[i] -= got * total
            at = s._at(k)
            assert sum(at) == 128 * k and all(0 <= a - 128 * k * t // total <= 1 for a, t in zip(at, tokens))
            assert all(a >= b for a, b in zip(at, s._at(k - 1))) and all(a <= t for a, t in zip(at, tokens))
        w = [rng.randrange(10, 100) for _ in tokens]
        s = P.Schedule(tokens, w, 128)
        rows = [s._at(k) for k in range(s.windows + 1)]
        assert all(sum(b) - sum(a) == 128 and all(y >= x for x, y in zip(a, b)) for a, b in zip(rows, rows[1:]))
        assert all(x <= t for x, t in zip(rows[-1], tokens))
