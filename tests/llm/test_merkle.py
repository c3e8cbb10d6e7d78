"""The Merkle manifest against a tree built in plain Python; octopus against all paths; tampering is found."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, make_docs
from ouzel.llm.merkle import COLUMNS, leaf_hash, manifest, missing, proofs, widths


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def path(levels, i, arity):
    for level in levels[:-1]:
        a = i // arity * arity
        yield level[a:i], level[i + 1:a + arity]
        i //= arity


def brute(rows, arity, change=lambda r: r):
    """One result for each row: (doc_id, leaf, subroot, root, siblings, folded root)."""
    hashed = lambda r: H(field(r[c]) for c in COLUMNS)
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, hashed(r), hashed(change(r))))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[2] for x in sorted(groups[k])], arity) for k in keys}
    top, out = tree([trees[k][-1][0] for k in keys], arity), []
    for at, k in enumerate(keys):
        for i, (known, doc_id, leaf, now) in enumerate(sorted(groups[k])):
            way = [*path(trees[k], i, arity), *path(top, at, arity)]
            for a, b in way:
                now = H([*a, now, *b])
            out.append((doc_id if known else None, leaf, trees[k][-1][0], top[-1][0], [x for a, b in way for x in (*a, *b)], now))
    return sorted(out, key=str)


def got(docs, change=None, **kw):
    now = leaf_hash([*map(F.col, COLUMNS[:-1]), change]) if change is not None else None
    m = manifest(docs, leaf_hash(map(F.col, COLUMNS)), now, **kw)
    rows = proofs(m).collect()
    assert all(r.root == m.root and r.proof_sha256 == H(r.siblings) for r in rows)
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.siblings, r.folded_root) for r in rows), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    texts = [f"text {i}\nline" for i in range(400)] + AWKWARD
    rows = [(i, t, None if i % 17 == 0 else "hot" if i % 3 else f"s{i % 23}é", "en" if i % 5 else None, len(t or ""), 0.5, "k")
            for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, "x", "hot", None, None, 0.1, "z"), (None, None, "hot", None, None, 0.1, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, root double, key string").repartition(5, "doc_id")


@pytest.mark.parametrize("levels,arity", [(8, 3), (2, 3), (1, 2), (3, 5)])
def test_against_plain_trees(docs, levels, arity):
    """Blocks of 2 to 6,561 leaves; null sources and ids, repeated rows, long and empty texts, clashing columns."""
    rows = [r.asDict() for r in docs.collect()]
    assert got(docs, levels=levels, arity=arity) == brute(rows, arity)


def test_tampering_is_found(docs):
    rows = [r.asDict() for r in docs.collect()]
    cut = lambda r: r | {"text": r["text"] and r["text"].replace("\n", "")}
    out = got(docs, change=F.replace("text", F.lit("\n"), F.lit("")), levels=2)
    assert out == brute(rows, 3, cut)
    assert any(x[5] != x[3] for x in out) and any(x[5] == x[3] for x in out)


def test_small_and_empty(spark):
    for n in (1, 2, 3, 4):
        one = make_docs(spark, ["a"] * n).withColumn("source", F.lit("s"))
        assert got(one) == brute([r.asDict() for r in one.collect()], 3)
    each = make_docs(spark, ["a"] * 5).withColumn("source", F.col("doc_id").cast("string"))
    assert got(each, levels=1) == brute([r.asDict() for r in each.collect()], 3)
    empty = make_docs(spark, ["a"]).limit(0)
    assert got(empty) == []


def test_octopus_is_the_least_union():
    """Every path can be hashed from the known leaves and the missing nodes, and no missing node can be derived."""
    rng = random.Random(3)
    for _ in range(200):
        n, arity = rng.randrange(1, 90), rng.randrange(2, 5)
        known = set(rng.sample(range(n), rng.randrange(1, n + 1)))
        need, sizes = missing(known, n, arity), widths(n, arity)
        assert len(set(need)) == len(need)
        have = {(0, i) for i in known}
        derived = set(have)
        for level, width in enumerate(sizes[:-1]):
            on_paths = {i // arity ** level for i in known}
            every = {i for r in {i // arity for i in on_paths} for i in range(r * arity, min(r * arity + arity, width))}
            fetched = {i for at, i in need if at == level}
            assert fetched == every - on_paths and not fetched & {i for at, i in derived if at == level}
            derived |= {(level + 1, i // arity) for i in on_paths}
