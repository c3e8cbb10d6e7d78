"""Decontamination against comparing all windows."""

import random
import re

import pytest

from ouzel.llm import decontaminate as D
from cases import AWKWARD

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(text, items, n=13):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        k = min(n, len(iw))
        for i in range(len(iw) - k + 1) if k else ():
            for j in range(len(w) - k + 1):
                if w[j:j + k] == iw[i:i + k]:
                    hit |= set(range(j, j + k))
                    found.add(item)
    return len(w), sorted(hit), sorted((i for i in found if i is not None), key=str)


@pytest.fixture(scope="module")
def cases(request):
    rng = random.Random(9)
    vocab = request.getfixturevalue("words")[:40]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 5, 12, 13, 14, 30]) if i > 3 else 25)) for i in range(25)]
    items = [(i, t) for i, t in items if len(t.split()) > 4] + [(100, ""), (101, None), (102, "!!"), (None, say(20))]
    items += [(103, items[0][1]), (3, items[1][1] + " " + items[2][1]), (104, "a a a a a a a a a a a a a a a a")]
    texts = [t if t is None or len(t) < 9000 else t[:400] for t in AWKWARD]
    for _ in range(60):
        i, t = rng.choice([x for x in items if x[1]])
        w = t.split()
        a = rng.randrange(0, 3)
        part = " ".join(w[a:len(w) - rng.randrange(0, 3)])
        texts.append(f"{say(rng.randrange(0, 40))}, {part.upper() if rng.random() < .3 else part}. {say(rng.randrange(0, 250))}")
    texts += [" ".join(t for _, t in items if t), "a " * 40, items[0][1], items[0][1] * 2]
    return texts, items


@pytest.mark.parametrize("part_words,group", [(D.PART_WORDS, D.GROUP), (60, D.GROUP), (60, 3000)])
def test_against_all_windows(spark, docs_of, cases, part_words, group, monkeypatch):
    """One automaton; several, walked by large and by small groups of documents."""
    monkeypatch.setattr(D, "GROUP", group)
    texts, items = cases
    docs = docs_of(texts)
    got = D.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), out="h", part_words=part_words)
    assert got.columns == [*docs.columns, "h"]
    hits = 0
    for r in got.collect():
        n, hit, found = plain(r.text, items)
        spans = [i for s in r.h.spans for i in range(s.start, s.end)]
        assert (r.h.n_words, r.h.n_hit, spans, r.h["items"]) == (n, len(hit), hit, found)
        left = [w for i, w in enumerate(words_of(r.text)) if i not in set(hit)] if hit and 20 * len(hit) >= n else words_of(r.text)
        assert words_of(r.h.clean_text) == left
        hits += bool(hit)
    assert hits > 30


words_of = words


def test_long_and_empty(spark, docs_of):
    items = spark.createDataFrame([(1, "w " * 13)], "item_id long, text string")
    r = D.decontaminate(docs_of(["w " * 50_000]), items, out="h").first().h
    assert (r.n_words, r.n_hit, r.clean_text.strip()) == (50_000, 50_000, "")
    assert D.decontaminate(docs_of(["a"]).limit(0), items, out="h").count() == 0
    assert D.decontaminate(docs_of(["a b"]), items.limit(0), out="h").first().h.n_hit == 0


def test_bytes_that_are_not_utf8(spark):
    from pyspark.sql import functions as F
    item = "one two three caf\u00e9 five six seven eight nine ten eleven twelve thirteen"
    raw = [b"\xff\xfe " + item.encode() + b" caf\xc3", item.encode().replace(b"\xc3\xa9", b"\xc3")]
    docs = (spark.createDataFrame(list(enumerate(raw)), "doc_id long, raw binary")
            .select("doc_id", F.col("raw").cast("string").alias("text")))
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r.h for r in D.decontaminate(docs, items, out="h").select("doc_id", "h").collect()}
    assert (got[0].n_words, got[0].n_hit, got[0]["items"]) == (15, 13, [7]) and got[0].clean_text == "\ufffd\ufffd  caf\ufffd"
    assert (got[1].n_words, got[1].n_hit) == (13, 0) and "caf\ufffd" in got[1].clean_text


def test_automata_are_built_in_tasks_and_stored(spark):
    """A file for each part, none of them on the driver; copies of an item are one."""
    items = spark.createDataFrame([(i, " ".join(f"w{i * 40 + k}" for k in range(30))) for i in range(200)] * 2, "item_id long, text string")
    folder, files = D.automata(items, 13, 400)
    assert len(files) > 5
    built = [D.loaded(folder, f) for f in files]
    assert sum(len(a.marks) for a in built) == 200 * 18
    assert {i for a in built for m in a.marks.values() for _, ids in m for i in ids} == set(range(200))
