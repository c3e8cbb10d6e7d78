"""Benchmark decontamination by a generalised suffix automaton.

The test items, normalised to words, are put into one suffix automaton over
words. Training words are streamed through it; the state and the matching length
say which runs of item words end at each word. A window is ``window``
consecutive words of an item (all of a shorter item); the automaton's states
that hold a window carry the items it occurs in, so one walk gives the hit words
and the items. Spans of hit words are reported as word positions, and
``clean_text`` cuts them from the text of a document whose hits reach the
coverage limit.

Equal items are one, with all their ids. The items are dealt into parts of about ``part_words``
words; each part's automaton is built in a task of its own and stored in the shared
folder, so the driver sees file names only and nothing is broadcast. A worker holds
one automaton at a time: with several, it reads its documents in groups of ``GROUP`` bytes
and walks a group through one automaton after the other, and a document's spans are merged.

Defined results: null text has no words and no hits; bytes above \\x7F belong to words whether they are
UTF-8 or not (``clean_text`` shows others as replacement characters); items without words match
nothing, null item ids carry no id; repeated items and rows are judged alike; an
empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ouzel.llm.common import filed, read_row, table, utf8, written

# Word characters are digits, letters and everything above \x7F; as a byte table, A-Z lower-cased, others to spaces.
NORMAL = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32
               for c in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PART_WORDS = 200_000
GROUP = 64 << 20     # bytes of texts walked through several automata
HITS = ("n_words bigint, n_hit bigint, items array<bigint>, "
        "spans array<struct<start: bigint, end: bigint>>, clean_text string")
HITS_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("clean_text", pa.string())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """A generalised suffix automaton over words, with the windows marked on its states."""

    def __init__(self, items: list[tuple[list[int], list[bytes]]], window: int):
        """``items``: the ids and the words of each."""
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        coded = [(ids, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for ids, ws in items if ws]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        # marks[state]: (words of a window that the state holds, items it occurs in)
        found: dict[tuple[int, int], set] = {}
        for ids, ws in coded:
            n = min(window, len(ws))
            state = length = 0
            for w in ws:
                state, length = self.step(state, length, w)
                if length >= n:
                    at = state
                    while self.size[self.link[at]] >= n:
                        at = self.link[at]
                    found.setdefault((at, n), set()).update(ids)
        self.marks: dict[int, list[tuple[int, tuple]]] = {}
        for (at, n), ids in found.items():
            self.marks.setdefault(at, []).append((n, tuple(ids)))
        # the nearest state on the way to the root, itself included, that has marks; -1 if none
        self.marked = [-1] * len(self.size)
        for at in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            self.marked[at] = at if at in self.marks else self.marked[self.link[at]]

    def _add(self, size: int, link: int, follow: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(follow)
        return len(self.size) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of the longest run that ends by ``w`` after ``p``, cut off from ``q``."""
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self._add(self.size[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, w: int) -> int:
        if (q := self.next[last].get(w)) is not None:
            return self._split(last, w, q)
        new, p = self._add(self.size[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        follow, link, size = self.next, self.link, self.size
        while state and w not in follow[state]:
            state = link[state]
            length = size[state]
        to = follow[state].get(w)
        return (0, 0) if to is None else (to, length + 1)

    def hits(self, words: list[bytes], items: set, spans: list[list[int]]) -> None:
        """Adds the items whose windows occur in ``words``, and their spans [start, end) as they end."""
        follow, link, size, marked, marks = self.next, self.link, self.size, self.marked, self.marks
        state = length = 0
        for at, w in enumerate(map(self.vocab.get, words)):
            if w is None:
                state = length = 0
                continue
            while state and w not in follow[state]:
                state = link[state]
                length = size[state]
            state = follow[state].get(w, 0)
            if not state:
                length = 0
                continue
            length += 1
            u, longest = marked[state], 0
            while u > 0:
                for n, ids in marks[u]:
                    if n <= length:
                        items.update(ids)
                        longest = max(longest, n)
                u = marked[link[u]]
            if longest:
                start = at + 1 - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, at + 1])


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def without_spans(text: str, spans: list[list[int]]) -> str:
    """``text`` less the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(text)]
    kept, end = [], 0
    for s, e in spans:
        kept.append(text[end:at[s][0]])
        end = at[e - 1][1]
    return "".join(kept) + text[end:]


def automata(items: DataFrame, window: int, part_words: int = PART_WORDS) -> tuple[str, list[str]]:
    """(folder, files): the stored automata, one for each part of the items (item_id, text).

    A part holds about ``part_words`` words; a single item beyond that size is its own part.
    """
    words = F.greatest(F.lit(1), F.octet_length("text") / 4)
    own = items.where("text is not null").groupBy("text").agg(F.collect_set("item_id").alias("ids"))
    own = written(own, "benchmark-items")
    total = own.agg(F.sum(words)).first()[0] or 0
    parts = int(-(-total // part_words)) or 1

    def build(t: pa.Table) -> pa.Table:
        rows = sorted((text, ids) for text, ids in zip(utf8(t.column("text")), t.column("ids").to_pylist()))
        a = Automaton([(ids, words_of(text)) for text, ids in rows], window)
        return pa.table({"automaton": pa.array([pickle.dumps(a.__dict__)], pa.binary())})

    dealt = own.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(parts)))
    return filed(dealt.groupBy("part").applyInArrow(build, "automaton binary"), "automata")


def loaded(folder: str, name: str) -> Automaton:
    a = Automaton.__new__(Automaton)
    a.__dict__.update(pickle.loads(read_row(folder, name)["automaton"]))   # of our own writing
    return a


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, min_coverage: float = 0.05, text: str = "text",
                  part_words: int = PART_WORDS, out: str = "hits") -> DataFrame:
    """``docs`` with a struct column ``out`` (in place of one of that name): n_words, n_hit, items (sorted as texts), spans of
    words, and ``clean_text``: the text without its spans if they cover ``min_coverage`` of the
    words, else the text as it is."""
    docs = docs.drop(out)
    folder, files = automata(items, window, part_words)
    place = docs.columns.index(text)

    def judge(raw: bytes, n_words: int, found: set, spans: list[list[int]]) -> dict:
        spans = merged(spans)
        n_hit = sum(e - s for s, e in spans)
        own = raw.decode("utf-8", "replace")
        dirty = n_hit and n_hit / n_words >= min_coverage
        return {"n_words": n_words, "n_hit": n_hit, "items": sorted(found, key=str),
                "spans": [{"start": s, "end": e} for s, e in spans], "clean_text": without_spans(own, spans) if dirty else own}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = loaded(folder, files[0]) if len(files) == 1 else None

        def walked(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = [utf8(p.column(place)) for p in parts]
            state = [[[0, set(), []] for _ in ts] for ts in texts]      # words, items and spans of each text
            for name in files or [None]:
                a = only or (loaded(folder, name) if name else None)
                for ts, ss in zip(texts, state):
                    for raw, x in zip(ts, ss):
                        words, own = words_of(raw), []
                        x[0] = len(words)
                        if a is not None:
                            a.hits(words, x[1], own)
                            x[2] += own
                del a
            for p, ts, ss in zip(parts, texts, state):
                hits = pa.array([judge(raw, *x) for raw, x in zip(ts, ss)], HITS_ARROW)
                yield pa.record_batch([*p.columns, hits], names=[*p.schema.names, out])

        group, size = [], 0
        for b in it:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                group.append(part)
                size += part.column(place).nbytes
                if len(files) < 2 or size >= GROUP:
                    yield from walked(group)
                    group, size = [], 0
        if group:
            yield from walked(group)

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(out, StructType.fromDDL(HITS)))


def is_contaminated(hits: str = "hits"):
    """The rule of the judged column: some hit, and at least a twentieth of the words."""
    return (F.col(f"{hits}.n_hit") > 0) & (20 * F.col(f"{hits}.n_hit") >= F.col(f"{hits}.n_words"))


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), "text")


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, benchmark_items(spark, sf_dir), window=13)
    return out.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.transform("hits.items", lambda i: i.cast("string")), ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))
