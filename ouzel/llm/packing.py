"""Mixture-controlled packing by deficit round-robin.

Every source is a queue: the tokens of its documents, one after the other. A
window takes from each queue its quantum, ``window`` times the queue's target
share; what a quantum has beyond whole tokens is the queue's deficit and is
carried to the next window, and the tokens that the floors leave over go to the
largest deficits, in turn. So every window is full, each queue is within one
token of its share at every window's end, and the state before any window has a
closed form: ``Schedule`` computes it for any stretch of windows from the queues'
lengths alone, in whole numbers. Tasks therefore pack independently; deficits
carry over windows and partitions exactly.

A source named in ``targets`` is a queue of its own, however small (at most ``window`` / 2
may be named); the shares are renormalised whenever a queue runs dry. Of the others, those
whose quantum is under two tokens share one queue, so there are at most ``window`` / 2
queues however many sources there are. That queue serves its sources side by side: a
document stands at the share of its source's tokens that its middle marks, so any
stretch of the queue holds each source in proportion, to within a document.

What is left after the last full window (less than a window) is cut into
sequences of power-of-two length, which need no padding.

Steps: tokenise once (ids go to a table in the shared folder, with each row's
place in its source within the task), add up (task, source), prefix-sum those
narrow rows in two levels, then cut every document at the windows' bounds.

Defined results: null text is empty, and every document ends with the end id; bytes
that are not UTF-8 are read as replacement characters; null sources are one source; null
ids are carried as nulls; repeated rows are packed each; a text of any length is cut at the
windows' bounds; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ouzel.llm.common import batch, batches, table, utf8, written
from ouzel.operators.numbering import running

WINDOW = 4096
STRETCH = 256          # windows whose bounds are computed together
TOKENS = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), ("lead", pa.int64()),
                    ("n", pa.int64()), ("ids", pa.binary())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("source", pa.string())])


class Known(dict):
    """Ids by word; ``learn`` gives those of a word that is not there."""

    def __init__(self, learn: Callable[[bytes], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class Words:
    """Token ids of the white-space separated words of texts, remembered for recent words.

    The tokenizer splits at white space, so the ids of a text are those of its words; it
    lower-cases, so A-Z need not be told apart (but where a special token may be meant);
    and marks after a letter are tokens of their own. Two generations of words are kept.

    A new word of lower-case letters (``PLAIN``) is one piece that normalising leaves as it is, so it
    goes to the tokenizer's byte-pair model at once, its bytes written as that model's letters.
    """

    MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != ord("'"))   # 's and the like are tokens

    PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch      # a-z and the lower-case letters of Latin-1
    # bytes that are no shown characters stand as the characters from 256 on
    LETTERS = {c: 0x100 + i for i, c in enumerate(c for c in range(256) if not (0x20 < c < 0x7F or 0xA0 < c != 0xAD))}

    def __init__(self, path: str, keep: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.keep, self.known, self.old = Tokenizer.from_file(path), keep, Known(self._learn), {}
        self.raw = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.model = self.tokenizer.model
        probes = [x.encode() for x in ("a", "the", "wordsofletters", "über", "señoría", "éàßÿ", "qzxvjk")]
        if any(self._plain(w) != self._any(w) for w in probes):      # another kind of tokenizer
            self.model = None

    @staticmethod
    def of_worker(path: str) -> "Words":
        """The Python worker's own, which it keeps for its next tasks."""
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_kept_words", {})
        if path not in kept:
            kept[path] = Words(path)
        return kept[path]

    def _plain(self, word: bytes) -> bytes:
        """The ids of a word of lower-case letters."""
        text = word.decode() if word.isascii() else word.decode("latin-1").translate(self.LETTERS)
        raw = self.raw
        return b"".join([raw[t.id] for t in self.model.tokenize(text)])

    def _any(self, word: bytes) -> bytes:
        """The ids of any word."""
        e = self.tokenizer.encode([word.decode("utf-8", "replace")], is_pretokenized=True, add_special_tokens=False)
        return np.array(e.ids, "<u4").tobytes()

    def _learn(self, word: bytes) -> bytes:
        """The ids of a word that is not among the recent ones."""
        if (ids := self.old.get(word)) is not None:
            return ids
        if self.model is not None and self.PLAIN(word):
            return self._plain(word)
        stem = word.rstrip(self.MARKS)
        if len(stem) < len(word) and stem[-1:].isalpha() and b"<|" not in word:
            return self.known[stem] + self.known[word[len(stem):]]
        return self._any(word)

    def encode(self, texts: list[bytes], end_id: int) -> list[bytes]:
        """For each text its ids and the end id, as little-endian unsigned 32-bit numbers."""
        if len(self.known) > self.keep:
            self.known, self.old = Known(self._learn), self.known
        end, ids = np.array([end_id], "<u4").tobytes(), self.known.__getitem__
        return [b"".join(map(ids, (t if b"<|" in t else t.lower()).split())) + end for t in texts]


def tokenised(docs: DataFrame, path: str, end_id: int = 2, text: str = "text", source: str = "source",
              id_col: str = "doc_id") -> DataFrame:
    """(part, doc_id, source, lead, n, ids): ``lead`` counts the source's tokens before, in the same task."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, lead = Words.of_worker(path), TaskContext.get().partitionId(), {}
        for b in it:
            for at in range(0, b.num_rows, 1024):
                c = b.slice(at, 1024)
                rows = []
                for doc_id, s, ids in zip(c.column(0).to_pylist(), c.column(1).to_pylist(), words.encode(utf8(c.column(2)), end_id)):
                    n = len(ids) // 4
                    rows.append((part, doc_id, s, lead.get(s, 0), n, ids))
                    lead[s] = lead.get(s, 0) + n
                yield batch(rows, TOKENS)

    return (docs.select(F.col(id_col).cast("long"), F.make_valid_utf8(F.col(source).cast("string")), F.col(text))
            .mapInArrow(run, "part long, doc_id long, source string, lead long, n long, ids binary"))


class Schedule:
    """How many tokens of each queue the first k windows have taken, for any k.

    ``phases``: (first window, tokens taken before it, weights, last window). In a phase
    the queues are served by deficit round-robin in proportion to the weights.
    """

    def __init__(self, tokens: list[int], weights: list[int] | None = None, window: int = WINDOW):
        self.window, self.tokens, self.total = window, list(tokens), sum(tokens)
        self.windows = self.total // window
        self.phases: list[tuple[int, list[int], list[int], int]] = []
        self._rows: dict[int, tuple] = {}   # bounds by stretch
        self._last: dict[int, int] = {}     # the stretch last used by a queue
        taken, k = [0] * len(tokens), 0
        while k < self.windows:
            left = [t - u for t, u in zip(self.tokens, taken)]
            w = [(weights[i] if weights else self.tokens[i]) if n else 0 for i, n in enumerate(left)]
            if not sum(w):   # queues without a target come last, one after the other
                w[next(i for i, n in enumerate(left) if n)] = 1
            last = self.windows
            if weights:
                last = min(self.windows, k + min(n * sum(w) // (window * x) - 1 for n, x in zip(left, w) if x))
            if last > k:
                self.phases.append((k, taken, w, last))
                taken = self._after(taken, w, last - k)
            else:
                taken, last = self._short(left, w, taken), k + 1
                self.phases.append((k, taken, [], last))   # one window: nothing in between to work out
            k = last
        self.ends = taken

    def _after(self, base: list[int], w: list[int], k: int) -> list[int]:
        """Tokens taken after ``k`` windows of a phase: the floors, and one more for the largest deficits."""
        total = sum(w)
        whole, deficit = zip(*(divmod(k * self.window * x, total) for x in w))
        over = k * self.window - sum(whole)
        turn = set(sorted(range(len(w)), key=lambda i: (-deficit[i], i))[:over])
        return [b + n + (i in turn) for i, (b, n) in enumerate(zip(base, whole))]

    def _short(self, left: list[int], w: list[int], taken: list[int]) -> list[int]:
        """One window that empties the queues that cannot fill their quantum; the others share the rest."""
        got, room, open_ = [0] * len(left), self.window, [i for i, x in enumerate(w) if x]
        while room and open_:
            total = sum(w[i] for i in open_)
            dry = [i for i in open_ if left[i] - got[i] <= room * w[i] // total]
            if not dry:
                share = {i: room * w[i] // total for i in open_}
                over = room - sum(share.values())
                for at, i in enumerate(sorted(open_, key=lambda i: (-(room * w[i] % total), i))):
                    got[i] += share[i] + (at < over)
                break
            for i in dry:
                room -= left[i] - got[i]
                got[i] = left[i]
                open_.remove(i)
            if not open_:   # queues without a target fill what is left
                open_ = [i for i in range(len(left)) if left[i] > got[i]]
                w = [n - g for n, g in zip(left, got)]
        return [a + b for a, b in zip(taken, got)]

    def bounds(self, stretch: int) -> tuple[list[list[int]], list[list[int]]]:
        """For each queue: its tokens taken before the windows of a stretch and after the last;
        and where its tokens start in each of these windows."""
        if stretch not in self._rows:
            if len(self._rows) > 64:
                self._rows.clear()
            first = stretch * STRETCH
            rows = np.array([self._at(k) for k in range(first, min(first + STRETCH, self.windows) + 1)], np.int64)
            taken = np.diff(rows, axis=0)
            self._rows[stretch] = rows.T.tolist(), (np.cumsum(taken, axis=1) - taken).T.tolist()
        return self._rows[stretch]

    def _at(self, k: int) -> list[int]:
        before = [0] * len(self.tokens)
        for first, base, w, last in self.phases:
            if k >= last:
                before = self._after(base, w, last - first) if w else base
            elif k > first:
                return self._after(base, w, k - first)
            else:
                break
        return before

    def pieces(self, queue: int, at: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(length, sequence, offset) of each piece of the queue's tokens at .. at + n."""
        end = at + n
        while at < end and at < self.ends[queue]:
            stretch = self._stretch(queue, at)
            bounds, offsets = (x[queue] for x in self.bounds(stretch))
            k = bisect_right(bounds, at) - 1
            while k < len(bounds) - 1 and at < end:
                size = min(bounds[k + 1], end) - at
                if size:
                    yield size, stretch * STRETCH + k, offsets[k] + at - bounds[k]
                at, k = at + size, k + 1
        if at < end:
            # the tail: the queues' rests in order, cut into powers of two, the largest first
            place = sum(t - u for t, u in zip(self.tokens[:queue], self.ends[:queue])) + at - self.ends[queue]
            start, rest, seq = 0, self.total - self.windows * self.window, self.windows
            while rest:
                size = 1 << rest.bit_length() - 1
                if place < start + size and at < end:
                    take = min(start + size - place, end - at)
                    yield take, seq, place - start
                    at, place = at + take, place + take
                start, rest, seq = start + size, rest - size, seq + 1

    def _stretch(self, queue: int, at: int) -> int:
        """The stretch of windows that holds the queue's token ``at``."""
        if (last := self._last.get(queue)) is not None and (b := self.bounds(last)[0][queue])[0] <= at < b[-1]:
            return last
        low, high = 0, (self.windows - 1) // STRETCH
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self._at(mid * STRETCH)[queue] <= at else (low, mid - 1)
        self._last[queue] = low
        return low


def _placed(ids: DataFrame, places: DataFrame, *more: str) -> DataFrame:
    """``ids`` with the columns of ``places``, which has (part, source, ``more``) at most once."""
    own = places.withColumnsRenamed({c: f"{c}_" for c in ("part", "source", *more)})
    same = (F.col("part") == F.col("part_")) & F.col("source").eqNullSafe(F.col("source_"))
    for c in more:
        same = same & (F.col(c) == F.col(f"{c}_"))
    return ids.join(own, same)


def interleaved(docs: DataFrame, sums: DataFrame) -> DataFrame:
    """(part, source, lead, at) of the documents (part, source, lead, n) whose (part, source) is in ``sums``: where
    each starts in one queue that holds all these sources side by side."""
    whole = Window.partitionBy("source")                    # a row for each task that the source is in
    starts = sums.select("part", "source", (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("first"),
                         F.sum("n").over(whole).alias("whole"))
    middle = (F.col("first") + F.col("lead") + F.col("n") / 2) / F.col("whole")
    rows = written(_placed(docs, starts).select("part", "source", "lead", "n", middle.alias("middle")), "packing-pool")
    return running(rows, ["middle", "source", "part", "lead"], "n", out="at").select("part", "source", "lead", "at")


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, targets: dict[str | None, int] | None = None,
                   text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The pieces (columns of ``PIECES``). ``targets``: whole-number weights of sources; a source
    that is not named comes after the named ones have run dry. Default: the sources' own shares."""
    spark = docs.sparkSession
    ids = written(tokenised(docs, path, end_id, text, source, id_col), "packing-ids")
    sums = written(ids.groupBy("part", "source").agg(F.sum("n").alias("n")), "packing-sums")
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    total = by_source.agg(F.sum("n")).first()[0] or 0
    named = list(targets or {})
    if len(named) > window // 2:
        raise ValueError(f"{len(named)} targets: at most {window // 2} sources can be named for windows of {window}")
    own = F.coalesce(F.col("source").isin([x for x in named if x is not None]), F.lit(None in named))
    # at most window / 2 sources have two tokens or more in every window; the others that are not named are pooled
    large = by_source.where(own | (F.col("n") * window >= F.lit(2 * total))).collect()
    large.sort(key=lambda r: (-r.n, r.source or ""))
    pool = total - sum(r.n for r in large)
    while targets is None and large and 0 < pool * window < 2 * total:   # the pool too needs two tokens a window
        pool += large.pop().n
    names = [r.source for r in large]
    queues = [r.n for r in large] + ([pool] if pool else [])
    weights = None
    if targets is not None:
        weights = [targets.get(s, 0) for s in names] + ([0] if pool else [])
        under = [s for s, w in zip(names, weights) if 0 < w * window < 2 * sum(weights)]
        if under:
            raise ValueError(f"a target needs two tokens in a window of {window}: {under}")
    schedule = Schedule(queues, weights, window)

    lookup = spark.createDataFrame(list(zip(names, range(len(names)))), "name string, queue int")   # at most window / 2 rows
    sums = (sums.join(F.broadcast(lookup), F.col("source").eqNullSafe(F.col("name")), "left")
            .select("part", "source", "n", F.coalesce("queue", F.lit(len(names))).alias("queue")))
    single = sums.where(F.col("queue") < len(names))
    # where (part, source) starts in its queue: a row for each task that the source is in
    starts = single.select("part", "source", "queue", (F.sum("n").over(Window.partitionBy("queue").orderBy("part")) - F.col("n")).alias("first"))
    placed = _placed(ids, starts).select("doc_id", "source", "queue", (F.col("first") + F.col("lead")).alias("at"), "n", "ids")
    if pool:
        side = interleaved(ids.select("part", "source", "lead", "n"), sums.where(F.col("queue") == len(names)))
        placed = placed.union(_placed(ids, side, "lead").select("doc_id", "source", F.lit(len(names)).alias("queue"), "at", "n", "ids"))

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, 512):
                yield from batches(rows_of(b.slice(at, 512)), PIECES)

    def rows_of(b: pa.RecordBatch) -> Iterator[tuple]:
        for doc_id, s, q, at, n, raw in zip(*(c.to_pylist() for c in b.columns)):
            start, view = 0, memoryview(raw)
            for size, seq, offset in schedule.pieces(q, at, n):
                yield doc_id, start, size, zlib.crc32(view[4 * start:4 * (start + size)]), n, seq, offset, s
                start += size

    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long, source string")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
