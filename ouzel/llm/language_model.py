"""LM scoring: a hierarchical Pitman-Yor bigram model.

Every context (the word before, or the end of the text before it) is a
restaurant, all sharing one parent, the unigram restaurant, whose base is uniform
over the training vocabulary and one unknown word:

    P(w | u) = (max(c_uw - d t_uw, 0) + (theta + d T_u) P(w)) / (theta + c_u)
    P(w)     = (c_0w - d0 t_0w + (theta0 + d0 T_0) H) / (theta0 + C_0),  c_0w = sum_u t_uw

c are customers (training counts), t tables; each table sends one customer to the
parent. The seating is sampled by Gibbs: in a sweep the tables of every dish are
drawn given the parent's probabilities and the other tables of the restaurant,
from p(t) ~ S_d(c, t) P(w)^t prod_{i<t} (theta + d (T + i)) with generalised
Stirling numbers S, from their recurrence for up to ``EXACT`` customers and from a contour
integral (``log_sizes``) for more, so the draw is exact at any number of customers.
The dishes of a sweep are drawn side by side, as in other distributed samplers.
After ``burn`` sweeps the predictive probabilities of ``samples`` sweeps are averaged.

How the work is dealt. Nothing is one row per token: texts become blocks (word
hashes and token indices, packed arrays), and what is exchanged are packed
messages between block, restaurant shard and word part.
* ``blocks``      texts -> blocks, written bucketed by block;
* ``word_counts`` (block, word) counts meet by ranges of the word's hash: exact
                  training counts c, their number N and the vocabulary V;
* ``shards``      distinct (context, word) of each block meet by context: types and
                  counts, and for each block the places of its types (``routes``);
                  written bucketed by shard, so later steps do not shuffle them;
* sweeps          shard -> word part: tables per word; word part -> shard: the
                  parent's seating. Only types with two customers or more take part,
                  the others always have one table;
* scores          shard -> block: the averaged probability of each of its types.
A context with more than ``HOT`` tokens is split over shards by word; such
contexts (at most N / HOT) are the one thing the driver holds by name.

Words are told apart by 64-bit hashes for the counts and by 32-bit hashes as
restaurants and dishes of the model.

Defined results: null text is empty, and an empty text is one end token; repeated
rows are scored each; without training rows the model is the uniform base; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import fold, pack, pack_sorted, table, unpack, unpack_sorted, utf8, written
from ouzel.session import shared_dir

BLOCK = 1 << 20        # tokens of a block
SHARD = 1 << 20        # training and held-out tokens for each restaurant shard
PART = 1 << 20         # (block, word) entries for each word part
HOT = 1 << 20          # tokens of a context that is split over shards
EXACT = 64             # customers of a dish whose Stirling numbers come from their recurrence, beyond from an integral
ANGLE, NODES = 0.6, 40 # of the integral's contour
STEPS = 48             # tables tried one by one; of wider distributions:
KNOTS, CELLS = 17, 256 # places where the weights are worked out, and cells
TERMS = 16             # of the alternating sum
THETA, THETA0 = 1.0, 10.0
END = b""              # no word is empty

BLOCKS = ("block long, n_tokens long, n_words long, row array<long>, doc_id array<long>, held array<boolean>, "
          "size array<long>, lead array<long>, words binary, tokens binary")
MESSAGE = "kind string, hot long, s long, r long, a binary, b binary"
MESSAGES = pa.schema([("kind", pa.string()), ("hot", pa.int64()), ("s", pa.int64()), ("r", pa.int64()),
                      ("a", pa.binary()), ("b", pa.binary())])


def bucketed(df: DataFrame, name: str, n: int, *keys: str) -> DataFrame:
    """``df`` written to the shared folder in ``n`` buckets by ``keys``: later joins on them leave it in place."""
    own = f"ouzel_{name}_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(n, *keys).option("path", shared_dir(df.sparkSession, name)).format("parquet").saveAsTable(own))
    return df.sparkSession.table(own)


def with_messages(rows: DataFrame, messages: DataFrame, n: int, *keys: str) -> DataFrame:
    """``rows`` (bucketed by ``keys``) with ``inbox``: the messages to each, in no order."""
    inbox = messages.repartition(n, *keys).groupBy(*keys).agg(F.collect_list(F.struct("kind", "r", "a", "b", *(
        c for c in ("hot", "s") if c not in keys))).alias("inbox"))
    return rows.join(inbox, list(keys), "left")


def messages(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(MESSAGES)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(cols, MESSAGES)], schema=MESSAGES)


def each_row(it: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: a batch may hold several blocks."""
    for b in it:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


# ---------------------------------------------------------------- texts to blocks

class Numbered(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def blocks(docs: DataFrame, limit: int = BLOCK) -> DataFrame:
    """Blocks of at most ``limit`` tokens of (doc_id, held, text); a longer text goes on in the next block.

    ``row``: a number of the input row; ``lead``: the token before each piece."""
    def flush(part: int, number: int, known: Numbered, pieces: list, tokens: list) -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in known], np.uint64)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        t = rank[np.concatenate(tokens)]
        row, doc_id, held, size, lead = map(list, zip(*pieces))
        values = (part << 32 | number, len(t), len(hashes), row, doc_id, held, size, rank[lead].tolist(),
                  pack_sorted(hashes[order]), pack(t))
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.bool_())] + [pa.list_(pa.int64())] * 2 + [pa.binary()] * 2
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, row, have = TaskContext.get().partitionId(), 0, 0, 0
        known, pieces, tokens = Numbered(), [], []
        for b in it:
            for doc_id, held, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                words = text.lower().split()
                words.append(END)
                for at in range(0, len(words), limit):
                    piece = words[at:at + limit]
                    if have and have + len(piece) > limit:
                        yield flush(part, number, known, pieces, tokens)
                        known, pieces, tokens, have, number = Numbered(), [], [], 0, number + 1
                    pieces.append((part << 32 | row, doc_id, held, len(piece), known[words[at - 1] if at else END]))
                    tokens.append(np.fromiter(map(known.__getitem__, piece), np.uint32, len(piece)))
                    have += len(piece)
                row += 1
        if have:
            yield flush(part, number, known, pieces, tokens)

    return docs.mapInArrow(run, BLOCKS)


def training(r: dict) -> np.ndarray:
    """For each token of a block, whether it is learned from."""
    return np.repeat(~np.array(r["held"], bool), r["size"])


# ---------------------------------------------------------------- exact word counts

def word_counts(stored: DataFrame, parts: int, hot: int) -> tuple[DataFrame, int, int, dict[int, int]]:
    """(messages with each block's counts, N, V, {hot context: tokens})."""
    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(it):
            words = unpack_sorted(r["words"])
            c = np.bincount(unpack(r["tokens"], np.uint32)[training(r)], minlength=len(words))
            cut = np.searchsorted(words, part_bounds(parts, 64))
            yield messages([("count", 0, r["block"], p, pack_sorted(words[i:j]), pack(c[i:j].astype(np.uint32)))
                            for p, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if j > i])

    def meet(t: pa.Table) -> pa.Table:
        own = [unpack_sorted(x) for x in t.column("a").to_pylist()]
        words, place = np.unique(np.concatenate(own), return_inverse=True)
        c = np.bincount(place, np.concatenate([unpack(x, np.uint32) for x in t.column("b").to_pylist()])).astype(np.int64)
        cut, part = np.cumsum([0] + [len(o) for o in own]), t.column("r")[0].as_py()
        big = c > hot
        out = [("stat", 0, 0, part, pack(np.array([c.sum(), (c > 0).sum()])), None),
               ("hot", 0, 0, part, pack(words[big] >> np.uint64(32)), pack(c[big]))]
        out += [("count", 0, blk, part, pack(c[place[i:j]]), None)
                for blk, i, j in zip(t.column("s").to_pylist(), cut[:-1].tolist(), cut[1:].tolist())]
        return pa.Table.from_batches([messages(out)])

    sent = stored.select("block", "held", "size", "words", "tokens").mapInArrow(send, MESSAGE)
    got = written(sent.groupBy("r").applyInArrow(meet, MESSAGE), "lm-words")
    total, vocab = 0, 0
    for (a,) in got.where("kind = 'stat'").select("a").toLocalIterator():
        x = unpack(a, np.int64)
        total, vocab = total + int(x[0]), vocab + int(x[1])
    large: dict[int, int] = {}
    for a, b in got.where("kind = 'hot'").select("a", "b").toLocalIterator():
        for g, c in zip(unpack(a, np.uint64).tolist(), unpack(b, np.int64).tolist()):
            large[g] = large.get(g, 0) + c
    return got.where("kind = 'count'"), total, vocab, large


def part_bounds(parts: int, bits: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of ``bits``-bit numbers starts, and the end (inclusive bounds for searchsorted)."""
    starts = [-(-(p << bits) // parts) for p in range(parts)]
    return np.array([*starts, (1 << bits) - 1 if bits == 64 else 1 << bits], np.uint64)


# ---------------------------------------------------------------- restaurants

def types_of(r: dict, words: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """For each token of a block its type: the context's and the word's 32-bit hash."""
    g = words >> np.uint64(32)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    starts = np.cumsum([0] + r["size"][:-1])
    before[starts] = r["lead"]
    return g[before] << np.uint64(32) | g[tokens]


def dealt(keys: np.ndarray, n: int, hot: dict[int, int], limit: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(hot, shard, places) of the ascending ``keys``: by ranges of the context, a hot context by ranges of its words."""
    own = np.ones(len(keys), bool)
    for u, c in hot.items():
        lo, hi = np.searchsorted(keys, np.array([u << 32, (u << 32) + (1 << 32) - 1], np.uint64))
        hi += hi < len(keys) and int(keys[hi]) == (u << 32) + (1 << 32) - 1
        if hi > lo:
            own[lo:hi] = False
            subs = -(-c // limit)
            cut = lo + np.searchsorted(keys[lo:hi] & np.uint64(0xFFFFFFFF), part_bounds(subs, 32))
            for s, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
                if j > i:
                    yield u + 1, s, np.arange(i, j)
    rest = np.flatnonzero(own)
    cut = np.searchsorted(keys[rest] >> np.uint64(32), part_bounds(n, 32))
    for s, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
        if j > i:
            yield 0, s, rest[i:j]


SHARDS = "hot long, s long, keys binary, counts binary, routes array<struct<block: long, places: binary>>, ones long, twos long, types long"


def shards(stored: DataFrame, n: int, hot: dict[int, int], limit: int) -> DataFrame:
    """The types of each shard, their training counts (0: held out only) and the blocks that ask for them."""
    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(it):
            every = types_of(r, unpack_sorted(r["words"]), unpack(r["tokens"], np.uint32))
            learned = training(r)
            seen, c = np.unique(every[learned], return_counts=True)
            keys = np.union1d(seen, every[~learned]) if not learned.all() else seen
            counts = np.zeros(len(keys), np.uint32)
            counts[np.searchsorted(keys, seen)] = c
            for h, s, at in dealt(keys, n, hot, limit):
                yield messages([("types", h, s, r["block"], pack_sorted(keys[at]), pack(counts[at]))])

    def meet(t: pa.Table) -> pa.Table:
        own = [unpack_sorted(x) for x in t.column("a").to_pylist()]
        keys, place = np.unique(np.concatenate(own), return_inverse=True)
        c = np.bincount(place, np.concatenate([unpack(x, np.uint32) for x in t.column("b").to_pylist()])).astype(np.uint32)
        cut = np.cumsum([0] + [len(o) for o in own]).tolist()
        routes = [{"block": blk, "places": pack_sorted(place[i:j].astype(np.uint64))}
                  for blk, i, j in zip(t.column("r").to_pylist(), cut[:-1], cut[1:])]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(),
                 pa.list_(pa.struct([("block", pa.int64()), ("places", pa.binary())])), pa.int64(), pa.int64(), pa.int64()]
        values = (t.column("hot")[0].as_py(), t.column("s")[0].as_py(), pack_sorted(keys), pack(c), routes,
                  int((c == 1).sum()), int((c == 2).sum()), len(keys))
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds)],
                        names=["hot", "s", "keys", "counts", "routes", "ones", "twos", "types"])

    sent = stored.select("block", "held", "size", "lead", "words", "tokens").mapInArrow(send, MESSAGE)
    return sent.groupBy("hot", "s").applyInArrow(meet, SHARDS)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0, by Stirling's series from 8 on."""
    x = np.asarray(x, float)
    less = np.zeros_like(x)
    while (small := x < 8).any():
        less = np.where(small, less + np.log(np.where(small, x, 1.0)), less)
        x = np.where(small, x + 1, x)
    y = 1 / (x * x)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) / x - less


def log_sizes(d: float, n: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log of the chance that ``t`` tables have ``n`` customers together, the size k of each having the chance
    d (1 - d) (2 - d) .. (k - 1 - d) / k!; generalised Stirling numbers are S_d(n, t) = n! / (t! d^t) times it.

    It is the n-th coefficient of (1 - (1 - x)^d)^t, as a contour integral: along a hyperbola around the branch cut
    from 1 on, through the saddle point of the integrand where that is further from 1 than 1/n, so nothing
    cancels. ``NODES`` points give five digits or more from n = ``EXACT`` on (two next to t = n).
    """
    n, t = np.broadcast_arrays(np.asarray(n, float), np.asarray(t, float))
    shape, n, t = n.shape, n.reshape(-1), t.reshape(-1)
    low, high = np.log(1e-2 / n), np.full(len(n), np.log(1 - 1e-9))
    for _ in range(24):                                   # the saddle, z = 1 - x on a log scale
        mid = (low + high) / 2
        z = np.exp(mid)
        under = n / (1 - z) < t * d * z ** (d - 1) / (1 - z ** d)
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    saddle = np.exp((low + high) / 2)
    z = np.minimum(np.maximum(saddle, 1 / n), 0.999999)
    rest = 1 - z ** d
    slope = d * z ** (d - 1) / rest
    bend = (n + 1) / (1 - z) ** 2 - t * (d * (d - 1) * z ** (d - 2) / rest + slope * slope)
    scale = z / (1 - np.sin(ANGLE))
    reach = np.arccosh((np.expm1(np.minimum(38 / n, 50.0)) + scale) / (scale * np.sin(ANGLE)))   # beyond: under 1e-16
    narrow = 10 / np.sqrt(np.maximum(np.abs(bend), 1e-300)) / (scale * np.cos(ANGLE))
    reach = np.where(saddle > 1 / n, np.minimum(reach, narrow), reach)
    at = 1j * reach[:, None] * (np.arange(NODES) + 0.5) / NODES - ANGLE
    way, step = scale[:, None] * (1 + np.sin(at)), scale[:, None] * np.cos(at)
    top = t * np.log(rest) - (n + 1) * np.log1p(-z)
    value = t[:, None] * np.log(1 - np.exp(d * np.log(way))) - (n + 1)[:, None] * np.log(1 - way)
    total = (np.exp(value - top[:, None]) * step).real.sum(1) * reach / NODES / np.pi
    out = top + np.log(np.maximum(total, 1e-300))
    out = np.where(t == n, n * np.log(d), np.where(t > n, -np.inf, out))       # all tables have one customer
    return out.reshape(shape)


class Seating:
    """Draws the number of tables of dishes in a Pitman-Yor restaurant, from its exact conditional."""

    def __init__(self, d: float, theta: float, exact: int = EXACT):
        self.d, self.theta, self.exact = d, theta, exact
        s = np.full((exact + 1, exact + 1), -np.inf)   # log S_d(n, t)
        s[0, 0] = 0.0
        for n in range(1, exact + 1):
            t = np.arange(1, n + 1)
            with np.errstate(divide="ignore"):
                grow = s[n - 1, 1:n + 1] + np.log(np.maximum(n - 1 - t * d, 0.0))
            s[n, 1:n + 1] = np.logaddexp(s[n - 1, :n], grow)
        self.stirling = s
        self.sizes: dict[int, np.ndarray] = {}         # by customers: log_sizes of the coarse grid

    def draw(self, c: np.ndarray, others: np.ndarray, base: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Tables of dishes with ``c`` >= 1 customers, ``others`` tables beside theirs, and parent's probability ``base``."""
        t = np.ones(len(c), np.int64)
        few = np.minimum(c, self.exact + 1)
        order = np.argsort(few, kind="stable")
        cut = np.searchsorted(few[order], np.arange(2, self.exact + 2))
        for n, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist()), 2):
            for at in range(i, j, max(1, (1 << 20) // n)):
                k = order[at:min(j, at + max(1, (1 << 20) // n))]
                new = self.theta + self.d * (others[k][:, None] + np.arange(n))
                weight = self.stirling[n, 1:n + 1] + np.cumsum(np.log(new) + np.log(base[k])[:, None], axis=1)
                t[k] = 1 + np.argmax(weight + rng.gumbel(size=weight.shape), axis=1)
        many = np.flatnonzero(c > self.exact)
        for at in range(0, len(many), 2048):
            k = many[at:at + 2048]
            t[k] = self._many(c[k], self.theta / self.d + others[k], np.log(base[k]), rng)
        return t

    def _log_sizes(self, n: np.ndarray, most: int) -> np.ndarray:
        """``log_sizes`` for distinct ``n`` > EXACT and t = 1 .. ``most``.

        Where t is well below n^d, by the alternating sum over j of C(t, j) gamma(n - jd) / (gamma(-jd) n!), whose
        first terms decide; else by the integral."""
        d, t = self.d, np.arange(1, most + 1)
        terms = np.arange(1, TERMS + 1)
        inverse = np.array([0.0 if float(j * d).is_integer() else 1 / math.gamma(-j * d) for j in terms.tolist()])
        whole = log_gamma(n + 1.0)
        choose = np.array([[(-1) ** j * math.comb(k, j) for k in t.tolist()] for j in terms.tolist()], float)
        scale = log_gamma(n - d) - whole
        parts = np.exp(log_gamma(n[:, None] - terms * d) - whole[:, None] - scale[:, None]) * inverse
        sums = parts @ choose
        easy = t[None, :] * np.power(n, -d, dtype=float)[:, None] <= 0.7
        out = np.where(easy, np.log(np.where(easy, sums, 1.0)) + scale[:, None], 0.0)
        i, k = np.nonzero(~easy)
        for at in range(0, len(i), 8192):
            out[i[at:at + 8192], k[at:at + 8192]] = log_sizes(d, n[i[at:at + 8192]], t[k[at:at + 8192]])
        return out

    def _many(self, c: np.ndarray, room: np.ndarray, log_base: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The draw for many customers: p(t) ~ P(t tables have c customers) base^t gamma(room + t) / t!."""
        out, t = np.ones(len(c), np.int64), np.arange(1, STEPS + 1)
        # the weights from one t to the next grow by base (room + t) / t at most: where they are surely gone
        growth = np.cumsum(log_base[:, None] + np.log(room[:, None] + t) - np.log(t), axis=1)
        gone = growth < np.maximum(growth.max(axis=1, keepdims=True), 0.0) - 32
        last = np.where(gone[:, -1], STEPS - np.argmax(~gone[:, ::-1], axis=1), STEPS + 1) + 1
        for low, most in zip((0, 6, 12, 24), (6, 12, 24, STEPS)):
            k = np.flatnonzero((last > low) & (last <= most))
            if len(k):
                distinct, place = np.unique(c[k], return_inverse=True)
                w = self._log_sizes(distinct, most)[place] + np.cumsum(
                    log_base[k, None] + np.log(room[k, None] + np.arange(most)) - np.log(t[:most]), axis=1)
                out[k] = 1 + np.argmax(w + rng.gumbel(size=w.shape), axis=1)
        k = np.flatnonzero(last > STEPS)
        if len(k):
            out[k] = self._wide(c[k], room[k], log_base[k], rng)
        return out

    def _wide(self, c: np.ndarray, room: np.ndarray, log_base: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """The draw where there may be more than ``STEPS`` tables: weights on a coarse grid, then on ``CELLS`` cells
        of the range that holds them."""
        def weights(sizes: np.ndarray, t: np.ndarray, some) -> np.ndarray:
            return sizes + t * log_base[some, None] + log_gamma(room[some, None] + t) - log_gamma(t + 1.0)

        distinct, place = np.unique(c, return_inverse=True)
        grid = [1]
        while grid[-1] < distinct[-1]:
            grid.append(min(max(grid[-1] + 1, int(grid[-1] * 1.12)), int(distinct[-1])))
        grid = np.array(grid)
        sizes = np.full((len(distinct), len(grid)), -np.inf)
        for i, n in enumerate(distinct.tolist()):
            if n not in self.sizes:
                self.sizes[n] = log_sizes(self.d, n, grid[:np.searchsorted(grid, n, side="right")])
            own = self.sizes[n][:len(grid)]
            sizes[i, :len(own)] = own
        out = np.ones(len(c), np.int64)
        knots = np.cos(np.pi * (np.arange(KNOTS) + 0.5) / KNOTS)
        to_series = 2 / KNOTS * np.cos(np.pi * np.outer(np.arange(KNOTS), np.arange(KNOTS) + 0.5) / KNOTS)
        to_series[0] /= 2
        for at in range(0, len(c), 256):
            k = np.arange(at, min(at + 256, len(c)))
            w = weights(sizes[place[k]], grid[None, :], k)
            likely = w > w.max(axis=1, keepdims=True) - 22
            low = grid[np.maximum(np.argmax(likely, axis=1) - 1, 0)].astype(float)
            high = np.minimum(grid[np.minimum(len(grid) - np.argmax(likely[:, ::-1], axis=1), len(grid) - 1)], c[k]).astype(float)
            half = np.maximum((high - low) / 2, 0.5)
            # the log weights are smooth in t: a Chebyshev series through KNOTS places, read off at the cells
            t = np.minimum(low[:, None] + half[:, None] * (1 + knots), c[k][:, None])
            series = to_series @ weights(log_sizes(self.d, c[k][:, None], t), t, k).T
            step = np.maximum((high - low) / (CELLS - 1), 1.0)
            t = np.floor(low[:, None] + np.arange(CELLS) * step[:, None] + 0.5)
            there = t <= high[:, None]
            w = np.polynomial.chebyshev.chebval(((t - low[:, None]) / half[:, None] - 1).T, series, tensor=False).T
            got = t[np.arange(len(k)), np.argmax(np.where(there, w, -np.inf) + rng.gumbel(size=w.shape), axis=1)]
            # beyond CELLS values: one drawn evenly from the cell around the value, a small part of the deviation wide
            got = np.where(step > 1, np.floor(got + (rng.random(len(k)) - 0.5) * step + 0.5), got)
            out[k] = np.clip(got, 1, c[k]).astype(np.int64)
        return out


class Shard:
    """The types of one restaurant shard. Types with one customer have one table."""

    def __init__(self, r: dict, parts: int):
        self.hot, self.s = r["hot"], r["s"]
        self.keys, self.c = unpack_sorted(r["keys"]), unpack(r["counts"], np.uint32).astype(np.int64)
        self.context, self.word = self.keys >> np.uint64(32), self.keys & np.uint64(0xFFFFFFFF)
        self.starts = np.flatnonzero(np.concatenate([[True], self.context[1:] != self.context[:-1]])) if len(self.keys) else np.zeros(0, int)
        self.which = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(self.keys))))
        self.multi = np.flatnonzero(self.c > 1)
        self.bounds = part_bounds(parts, 32)

    def tables(self, multi: np.ndarray | None) -> np.ndarray:
        t = (self.c > 0).astype(np.int64)
        if multi is not None:
            t[self.multi] = multi
        return t

    def by_context(self, x: np.ndarray, hot: dict | None = None) -> np.ndarray:
        """Sums per context, for each type; a hot context's sum is over all its shards."""
        if self.hot and hot:
            return np.full(len(x), hot[self.hot - 1])
        return np.add.reduceat(x, self.starts)[self.which]

    def words(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """(distinct words of the types ``at``, each type's place among them, (part, from, to) of the words)."""
        words, place = np.unique(self.word[at], return_inverse=True)
        cut = np.searchsorted(words, self.bounds).tolist()
        return words, place, [(p, i, j) for p, (i, j) in enumerate(zip(cut[:-1], cut[1:])) if j > i]

    def ask(self, kind: str, at: np.ndarray, tables: np.ndarray | None) -> list[tuple]:
        """Messages to the word parts: the words of the types ``at``, and the sums of their tables."""
        words, place, cut = self.words(at)
        n = np.bincount(place, tables, len(words)).astype(np.uint32) if tables is not None else np.zeros(len(words), np.uint32)
        return [(kind, self.hot, self.s, p, pack_sorted(words[i:j]), pack(n[i:j])) for p, i, j in cut]

    def answers(self, inbox: list[dict], kind: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(customers, tables) in the parent of the word of each type ``at``."""
        words, place, cut = self.words(at)
        got, c, t = {m["r"]: m for m in inbox if m["kind"] == kind}, np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for p, i, j in cut:
            c[i:j], t[i:j] = unpack(got[p]["a"], np.uint32), unpack(got[p]["b"], np.uint32)
        return c[place], t[place]


class Parent:
    """The unigram restaurant's totals."""

    def __init__(self, vocab: int, d: float, customers: float = 0.0, tables: float = 0.0):
        self.vocab, self.d, self.customers, self.tables = vocab, d, customers, tables

    def p(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        rest = (THETA0 + self.d * self.tables) / (self.vocab + 1)
        return (np.maximum(c - self.d * t, 0.0) + rest) / (THETA0 + self.customers)


def discount(ones: float, twos: float) -> float:
    """From the numbers of types with one and two customers."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5


class Model:
    """The sampled seating: shards, the words' seating of each kept sweep, and the totals."""

    def __init__(self, stored: DataFrame, n: int, parts: int, vocab: int, hot: dict[int, int], seed: int):
        self.shards, self.n, self.parts, self.vocab, self.hot, self.seed = stored, n, parts, vocab, hot, seed
        x = stored.agg(F.sum("ones"), F.sum("twos")).first()
        self.d = discount(x[0] or 0, x[1] or 0)
        self.sweeps: list[dict] = []    # tables (messages), words (messages), parent, hot tables

    def _exchange(self, sent: DataFrame, state: DataFrame | None, first: bool, number: int, parent: Parent) -> dict:
        """Word parts: add up the tables sent, seat them in the parent, answer the shards."""
        vocab, seed = self.vocab, self.seed

        def meet(t: pa.Table) -> pa.Table:
            rows = t.to_pylist()
            part = rows[0]["r"]
            old = [r for r in rows if r["kind"] == "state"]
            sent = [(unpack_sorted(r["a"]), r) for r in rows if r["kind"] == "tables"]
            fixed = [(unpack_sorted(r["a"]), r) for r in rows if r["kind"] == "fixed"]
            if old:
                words, single = unpack_sorted(old[0]["a"]), unpack(old[0]["b"], np.uint32).astype(np.int64)
            else:
                words = np.unique(np.concatenate([w for w, _ in fixed + sent]))
                single = np.zeros(len(words), np.int64)
                for w, r in fixed:
                    single[np.searchsorted(words, w)] += unpack(r["b"], np.uint32)
            c = single.copy()
            for w, r in sent:
                c[np.searchsorted(words, w)] += unpack(r["b"], np.uint32)
            d = parent.d
            tables = (c > 0).astype(np.int64)
            if not first:
                live = np.flatnonzero(c > 1)
                rng = np.random.default_rng([seed, number, part])
                tables[live] = Seating(d, THETA0).draw(c[live], np.full(len(live), max(parent.tables - 1, 0.0)),
                                                       np.full(len(live), 1.0 / (vocab + 1)), rng)
            out = [("stat", 0, 0, part, pack(np.array([c.sum(), tables.sum(), (c == 1).sum(), (c == 2).sum()])), None),
                   ("seating", 0, 0, part, pack(c.astype(np.uint32)), pack(tables.astype(np.uint32)))]
            if not old:
                out.append(("state", 0, 0, part, pack_sorted(words), pack(single.astype(np.uint32))))
            for w, r in sent:
                at = np.searchsorted(words, w)
                out.append(("parent", r["hot"], r["s"], part, pack(c[at].astype(np.uint32)), pack(tables[at].astype(np.uint32))))
            return pa.Table.from_batches([messages(out)])

        both = sent.where("kind in ('tables', 'fixed')")
        if state is not None:
            both = both.union(state)
        got = written(both.groupBy("r").applyInArrow(meet, MESSAGE), "lm-parent")
        x = np.zeros(4)
        for (a,) in got.where("kind = 'stat'").select("a").toLocalIterator():
            x += unpack(a, np.int64)
        d = discount(x[2], x[3]) if first else parent.d
        return {"words": got, "parent": Parent(vocab, d, x[0], x[1])}

    def sample(self, burn: int, samples: int) -> None:
        parts, d, seed, hot = self.parts, self.d, self.seed, self.hot

        def opening(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in each_row(it):
                s = Shard(r, parts)
                one = np.flatnonzero(s.c == 1)
                zero = np.flatnonzero(s.c == 0)   # their words are known to the parts too
                yield messages(s.ask("fixed", one, np.ones(len(one))) + s.ask("fixed", zero, None)
                               + s.ask("tables", s.multi, np.ones(len(s.multi))))

        rows = self.shards.select("hot", "s", "keys", "counts")
        step = self._exchange(rows.mapInArrow(opening, MESSAGE), None, True, 0, Parent(self.vocab, 0.5))
        state = step["words"].where("kind = 'state'")
        mine, large = None, self._hot_tables(rows, None)
        for number in range(1, burn + samples + 1):
            parent = step["parent"]

            def sweep(it: Iterator[pa.RecordBatch], parent: Parent = parent, large: dict = large, number: int = number) -> Iterator[pa.RecordBatch]:
                seating = Seating(d, THETA)
                for r in each_row(it):
                    s, inbox = Shard(r, parts), r["inbox"] or []
                    had = next((unpack(m["a"], np.uint32).astype(np.int64) for m in inbox if m["kind"] == "mine"), None)
                    t = s.tables(had)
                    others = s.by_context(t, large)[s.multi] - t[s.multi]
                    base = parent.p(*s.answers(inbox, "parent", s.multi))
                    rng = np.random.default_rng([seed, number, s.hot, s.s])
                    new = seating.draw(s.c[s.multi], others, base, rng)
                    yield messages([("mine", s.hot, s.s, 0, pack(new.astype(np.uint32)), None)] + s.ask("tables", s.multi, new))

            inbox = step["words"].where("kind = 'parent'")
            inbox = inbox.union(mine) if mine is not None else inbox
            sent = written(with_messages(rows, inbox, self.n, "hot", "s").mapInArrow(sweep, MESSAGE), "lm-sweep")
            mine = sent.where("kind = 'mine'")
            step = self._exchange(sent, state, False, number, step["parent"])
            large = self._hot_tables(rows, mine)
            if number > burn:
                self.sweeps.append({"mine": mine, "seating": step["words"].where("kind = 'seating'"), "parent": step["parent"], "hot": large})
        self.state = state

    def _hot_tables(self, rows: DataFrame, mine: DataFrame | None) -> dict[int, int]:
        """Tables of the hot contexts over all their shards."""
        if not self.hot:
            return {}
        parts = self.parts

        def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in each_row(it):
                s = Shard(r, parts)
                had = next((unpack(m["a"], np.uint32).astype(np.int64) for m in r.get("inbox") or []), None)
                yield pa.record_batch([pa.array([s.hot - 1]), pa.array([int(s.tables(had).sum())])], names=["u", "n"])

        own = rows.where("hot > 0")
        own = own if mine is None else with_messages(own, mine.where("hot > 0"), self.n, "hot", "s")
        return {r.u: r.n for r in own.mapInArrow(count, "u long, n long").groupBy("u").agg(F.sum("n").alias("n")).collect()}

    def probabilities(self) -> DataFrame:
        """Messages to the blocks: log10 of the averaged P(w | u) of each of their types, by shard."""
        parts, d, hot = self.parts, self.d, self.hot
        rows = self.shards.select("hot", "s", "keys", "counts", "routes")

        def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in each_row(it):
                s = Shard(r, parts)
                yield messages(s.ask("ask", np.arange(len(s.keys)), None))

        def answer(t: pa.Table) -> pa.Table:
            rows = t.to_pylist()
            words = next(unpack_sorted(r["a"]) for r in rows if r["kind"] == "state")
            seats = {r["kind"]: (unpack(r["a"], np.uint32), unpack(r["b"], np.uint32)) for r in rows if r["kind"].startswith("seating")}
            out = []
            for r in rows:
                if r["kind"] == "ask":
                    at = np.searchsorted(words, unpack_sorted(r["a"]))
                    out += [(k, r["hot"], r["s"], r["r"], pack(c[at]), pack(n[at])) for k, (c, n) in seats.items()]
            return pa.Table.from_batches([messages(out)])

        asked = self.shards.select("hot", "s", "keys", "counts").mapInArrow(ask, MESSAGE).union(self.state)
        own = None
        for i, x in enumerate(self.sweeps):
            asked = asked.union(x["seating"].withColumn("kind", F.lit(f"seating{i}")))
            mine = x["mine"].withColumn("kind", F.lit(f"mine{i}"))
            own = mine if own is None else own.union(mine)
        inbox = asked.groupBy("r").applyInArrow(answer, MESSAGE).union(own)
        parents, larges = [x["parent"] for x in self.sweeps], [x["hot"] for x in self.sweeps]

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in each_row(it):
                s = Shard(r, parts)
                every = np.arange(len(s.keys))
                seated, p = s.by_context(s.c, hot), np.zeros(len(s.keys))
                for i, (parent, large) in enumerate(zip(parents, larges)):
                    t = s.tables(next(unpack(m["a"], np.uint32).astype(np.int64) for m in r["inbox"] if m["kind"] == f"mine{i}"))
                    base = parent.p(*s.answers(r["inbox"], f"seating{i}", every))
                    p += (np.maximum(s.c - d * t, 0.0) + (THETA + d * s.by_context(t, large)) * base) / (THETA + seated)
                log = np.log10(p / len(parents)).astype(np.float32)
                for to in r["routes"]:
                    yield messages([("p", s.hot, s.s, to["block"], pack(log[unpack_sorted(to["places"]).astype(np.int64)]), None)])

        return with_messages(rows, inbox, self.n, "hot", "s").mapInArrow(run, MESSAGE)


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, held: str = "held", burn: int = 1, samples: int = 2, seed: int = 42, text: str = "text",
          id_col: str = "doc_id", block: int = BLOCK, shard: int = SHARD, part: int = PART, hot: int = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; rows with
    ``held`` are not learned from."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(held), F.lit(False)), F.col(text))
    stored = bucketed(blocks(own, block), "lm-blocks".replace("-", "_"), n, "block")
    sums = stored.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    tokens, entries = sums[0] or 0, sums[1] or 0
    counts, total, vocab, large = word_counts(stored, max(1, -(-entries // part)), hot)
    wide = max(1, -(-tokens // shard))
    types = bucketed(shards(stored, wide, large, hot), "lm_shards", n, "hot", "s")
    model = Model(types, n, wide, vocab, large, seed)
    model.sample(burn, samples)
    inbox = (model.probabilities().select("kind", F.col("r").alias("block"), F.lit(0).cast("long").alias("r"), "hot", "s", "a", "b")
             .union(counts.select("kind", F.col("s").alias("block"), "r", "hot", F.lit(0).cast("long"), "a", "b")))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(it):
            words, t = unpack_sorted(r["words"]), unpack(r["tokens"], np.uint32)
            c = np.concatenate([unpack(m["a"], np.int64) for m in sorted((m for m in r["inbox"] if m["kind"] == "count"), key=lambda m: m["r"])])
            base = np.log10((c + 0.5) / (total + 0.5 * (vocab + 1)))
            keys, place = np.unique(types_of(r, words, t), return_inverse=True)
            p, got = np.zeros(len(keys)), {(m["hot"], m["s"]): m["a"] for m in r["inbox"] if m["kind"] == "p"}
            for h, s, at in dealt(keys, wide, large, hot):
                p[at] = unpack(got[h, s], np.float32)
            starts = np.cumsum([0] + r["size"][:-1])
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip((
                r["row"], r["doc_id"], r["held"], r["size"], np.add.reduceat((c > 0)[t].astype(np.int64), starts),
                np.add.reduceat(base[t], starts), np.add.reduceat(p[place], starts)), schema)], schema=schema)

    pieces = with_messages(stored.drop("n_tokens", "n_words"), inbox, n, "block").mapInArrow(run, SCORED)
    return (pieces.groupBy("row", "doc_id", "held_out")
            .agg(*[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")])
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))


def perplexity(scored: DataFrame, column: str = "score") -> DataFrame:
    """(held_out, perplexity) of the rows of ``score``."""
    return scored.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens")).alias("perplexity"))


def op1_language_model(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold(F.col("doc_id")) == 1).alias("held"), "text")
    return score(docs)
