"""Suffix-array dedup: bytes inside repeated strings of at least ``length`` bytes go.

The array is sparse. Of every ``length`` - ``GRAM`` + 1 neighbouring positions the one
whose GRAM-byte string has the smallest hash is an anchor (all of them, on ties),
so two equal strings of ``length`` bytes hold an anchor at the same place. Only the
suffixes at anchors are sorted: about one in a hundred.

A window that holds its anchor ``d`` bytes from its start is "at distance d". All
windows of an anchor share a core, the GRAM bytes from the anchor on, and lie in
its reach, from the first byte of the farthest window to the last byte of the
nearest one. ``neighbours`` sorts suffixes by leading bytes, then core, then reach:
splitters from a sample deal the suffixes into ranges, each bucket is sorted by the
key's words in turn, and every suffix is compared with the one before and after it,
across the buckets' bounds too. Then
* a suffix whose reach stands twice has all of its windows repeated;
* one whose core stands alone has none;
* the others, at the edges of repeated passages, go on to the next level, where
  the distances are cut into narrower ranges with longer cores (of 25, then of 5),
  and at last into single distances, where core and reach are the window itself.
One row stands in for equal reaches on the way down. No bucket needs all suffixes
of a core at once (splitters go on into the row's own number), so a passage in a
third of all documents is spread over buckets like any other rows.

Strings are compared by two independent 64-bit rolling hashes (128 bits).

Defined results: null text is empty; a text shorter than ``length`` keeps all its
bytes; repeated rows repeat each other; an empty table gives an empty result;
``kept`` is binary, since a cut may fall inside a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import batch, hash128, table, utf8, written

LENGTH, GRAM = 400, 200
STEPS = (25, 5, 1)     # distances in a range of each narrower level; each is a multiple of the next
CHUNK = 1 << 17        # bytes hashed at a time: a worker holds some tens of numbers for each
TEXTS = 256            # texts unpacked at a time
U = np.uint64
KEY = ("lead", "core", "reach")
SAMPLED = 32           # suffixes (or contexts) sampled for each splitter


class Rolling:
    """Hashes of any stretch of a byte array, modulo 2^64, from prefix sums."""

    def __init__(self, seed: int, size: int):
        rng = np.random.default_rng(seed)
        self.letter = rng.integers(1, 2 ** 63, 256, U) * U(2) + U(1)
        base = int(rng.integers(1, 2 ** 61)) * 8 + 5
        self.power = np.cumprod(np.concatenate([[U(1)], np.full(size, base, U)]), dtype=U)
        self.inverse = np.cumprod(np.concatenate([[U(1)], np.full(size, pow(base, -1, 2 ** 64), U)]), dtype=U)

    def prefix(self, s: np.ndarray) -> np.ndarray:
        """Along the last axis, with a leading zero."""
        sums = np.cumsum(self.letter[s] * self.power[:s.shape[-1]], axis=-1, dtype=U)
        return np.concatenate([np.zeros((*s.shape[:-1], 1), U), sums], axis=-1)

    def of(self, before: np.ndarray, after: np.ndarray, start: np.ndarray | int) -> np.ndarray:
        return mix((after - before) * self.inverse[start])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


def salted(x: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """A hash of a hash and a number."""
    return mix(x + (np.atleast_1d(salt).astype(U) + U(1)) * U(0x9E3779B97F4A7C15))


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over x[i : i + width], by doubling."""
    have = 1
    while 2 * have <= width:
        x, have = pick(x[:-have], x[have:]), 2 * have
    return pick(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as numbers in the bytes' order."""
    x = np.zeros(len(at), U)
    for k in range(8):
        x = (x << U(8)) | data[at + k].astype(U)
    return (x ^ U(1 << 63)).view(np.int64)


def anchors(data: np.ndarray, ends: np.ndarray, length: int, one: Rolling, two: Rolling) -> Iterator[dict]:
    """The anchors of texts that stand one after the other in ``data``: (text, pos, lead, core, reach, near, far)."""
    width, none = length - GRAM + 1, np.uint32(0xFFFFFFFF)
    for c in range(0, len(data), CHUNK):
        e, first = min(c + CHUNK, len(data)), max(0, c - width + 1)
        part = data[first:min(len(data), e + length)]
        p1 = one.prefix(part)
        n = len(part) - GRAM + 1
        if n < width:
            continue
        gram = (one.of(p1[:n], p1[GRAM:], np.arange(n)) >> U(32)).astype(np.uint32)
        gram = np.minimum(gram, none - np.uint32(1)) | np.uint32(1)      # zero and the largest value are taken
        low, high = np.searchsorted(ends, [first, first + len(part)], side="left")
        for end in ends[low:high + 1].tolist():                      # strings that run over a text's end
            gram[max(0, end - GRAM + 1 - first):max(0, end - first)] = none
        least = sliding(gram, width, np.minimum)
        for end in ends[low:high + 1].tolist():
            least[max(0, end - length + 1 - first):max(0, end - first)] = 0
        least[max(0, len(data) - length + 1 - first):] = 0
        best = sliding(np.pad(least, width - 1), width, np.maximum)   # the windows that hold each position
        at = np.flatnonzero((gram == best) & (best > 0))
        at = at[(at + first >= c) & (at + first < e)]
        if not len(at):
            continue
        text = np.searchsorted(ends, at + first, side="right")
        begin = np.where(text > 0, ends[text - 1], 0) - first
        end = ends[text] - first
        far, near = np.minimum(width - 1, at - begin), np.maximum(0, length - (end - at))
        lo, hi = at - far, at + length - near
        p2 = two.prefix(part)
        reach = salted(two.of(p2[lo], p2[hi], lo), far * (length + 1) + near)
        yield {"text": text, "pos": at - begin, "lead": leading(part, at), "near": near, "far": far,
               "core": one.of(p1[at], p1[at + GRAM], at).view(np.int64), "reach": reach.view(np.int64)}


def sort_keys(columns: list[np.ndarray]) -> np.ndarray:
    """Rows of long columns as byte strings in the same order."""
    x = np.stack([c.astype(np.int64).view(U) ^ U(1 << 63) for c in columns], axis=1).astype(">u8")
    return np.ascontiguousarray(x).view(f"S{8 * len(columns)}").reshape(-1)


def in_buckets(splitters: np.ndarray | None, columns: dict[str, np.ndarray], share: float = 1.0) -> pa.RecordBatch:
    """The rows with the bucket that their key, and the row's own first number after it, falls in; with
    ``share``, that share of the rows, by a hash of their first number."""
    if share < 1:
        some = salted(columns[list(columns)[len(KEY)]].view(U), 1) < U(int(share * 2 ** 64))
        columns = {k: v[some] for k, v in columns.items()}
    by = list(columns.values())[:len(KEY) + 1]
    bucket = np.zeros(len(by[0]), np.int64) if splitters is None else np.searchsorted(splitters, sort_keys(by), side="right")
    return pa.record_batch([*(pa.array(np.ascontiguousarray(c, np.int64)) for c in columns.values()), pa.array(bucket.astype(np.int32))],
                           names=[*columns, "bucket"])


def row_type(*own: str) -> str:
    return ", ".join(f"{c} long" for c in (*KEY, *own)) + ", bucket int"


def splitters_of(rows: DataFrame, n: int) -> np.ndarray | None:
    """n - 1 splitters from the keys of sampled ``rows``, a bounded number for each splitter."""
    got = rows.select(*rows.columns[:len(KEY) + 1]).collect()
    if not got or n < 2:
        return None
    keys = np.sort(sort_keys(list(np.array(got, np.int64).T)))
    return keys[np.linspace(0, len(keys) - 1, n + 1).astype(int)[1:-1]]


ANCHOR = ("spread", "id1", "id2", "pos", "near", "far")


def anchor_rows(docs: DataFrame, length: int, splitters: np.ndarray | None = None, share: float = 1.0) -> DataFrame:
    """A row for every anchor of (id1, id2, text), or for a ``share`` of them, drawn by a hash of their places, which
    also spreads equal suffixes over buckets, those of one text too."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(1, CHUNK + 2 * length), Rolling(2, CHUNK + 2 * length)
        for b in it:
            for k in range(0, b.num_rows, TEXTS):
                part = b.slice(k, TEXTS)
                texts = utf8(part.column(2))
                data = np.frombuffer(b"".join(texts), np.uint8)
                ends = np.cumsum([len(t) for t in texts])
                ids = [part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
                for a in anchors(data, ends, length, one, two):
                    text = a.pop("text")
                    spread = salted(ids[0][text].view(U), a["pos"]).view(np.int64)
                    yield in_buckets(splitters, {c: a[c] for c in KEY} | {"spread": spread, "id1": ids[0][text], "id2": ids[1][text]}
                                     | {c: a[c] for c in ("pos", "near", "far")}, share)

    return docs.select("id1", "id2", "text").mapInArrow(run, row_type(*ANCHOR))


def verdicts(key: np.ndarray, before: np.ndarray, after: np.ndarray, has_before, has_after) -> tuple:
    """(all windows repeated, goes on to the next level) of suffixes by their neighbours' (lead, core, reach)."""
    core_b, core_a = (before[:, :2] == key[:, :2]).all(1) & has_before, (after[:, :2] == key[:, :2]).all(1) & has_after
    same_b, same_a = core_b & (before[:, 2] == key[:, 2]), core_a & (after[:, 2] == key[:, 2])
    # an edge, or the first or last of equal reaches with another reach of the core beside it
    return same_b | same_a, (core_b & ~same_b) | (core_a & ~same_a)


def neighbours(rows: DataFrame, n: int) -> DataFrame:
    """(kind, the rows' own columns) of suffixes dealt to ``n`` buckets, in suffix order:
    ``all`` windows repeated, or ``on`` to the next level."""
    spark = rows.sparkSession
    own = [c for c in rows.columns if c not in (*KEY, "bucket")]
    sides = [f"{c}{k}" for k in range(3) for c in KEY]
    schema = pa.schema([("kind", pa.string()), *((c, pa.int64()) for c in (*own, "part", *sides))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, bordered = TaskContext.get().partitionId(), None, False

        def out(b: pa.RecordBatch, keys: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            """keys: of the row before (if not the first batch), the rows of ``b``, and the row after (if not the last)."""
            nonlocal bordered
            n, first = b.num_rows, not bordered
            key = keys[not first:][:n]
            before = np.concatenate([key[:1], key[:-1]]) if first else keys[:n]
            after = np.concatenate([key[1:], key[-1:]]) if last else keys[not first:][1:n + 1]
            edge = np.zeros(n, bool)
            has_b, has_a = np.ones(n, bool), np.ones(n, bool)
            if first:
                edge[0], has_b[0] = True, False
            if last:
                edge[-1], has_a[-1] = True, False
            bordered = True
            every, on = verdicts(key, before, after, has_b, has_a)
            for kind, mask in (("all", every & ~edge), ("on", on & ~edge), ("border", edge)):
                at = np.flatnonzero(mask)
                if len(at):
                    cols = [pa.array(np.ascontiguousarray(v[at, c]), mask=None if has is None else ~has[at])
                            if kind == "border" else pa.nulls(len(at), pa.int64())
                            for has, v in ((has_b, before), (None, key), (has_a, after)) for c in range(3)]
                    yield pa.record_batch([pa.array([kind] * len(at)), *b.take(pa.array(at)).columns[len(KEY):len(KEY) + len(own)],
                                           pa.array(np.full(len(at), part)), *cols], schema=schema)

        before = np.zeros((0, 3), np.int64)
        for b in it:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            if held is not None:
                yield from out(held[0], np.concatenate([before, held[1], keys[:1]]), False)
                before = held[1][-1:]
            held = (b, keys)
        if held is not None:
            yield from out(held[0], np.concatenate([before, held[1]]), True)

    dealt = rows.repartitionById(n, F.col("bucket")).sortWithinPartitions(*KEY)
    ddl = "kind string, " + ", ".join(f"{c} long" for c in (*own, "part", *sides))
    found = written(dealt.mapInArrow(run, ddl), "suffix-neighbours")
    # two rows a bucket: the neighbours they lack are the borders of the next buckets that have rows
    borders = found.where("kind = 'border'").collect()
    cols = lambda r, k: tuple(r[f"{c}{k}"] for c in KEY)
    borders.sort(key=lambda r: (r.part, r.lead0 is not None))   # a bucket's first row has none before it
    settled = []
    for i, r in enumerate(borders):
        before = cols(r, 0) if r.lead0 is not None else cols(borders[i - 1], 1) if i else None
        after = cols(r, 2) if r.lead2 is not None else cols(borders[i + 1], 1) if i + 1 < len(borders) else None
        as_array = lambda x: np.array([x or (0, 0, 0)], np.int64)
        every, on = verdicts(as_array(cols(r, 1)), as_array(before), as_array(after), before is not None, after is not None)
        settled += [(k, *(r[c] for c in own)) for k, yes in (("all", every[0]), ("on", on[0])) if yes]
    names = ["kind", *own]
    return (found.where("kind <> 'border'").select(*names)
            .union(spark.createDataFrame(settled, "kind string, " + ", ".join(f"{c} long" for c in own))))


def compressed(docs: DataFrame) -> DataFrame:
    """(id1, id2, doc_id, z): texts as zstd, for the shuffles."""
    schema = pa.schema([("id1", pa.int64()), ("id2", pa.int64()), ("doc_id", pa.int64()), ("z", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k in range(0, b.num_rows, TEXTS):
                part = b.slice(k, TEXTS)
                z = [len(t).to_bytes(8, "little") + pa.compress(t, codec="zstd", asbytes=True) for t in utf8(part.column(3))]
                yield pa.record_batch([*part.columns[:3], pa.array(z, pa.binary())], schema=schema)

    return docs.select("id1", "id2", "doc_id", "text").mapInArrow(run, "id1 long, id2 long, doc_id long, z binary")


def inflated(z: pa.Array) -> list[bytes]:
    return [pa.decompress(x[8:], decompressed_size=n, codec="zstd", asbytes=True) if (n := int.from_bytes(x[:8], "little")) else b""
            for x in z.to_pylist()]


CONTEXT = "id1 long, id2 long, pos long, left int, context binary"


def contexts(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(place, id1, id2, pos, left, context): the reach of each anchor, ``left`` bytes of it before the anchor."""
    schema = pa.schema([("id1", pa.int64()), ("id2", pa.int64()), ("pos", pa.int64()), ("left", pa.int32()), ("context", pa.binary())])
    by_doc = places.groupBy("id1", "id2").agg(F.collect_set("pos").alias("at"))   # at most a text's anchors

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k in range(0, b.num_rows, TEXTS):
                part, rows = b.slice(k, TEXTS), []
                for id1, id2, at, t in zip(*(part.column(i).to_pylist() for i in range(3)), inflated(part.column(3))):
                    for p in at:
                        start = max(0, p - (length - GRAM))
                        rows.append((id1, id2, p, p - start, t[start:p + length]))
                yield batch(rows, schema)

    cut = docs.join(by_doc, ["id1", "id2"]).select("id1", "id2", "at", "z").mapInArrow(run, CONTEXT)
    return cut.withColumn("place", F.monotonically_increasing_id())   # as written


RANGE = ("place", "near", "far")


def narrower(places: DataFrame, length: int, step: int, splitters: np.ndarray | None = None) -> DataFrame:
    """Rows for ranges of ``step`` distances of each context (place, left, context, near, far)."""
    width = length - GRAM    # the anchor's column

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(1, width + length), Rolling(2, width + length)
        for b in it:
            for k in range(0, b.num_rows, 512):
                p = b.slice(k, 512)
                place, left, near, far = (p.column(i).to_numpy().astype(np.int64) for i in (0, 1, 3, 4))
                raw = p.column(2).to_pylist()
                s = np.zeros((len(raw), width + length), np.uint8)
                for i, (x, t) in enumerate(zip(left.tolist(), raw)):
                    s[i, width - x:width - x + len(t)] = np.frombuffer(t, np.uint8)
                right = np.array([len(t) for t in raw]) - left
                low, high = np.maximum(near, length - right), np.minimum(far, left)
                count = np.maximum(high // step - low // step + 1, 0)     # ranges of each context
                i = np.repeat(np.arange(len(raw)), count)
                if not len(i):
                    continue
                nth = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
                d0 = (low[i] // step + nth) * step
                d1 = np.minimum(d0 + step - 1, width)
                lo, hi = np.maximum(d0, low[i]), np.minimum(d1, high[i])
                p1, p2 = one.prefix(s), two.prefix(s)
                c0, c1, r0, r1 = width - d0, width + length - d1, width - hi, width + length - lo
                core = salted(one.of(p1[i, c0], p1[i, c1], c0), d0).view(np.int64)
                reach = salted(two.of(p2[i, r0], p2[i, r1], r0), hi * (length + 1) + lo).view(np.int64)
                yield in_buckets(splitters, {"lead": core, "core": core, "reach": reach, "place": place[i], "near": lo, "far": hi})

    return places.select("place", "left", "context", "near", "far").mapInArrow(run, row_type(*RANGE))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id1, id2, pos, near, far, mask): the windows of (id1, id2, doc_id, text) that are repeated, as the distances
    near .. far from the anchor at ``pos``; with a mask, near + b for each of its bits b."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # an anchor in about half a window's width; the sample is of all suffixes alike, however long or periodic their text
    expected = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * 2 / (length - GRAM + 1)
    share = min(1.0, SAMPLED * n / max(expected, 1.0))
    side = length + 1     # an anchor's place and distances travel as one number
    rows = anchor_rows(docs, length, splitters_of(anchor_rows(docs, length, share=share), n))
    packed = ((F.col("pos") * side + F.col("near")) * side + F.col("far")).alias("packed")
    top = (neighbours(rows.select(*KEY, "id1", "id2", packed, "bucket"), n)
           .select("kind", "id1", "id2", F.expr(f"packed div {side * side}").alias("pos"),
                   F.expr(f"packed div {side} % {side}").alias("near"), (F.col("packed") % side).alias("far")))

    def dealt(places: DataFrame, step: int) -> DataFrame:
        """The narrower level of contexts, each of at most ``length`` rows, by splitters from some of the contexts."""
        some = places.sample(min(1.0, SAMPLED * n / max(places.count(), 1)), 11)
        return neighbours(narrower(places, length, step, splitters_of(narrower(some, length, step), n)), n)

    edges = top.where("kind = 'on'").select("id1", "id2", "pos")
    around = written(contexts(compressed(docs), edges, length), "suffix-contexts")
    own = around.select("place", "id1", "id2", "pos")
    places = around.withColumns({"near": F.lit(0), "far": F.lit(length - GRAM)})
    none, below = F.lit(None).cast("long"), []
    for step in STEPS[:-1]:
        ranges = dealt(places, step)
        below.append(ranges.where("kind = 'all'").select(*RANGE, none.alias("mask")))
        straddling = ranges.where("kind = 'on'").select(*RANGE).distinct()
        # of a context, what the range's windows reach
        cut = F.expr(f"substring(context, cast(left - far + 1 as int), cast(far + {length} - near as int))")
        places = written(around.select("place", "left", "context").join(straddling, "place")
                         .select("place", F.col("far").cast("int").alias("left"), cut.alias("context"), "near", "far"), "suffix-straddling")
    bit = F.col("near") % 60
    below.append(dealt(places, STEPS[-1]).where("kind = 'all'").groupBy("place", (F.col("near") - bit).alias("near"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(near % 60 as int))")).alias("mask"))
                 .select("place", "near", none.alias("far"), "mask"))
    return (top.where("kind = 'all'").select("id1", "id2", "pos", "near", "far", none.alias("mask"))
            .union(reduce(DataFrame.union, below).join(own, "place").select("id1", "id2", "pos", "near", "far", "mask")))


def byte_spans(found: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the merged byte ranges covered by repeated windows of a batch of texts."""
    size = found.value_lengths().fill_null(0).to_numpy()
    text, rows = np.repeat(np.arange(len(size)), size), found.flatten()
    pos, near, far, mask = (rows.field(c).fill_null(-1).to_numpy() if c in ("far", "mask") else rows.field(c).to_numpy()
                            for c in ("pos", "near", "far", "mask"))
    whole = mask == -1                           # a mask has at most 60 bits, so none is -1
    one, bit = np.nonzero(mask[~whole][:, None] >> np.arange(60) & 1)
    single = (pos - near)[~whole][one] - bit
    text = np.concatenate([text[whole], text[~whole][one]])
    start = np.concatenate([(pos - far)[whole], single])
    end = np.concatenate([(pos - near)[whole], single]) + length
    if not len(text):
        return text, start, end
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    shift = text * (int(end.max()) + 1)          # a text's ranges lie behind those of the texts before
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(text) - 1)
    return text[new], start[new], (reach - shift)[last]


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", id_col: str = "doc_id",
                   with_kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept, kept_sha256) for every row; spans are byte ranges, merged;
    ``kept`` holds the bytes that stay."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = own.select(*[h.alias(f"id{i + 1}") for i, h in enumerate(hash128(F.col("doc_id"), F.col("text")))], "doc_id", "text")
    spans = (repeated_spans(keyed, length)
             .groupBy("id1", "id2").agg(F.collect_list(F.struct("pos", "near", "far", "mask")).alias("found")))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", span),
                        ("kept", pa.binary()), ("kept_sha256", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k in range(0, b.num_rows, TEXTS):
                part, rows = b.slice(k, TEXTS), []
                text, start, end = (x.tolist() for x in byte_spans(part.column(1), length))
                i = 0
                for d, (doc_id, t) in enumerate(zip(part.column(0).to_pylist(), inflated(part.column(2)))):
                    at, kept, own = 0, [], []
                    while i < len(text) and text[i] == d:
                        kept.append(t[at:start[i]])
                        own.append({"start": start[i], "end": end[i]})
                        at, i = end[i], i + 1
                    kept = b"".join([*kept, t[at:]]) if own else t
                    rows.append((doc_id, len(t), len(t) - len(kept), own, kept if with_kept else None, hashlib.sha256(kept).hexdigest()))
                yield batch(rows, schema)

    return (compressed(keyed).join(spans, ["id1", "id2"], "left").select("doc_id", "found", "z")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: bigint, end: bigint>>, "
                             "kept binary, kept_sha256 string"))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, then the bytes and the text that stay (a character that is cut is replaced)."""
    out = remove_repeats(table(spark, sf_dir, "documents"), 400)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
                      (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
