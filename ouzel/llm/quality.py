"""Quality classifier: a factorisation machine.

Features of a text: its hashed distinct words with log-scaled, length-normalised
weights, and structure statistics in bins (shares of upper case, digits,
punctuation, marks and bars, distinct words, the commonest word, repeated
neighbours, line and word lengths, size), and up to ``N_META`` numeric metadata columns of the
row, in bins of their logarithm (here ``n_chars``; labels, lang, source and doc_id are
barred). Every pair of features interacts
through the product of their low-rank factors; by the sum-of-squares identity
    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]
scoring is linear in the number of features.

The model is fitted on a bounded, documented sample: the ``sample`` labelled
training documents with the smallest hash of their id, one row of each (of several the one
with the smallest hash). Their features are made in Spark, and one task fits the model by AdaGrad on the logistic loss. All rows are
scored from their whole texts; the broadcast model has a fixed size.

Defined results: null text is empty and has a score; null metadata is a bin of its own; without
labels every score is 0.5; rows whose label is null are not learned from, repeated labels of a
document count once by their largest; other columns are passed through.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ouzel.llm.common import fold, free_name, pack, table, unpack, utf8

BUCKETS, RANK, BINS = 1 << 16, 8, 24
SAMPLE = 20_000
MARKS = b"#$%&*+=<>@^_~\\{}[]`"
UPPER, LOWER, DIGIT = (np.array([a <= c <= b for c in range(256)]) for a, b in ((65, 90), (97, 122), (48, 57)))
SPACE = np.array([c in b" \t\n\x0b\x0c\r" for c in range(256)])
MARK = np.array([c in MARKS for c in range(256)])
WIDE = np.array([c >= 128 for c in range(256)])
N_STATS, N_META = 16, 4
META = ("n_chars",)
SIZE = BUCKETS + (N_STATS + N_META) * BINS


def statistics(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """``N_STATS`` numbers, each between 0 and 1."""
    b = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    n, nw = max(len(raw), 1), max(len(words), 1)
    letters = b[UPPER | LOWER | WIDE].sum()
    lines = raw.split(b"\n")
    same = sum(map(bytes.__eq__, words, words[1:]))
    tail = Counter(w[-1:] for w in words)
    return [
        b[UPPER].sum() / max(b[UPPER | LOWER].sum(), 1), b[DIGIT].sum() / n, b[MARK].sum() / n,
        b[ord("|")] / nw, b[ord("!")] / nw, (n - letters - b[DIGIT].sum() - b[SPACE].sum()) / n, b[WIDE].sum() / n,
        len(counts) / nw, max(counts.values(), default=0) / nw, same / nw,
        min(1.0, letters / nw / 20), min(1.0, math.log1p(len(raw)) / 16), min(1.0, nw / len(lines) / 200),
        (len(lines) - len(set(lines))) / len(lines), sum(map(bytes.isupper, words)) / nw,
        max((c for t, c in tail.items() if not t.isalnum() and t < b"\x80"), default=0) / nw,
    ]


def meta_bin(v: float | None) -> int:
    """0 for null, else by the logarithm."""
    return 0 if v is None else 1 + min(BINS - 2, int(math.log1p(max(v, 0.0)) / 16 * (BINS - 1)))


def features(raw: bytes, codes: dict[bytes, int], meta: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values). ``codes`` remembers the bucket of recent words; ``meta``: the row's metadata."""
    words = raw.split()
    counts = Counter(words)
    if len(codes) > 300_000:
        codes.clear()
    for w in counts:
        if w not in codes:
            codes[w] = zlib.crc32(w.lower()) % BUCKETS
    stats = np.clip((np.array(statistics(raw, words, counts)) * BINS).astype(np.int64), 0, BINS - 1)
    x = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    x /= max(math.sqrt(float(x @ x)), 1.0)
    bins = np.concatenate([stats, np.array([meta_bin(v) for v in meta], np.int64)])
    idx = np.concatenate([np.fromiter((codes[w] for w in counts), np.int64, len(counts)),
                          BUCKETS + BINS * np.arange(len(bins)) + bins])
    return idx, np.concatenate([x, np.full(len(bins), 0.5)])


class Machine:
    """w0 + sum w_i x_i + pairs, by the sum-of-squares identity."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def raw(self, idx: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[idx] * x[:, None]
        s = vx.sum(0)
        return float(self.w0 + self.w[idx] @ x + 0.5 * (s @ s - np.einsum("ij,ij->", vx, vx)))

    def score(self, idx: np.ndarray, x: np.ndarray) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.raw(idx, x)))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], rate: float = 0.1, l2: float = 1e-5, batch: int = 64,
        seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss; at least five passes, and 1,500 steps of ``batch`` rows."""
    rng = np.random.default_rng(seed)
    bad = sum(1 for *_, y in rows if y < 0.5)
    m = Machine(math.log((len(rows) - bad + 1) / (bad + 1)), np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, RANK)))
    gw, gv = np.full(SIZE, 1e-8), np.full((SIZE, RANK), 1e-8)
    steps = max(5 * (-(-len(rows) // batch)), 1500)
    order = np.concatenate([rng.permutation(len(rows)) for _ in range(-(-steps * batch // len(rows)))])
    for k in range(steps):
        part = [rows[i] for i in order[k * batch:(k + 1) * batch]]
        starts = np.cumsum([0] + [len(i) for i, _, _ in part[:-1]])
        row = np.repeat(np.arange(len(part)), [len(i) for i, _, _ in part])
        idx, x = np.concatenate([i for i, _, _ in part]), np.concatenate([x for _, x, _ in part])
        vx = m.v[idx] * x[:, None]
        s = np.add.reduceat(vx, starts)
        z = m.w0 + np.add.reduceat(m.w[idx] * x, starts) + 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - np.array([y for *_, y in part])) / len(part)
        at, inv = np.unique(idx, return_inverse=True)
        gx = (g[row] * x)
        dw = np.bincount(inv, gx) + l2 * m.w[at]
        each = gx[:, None] * (s[row] - vx)
        dv = np.stack([np.bincount(inv, each[:, f]) for f in range(RANK)], axis=1) + l2 * m.v[at]
        gw[at] += dw * dw
        gv[at] += dv * dv
        m.w[at] -= rate * dw / np.sqrt(gw[at])
        m.v[at] -= 0.5 * rate * dv / np.sqrt(gv[at])
        m.w0 -= rate * 0.1 * g.sum()
    return m


def meta_of(docs: DataFrame, meta: tuple[str, ...]) -> Column:
    """The metadata of a row as numbers; a column that the table lacks counts as null."""
    if len(meta) > N_META:
        raise ValueError(f"at most {N_META} metadata columns")
    return F.array(*[F.col(f"`{m}`").cast("double") if m in docs.columns else F.lit(None).cast("double") for m in meta]).cast("array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text", id_col: str = "doc_id",
          meta: tuple[str, ...] = META) -> Machine | None:
    """Fits on at most ``sample`` documents of ``labels`` (doc_id, label 0/1); None without labels."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)   # at most `sample` rows of two numbers
    own = docs.select(F.col(id_col).alias("doc_id"), F.struct(F.coalesce(F.col(text), F.lit("")).alias("text"), meta_of(docs, meta).alias("meta")).alias("row"))
    rows = (own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
            .agg(F.first("label").alias("label"), F.min_by("row", F.struct(F.xxhash64("row.text"), F.col("row.meta"))).alias("row"))
            .select("doc_id", "row.text", "label", "row.meta"))

    def featurise(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[bytes, int] = {}
        for b in it:
            made = [features(t, codes, m) for t, m in zip(utf8(b.column("text")), b.column("meta").to_pylist())]
            yield pa.record_batch([b.column("doc_id"), b.column("label").cast(pa.float64()),
                                   pa.array([pack(i.astype(np.int32)) for i, _ in made], pa.binary()),
                                   pa.array([pack(x.astype(np.float32)) for _, x in made], pa.binary())],
                                  names=["doc_id", "label", "idx", "x"])

    def learn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list = []
        for b in it:
            got += zip(*(b.column(i).to_pylist() for i in range(4)))
        if got:
            got.sort(key=lambda r: r[:1] + r[2:])
            m = fit([(unpack(i, np.int32).astype(np.int64), unpack(x, np.float32).astype(np.float64), y) for _, y, i, x in got])
            yield pa.record_batch([pa.array([m.w0]), pa.array([pack(m.w)]), pa.array([pack(m.v.reshape(-1))])],
                                  names=["w0", "w", "v"])

    made = rows.mapInArrow(featurise, "doc_id long, label double, idx binary, x binary")
    model = made.repartition(1).mapInArrow(learn, "w0 double, w binary, v binary").collect()
    if not model:
        return None
    w0, w, v = model[0]
    return Machine(w0, unpack(w, np.float64), unpack(v, np.float64).reshape(SIZE, RANK))


def scored(docs: DataFrame, model: Machine | None, text: str = "text", out: str = "quality_score",
           meta: tuple[str, ...] = META) -> DataFrame:
    """``docs`` with the column ``out``, in place of one of that name."""
    docs = docs.drop(out)
    own = free_name(docs, "metadata")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, codes = shared.value, {}
        for b in it:
            s = [0.5 if m is None else m.score(*features(t, codes, x)) for t, x in zip(utf8(b.column(place)), b.column(own).to_pylist())]
            yield pa.record_batch([*b.columns[:-1], pa.array(s, pa.float64())], names=[*b.schema.names[:-1], out])

    return docs.withColumn(own, meta_of(docs, meta)).mapInArrow(run, StructType([*docs.schema.fields]).add(out, "double"))


def quality_labels(spark, sf_dir: str) -> DataFrame:
    """(doc_id, label): ``labels.quality`` of the training folds."""
    return (table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0)
            .select("doc_id", F.col("quality").cast("double").alias("label")))


def predicted(score: str = "quality_score"):
    return F.when(F.col(score) >= 0.3, 1).otherwise(0)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    out = scored(docs, train(docs, quality_labels(spark, sf_dir)))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"),
                      F.col("quality_score").alias("score"), predicted().alias("predicted"))
