"""Importance resampling towards a target distribution, by hashed runs of words.

The features of a text are its runs of 1 to ``runs`` consecutive words, each hashed to
one of ``buckets`` buckets. Two counts, over all documents and over all target
texts, give every bucket a gain: the scaled log ratio of its smoothed shares. The gains
are one array of a fixed size, so a text's weight, the mean gain of its features, is
array look-ups. Gumbel noise that depends on seed and id turns the highest scores
into a draw without replacement in proportion to the weights.

The draw never sorts all scores. A quantile sketch (``percentile_approx``, merged from
the tasks' sketches) brackets the cutoff; one exact count of what lies above the
bracket and in it shows whether the cutoff is inside, and the bracket is widened until it is.
Only the bracket's rows are sorted, by ranges, to find the last row drawn. Rows above the
bracket are drawn without a comparison; they are numbered apart, for their ranks.

Words are runs of digits, letters (A-Z lower-cased) and everything above \\x7F.

Defined results: null text has no words; a text without features weighs 0; null ids
are hashed as the empty text and lose ties; repeated rows are drawn and ranked each;
without targets every share of them is the smoothing's; an empty table gives an empty
result. Texts are read in pieces of ``PIECE`` bytes, so a very long one is never a
list of all its words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import CRC_TABLE, crc32_sql, table, utf8, written
from ouzel.llm.decontaminate import NORMAL
from ouzel.operators.numbering import numbered

BUCKETS, RUNS, SCALE = 10_000, 1, 1000
PIECE = 1 << 20
KNOWN = 400_000        # words whose bucket a worker remembers
EPS = (0.002, 0.02, 1.0)   # half widths of the bracket, as shares of the rows; the last holds all of them
ACCURACY = 10_000


class Codes(dict):
    """The buckets of recent words."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        code = self[word] = zlib.crc32(word) % self.buckets
        return code


def pieces(text: bytes, piece: int | None = None) -> Iterator[list[bytes]]:
    """The words of a text, a list for each of its pieces."""
    at = 0
    text = text.translate(NORMAL)
    while at < len(text):
        end = text.find(b" ", at + (piece or PIECE))
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def codes_of(texts: list[bytes], runs: int, codes: Codes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bucket) of every feature and (words of each text) for stretches of the texts."""
    if len(codes) > KNOWN:
        codes.clear()
    of, words, held = [], [], 0

    def out():
        sizes = np.array([len(w) for w in words], np.int64)
        flat = list(chain.from_iterable(words))
        text, code = np.repeat(np.array(of, np.int64), sizes), np.fromiter(map(codes.__getitem__, flat), np.int64, len(flat))
        return text, code, np.bincount(of, sizes, len(texts)).astype(np.int64) if of else np.zeros(len(texts), np.int64)

    for i, t in enumerate(texts):
        last: list[bytes] = []      # words before the piece that its runs reach back to
        for ws in pieces(t):
            of.append(i)
            words.append(ws)
            held += len(ws)
            if runs > 1:
                ws = last + ws
                long = [zlib.crc32(b" ".join(ws[e - n:e])) % codes.buckets
                        for n in range(2, runs + 1) for e in range(max(n, len(last) + 1), len(ws) + 1)]
                yield np.full(len(long), i), np.array(long, np.int64), np.zeros(len(texts), np.int64)
                last = ws[1 - runs:]
            if held > PIECE // 8:
                yield out()
                of, words, held = [], [], 0
    if of:
        yield out()


def bucket_counts(docs: DataFrame, text: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket: a row for each task's buckets, added up by Spark."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, total = Codes(buckets), np.zeros(buckets, np.int64)
        for b in it:
            for at in range(0, b.num_rows, 256):
                for _, code, _ in codes_of(utf8(b.column(0).slice(at, 256)), runs, codes):
                    total += np.bincount(code, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], schema=schema)

    counts = np.zeros(buckets, np.int64)
    for r in docs.select(F.col(text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n           # at most ``buckets`` rows
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed source share)) of each bucket."""
    m, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(SCALE * math.log((t + 1.0) * (s_all + m) / ((s + 1.0) * (t_all + m))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, runs: int = RUNS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(gain)          # ``buckets`` numbers

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        codes = Codes(len(gain))
        for b in it:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                size = part.num_rows
                words, n, sums = (np.zeros(size, np.int64) for _ in range(3))
                for of, code, w in codes_of(utf8(part.column(1)), runs, codes):
                    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(gain[code])])
                    ends = np.searchsorted(of, np.arange(size + 1))          # texts come in order
                    sums += np.diff(before[ends])
                    n += np.diff(ends)
                    words += w
                yield pa.record_batch([part.column(0), pa.array(words), pa.array(n), pa.array(sums // np.maximum(n, 1))], schema=schema)

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, "id long, n_words long, n_features long, weight long"))


def noise(id_col: str, seed: int):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256("<seed>:<id>")."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def bracket(rows: DataFrame, k: int, n: int, eps: tuple[float, ...] = EPS) -> tuple[int, int, int]:
    """(low, high, rows above high) so that the ``k``-th highest of the ``n`` scores lies in low .. high."""
    at = 1 - k / n
    quantiles = [q for e in eps for q in (max(0.0, at - e), min(1.0, at + e))]
    sketch = rows.agg(F.percentile_approx("score", quantiles, ACCURACY).alias("q")).first().q
    for low, high in zip(sketch[::2], sketch[1::2]):
        above, inside = rows.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < k <= above + inside:
            return low, high, above
    raise AssertionError("the last bracket holds all scores")


def draw(scored: DataFrame, k: int, n: int, eps: tuple[float, ...] = EPS) -> DataFrame:
    """``scored`` (id, score, may_draw, ...), a stored table, with ``rank`` 1 .. k of the rows drawn."""
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select("*", none)
    able = scored.where("may_draw")
    low, high, above = bracket(able, k, n, eps)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    inside = numbered(able.where(F.col("score").between(low, high)), order, out="rank", first=above + 1)
    over = numbered(able.where(F.col("score") > high), order, out="rank", first=1)
    return (over.unionByName(inside.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank"))))
            .unionByName(scored.where(~F.col("may_draw") | (F.col("score") < low)).select("*", none)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, seed: int = 2024, min_words: int = 20, runs: int = RUNS,
             buckets: int = BUCKETS, text: str = "text", target_text: str = "text", id_col: str = "doc_id",
             eps: tuple[float, ...] = EPS) -> DataFrame:
    """(id, n_words, n_features, weight, score, may_draw, rank) of every row: ``percent`` in a hundred of the rows with at
    least ``min_words`` words are drawn, rank 1 the highest score; the others' rank is null."""
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, target_text, runs, buckets))
    scored = written(weighed(docs, gain, runs, text, id_col)
                     .select("*", (F.col("weight") + noise("id", seed)).alias("score"), (F.col("n_words") >= min_words).alias("may_draw")),
                     "resample-scores")
    n = scored.where("may_draw").count()
    return draw(scored, percent * n // 100, n, eps)


def op13_resample(spark, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, seed=2024, min_words=20)
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def _words_sql(source: str) -> str:
    return (f"SELECT *, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words FROM {source}")


ORACLE = f"""
WITH {CRC_TABLE},
d AS MATERIALIZED ({_words_sql('documents')}),
b AS MATERIALIZED ({_words_sql('benchmark')}),
dw AS MATERIALIZED (SELECT doc_id, unnest(words) AS w FROM d),
bw AS MATERIALIZED (SELECT unnest(words) AS w FROM b),
v AS (SELECT w, {crc32_sql('w')} % {BUCKETS} AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc_table),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN v USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN v USING (w) GROUP BY bucket),
g AS (SELECT r.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + {BUCKETS})::DOUBLE
             / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
      FROM (SELECT range AS bucket FROM range({BUCKETS})) r LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
f AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM dw JOIN v USING (w) JOIN g USING (bucket) GROUP BY doc_id),
sc AS (SELECT d.doc_id, coalesce(f.n, 0) AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                         / 4294967296::DOUBLE)))::BIGINT AS score
       FROM d LEFT JOIN f USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM sc WHERE n_features >= 20)
SELECT sc.*, CASE WHEN r.rank <= 10 * (SELECT count(*) FROM r) // 100 THEN r.rank END AS rank FROM sc LEFT JOIN r USING (doc_id)
"""
