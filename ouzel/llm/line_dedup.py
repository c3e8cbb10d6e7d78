"""Line dedup: lines found in many documents are dropped everywhere.

Every row is one document. Its lines (split at \\n) are keyed by the stripped,
A-Z lower-cased line; a key's 128-bit hash stands for it. Document frequency
counts each key once per row, pre-aggregated before the shuffle, so a line in a
third of all rows is one row per task. Frequent keys then meet the line
positions in a join salted on both sides (the frequent side is at most
1/min_docs of the distinct keys); only positions are shuffled, and each
document's dropped positions come back as one array.

Defined results: null or empty text is one empty line, kept unless frequent
keys may be empty (``min_chars`` 0); repeated rows count as documents of their
own and get the same text; an empty table gives an empty table; any other
columns, whatever their names, are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import SPACES, hash128, lower_ascii, table

SALTS = 16


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text",
                        id_col: str = "doc_id", out: str = "line_dedup") -> DataFrame:
    """``docs`` with the column ``text`` rebuilt from the lines that stay, then
    ``n_lines`` and ``n_dropped`` (long) inside the struct column ``out``, which
    replaces a column of that name."""
    docs = docs.drop(out)
    others = [c for c in docs.columns if c != text]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("lines"),
        F.array(*hash128(F.col(id_col), F.col(text))).alias("id"))

    keys = F.transform("lines", line_key)
    frequent = (base.select(F.explode(F.array_distinct(keys)).alias("key"))
                .where(F.length("key") >= min_chars)
                .groupBy(F.array(*hash128(F.col("key"))).alias("h")).count()
                .where(F.col("count") >= min_docs)
                .select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    positions = (base.select("id", F.posexplode(keys).alias("pos", "key"))
                 .where(F.length("key") >= min_chars)
                 .select("id", "pos", F.array(*hash128(F.col("key"))).alias("h"),
                         F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")))
    dropped = (positions.join(frequent, ["h", "salt"], "left_semi")
               .groupBy("id").agg(F.collect_set("pos").alias("drop")))

    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("drop", F.array().cast("array<int>")))
    joined = base.join(dropped, "id", "left").select("row", "lines", kept.alias("kept"))
    rebuilt = F.array_join(F.transform("kept", lambda i: F.get(F.col("lines"), i)), "\n")
    cols = [rebuilt.alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    n = F.size("lines").cast("long")
    return joined.select(*cols, F.struct(n.alias("n_lines"), (n - F.size("kept")).alias("n_dropped")).alias(out))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = drop_frequent_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
                      F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
j AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
