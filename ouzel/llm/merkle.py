"""Merkle dataset manifest with octopus multiproofs.

A row is a leaf: the hash of its columns. The leaves of a group (source) are numbered
in their order without a single-task window (``numbered``) and stored in blocks of
``arity ** levels`` neighbours, the leaf partitions: one row each, so none grows with
its source. A block hashes up to its own top node; the tops are nodes of the same
tree, and are put into blocks and climbed in turn until each tree is one node (three
rounds for 10^10 leaves). The groups' roots, in the groups' order, are the leaves of
one more tree, built alike.

Proofs: a block knows its leaves, so what lies below its top it derives itself.
``missing`` lists the coordinates (level, index) of the other nodes that the paths of
its leaves need, each once however many leaves share it; one join fetches
these for all blocks, the block derives the interior nodes that its leaves share, and
expands each leaf's own proof from them.

Hashes are lower-case hex sha256 of the concatenated inputs; a column counts as
``<bytes>:<value>``, a null as ``-``.

Defined results: null groups are one group, and the first; null order values come
first, ties are ordered by the leaf's hash and repeated rows are leaves of their own;
a lone leaf is its group's root, a lone group's root is the root; texts of any
length are hashed whole, inside the JVM; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import CRC_TABLE, batches, crc32_sql, table, written
from ouzel.operators.numbering import numbered

ARITY, LEVELS = 3, 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ hashes and shapes

def digest(parts: Iterable[bytes]) -> bytes:
    """Hex sha256 of the parts, one after the other."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def field(c: Column) -> Column:
    """A column's share of a leaf's input."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def widths(n: int, arity: int = ARITY) -> list[int]:
    """The nodes on each level of a tree of ``n`` leaves, the root's last."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // arity))
    return out


def climb(nodes: list[bytes], steps: int, arity: int = ARITY) -> list[list[bytes]]:
    """The levels above neighbouring ``nodes`` whose first is a run's first on each of them."""
    levels = [nodes]
    for _ in range(steps):
        low = levels[-1]
        levels.append([digest(low[i:i + arity]) for i in range(0, len(low), arity)])
    return levels


def missing(known: Iterable[int], n: int, arity: int = ARITY) -> list[tuple[int, int]]:
    """Octopus: the fewest coordinates (level, index) that lead from the leaves ``known`` to the root of a tree of
    ``n`` leaves: on each level the others of the runs that hold a known node."""
    out = []
    for at, width in enumerate(widths(n, arity)[:-1]):
        have = set(known)
        runs = {i // arity for i in have}
        out += [(at, i) for r in sorted(runs) for i in range(r * arity, min((r + 1) * arity, width)) if i not in have]
        known = runs
    return out


# ------------------------------------------------------------------ trees

NODE = "key string, root boolean, level int, idx long, n long, digest string"
NODES = pa.schema([("key", pa.string()), ("root", pa.bool_()), ("level", pa.int32()), ("idx", pa.int64()), ("n", pa.int64()),
                   ("digest", pa.string())])


def _climber(levels: int, arity: int):
    """Rows (key, level, block, n, nodes) of neighbours -> the nodes above them, up to each block's top."""
    def rows(b: pa.RecordBatch) -> Iterator[tuple]:
        for k in range(b.num_rows):
            key, level, block, n, nodes = (c[k].as_py() for c in b.columns)
            height = len(widths(n, arity)) - 1
            steps = min(levels, height - level)
            for up, above in enumerate(climb([x.encode() for x in nodes], steps, arity)[1:], 1):
                first = block * arity ** (levels - up)
                yield from ((key, level + up == height, level + up, first + i, n, d.decode()) for i, d in enumerate(above))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield from batches(rows(b), NODES)
    return run


def grown(nodes: DataFrame, level: int, widest: int, levels: int = LEVELS, arity: int = ARITY) -> DataFrame:
    """``nodes`` (columns of ``NODE``), all on ``level`` of their trees or roots below it, and all nodes above
    them. ``widest``: the most nodes that a tree has on that level."""
    found = below = nodes
    while widest > 1:
        blocks = (below.where(~F.col("root") & (F.col("level") == level))
                  .groupBy("key", "level", F.floor(F.col("idx") / arity ** levels).cast("long").alias("block"))
                  .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("nodes"))
                  .select("key", "level", "block", "n", F.col("nodes.digest").alias("nodes")))
        below = written(blocks.mapInArrow(_climber(levels, arity), NODE), "merkle-nodes")
        found = found.union(below)
        level, widest = level + levels, -(-widest // arity ** levels)
    return found


def _tops(levels: int, arity: int):
    """Rows (key, block, n, leaves) -> the top node of each block."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for k in range(b.num_rows):
                key, block, n, leaves = (c[k].as_py() for c in b.columns)
                height = len(widths(n, arity)) - 1
                steps = min(levels, height)
                rows.append((key, height <= levels, steps, block, n, climb([x.encode() for x in leaves], steps, arity)[-1][0].decode()))
            yield from batches(rows, NODES)
    return run


@dataclass
class Manifest:
    """``blocks``: (key, block, n, leaves: pos, id, leaf, now); ``nodes``: those from the blocks' tops on, of the
    groups' trees (tier 0) and of the tree over the groups (tier 1); ``groups``: (key, rank); their number; the root."""

    blocks: DataFrame
    nodes: DataFrame
    groups: DataFrame
    n_groups: int
    root: str | None
    levels: int
    arity: int


def manifest(docs: DataFrame, leaf: Column, now: Column | None = None, by: str = "source", order: str = "doc_id",
             levels: int = LEVELS, arity: int = ARITY) -> Manifest:
    """The Merkle manifest of ``docs``, a tree for each value of ``by`` (as hexadecimal bytes, in the same order). ``now``: the leaves' hashes as they are
    found at a later time, kept beside them for ``proofs``."""
    rows = docs.select(F.hex(F.col(by).cast("string").cast("binary")).alias("key"), F.col(order).cast("long").alias("id"), leaf.alias("leaf"),
                       (leaf if now is None else now).alias("now"))
    rows = written(rows.withColumn("now", F.when(F.col("now") != F.col("leaf"), F.col("now"))), "merkle-leaves")
    placed = numbered(rows, ["id", "leaf", "now"], by=["key"], out="pos", size="n")
    blocks = written(placed.groupBy("key", F.floor(F.col("pos") / arity ** levels).cast("long").alias("block"))
                     .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "id", "leaf", "now"))).alias("leaves")),
                     "merkle-blocks")
    tops = written(blocks.select("key", "block", "n", F.col("leaves.leaf").alias("leaves")).mapInArrow(_tops(levels, arity), NODE),
                   "merkle-tops")
    widest = tops.agg(F.max("idx")).first()[0]
    lower = grown(tops, levels, (widest or 0) + 1, levels, arity)
    roots = written(numbered(lower.where("root").select("key", "digest"), ["key"], out="rank"), "merkle-roots")
    n = roots.count()
    upper = grown(roots.select(F.lit(None).cast("string").alias("key"), F.lit(n == 1).alias("root"), F.lit(0).alias("level"),
                               F.col("rank").alias("idx"), F.lit(n).cast("long").alias("n"), "digest"), 0, n, levels, arity)
    root = upper.where("root").select("digest").first()
    nodes = lower.withColumn("tier", F.lit(0)).union(upper.withColumn("tier", F.lit(1)))
    return Manifest(blocks, nodes, roots.select("key", "rank"), n, root and root[0], levels, arity)


# ------------------------------------------------------------------ proofs

WANTED = pa.schema([("key", pa.string()), ("block", pa.int64()), ("rank", pa.int64()), ("tier", pa.int32()), ("level", pa.int32()),
                    ("idx", pa.int64())])
PROOF = ("id long, key string, pos long, leaf string, subroot string, root string, siblings array<string>, "
         "proof_sha256 string, folded_root string")
PROOFS = pa.schema([("id", pa.int64()), ("key", pa.string()), ("pos", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
                    ("root", pa.string()), ("siblings", pa.list_(pa.string())), ("proof_sha256", pa.string()),
                    ("folded_root", pa.string())])


def beside(i: int, node: Callable[[int], bytes], width: int, arity: int) -> tuple[bytes, bytes]:
    """The others of node ``i``'s run: before it, after it."""
    first = i // arity * arity
    return (b"".join(node(k) for k in range(first, i)), b"".join(node(k) for k in range(i + 1, min(first + arity, width))))


def _expander(n_groups: int, levels: int, arity: int, with_siblings: bool):
    def expand(key: str | None, block: int, n: int, leaves: list[dict], rank: int, fetched: list[dict]) -> Iterator[tuple]:
        sizes = widths(n, arity)
        local = climb([x["leaf"].encode() for x in leaves], min(levels, len(sizes) - 1), arity)
        near = [[beside(i, level.__getitem__, len(level), arity) for i in range(len(level))] for level in local[:-1]]
        far = {(f["tier"], f["level"], f["idx"]): f["digest"].encode() for f in fetched}
        # from the block's top on, all its leaves have one way
        way, node, subroot = [], local[-1][0], None
        for tier, i, first, tree in ((0, block, len(local) - 1, sizes), (1, rank, 0, widths(n_groups, arity))):
            for level in range(first, len(tree) - 1):
                way.append(beside(i, lambda k: far[tier, level, k], tree[level], arity))  # noqa: B023
                node, i = digest((way[-1][0], node, way[-1][1])), i // arity
            subroot = subroot or node
        rest, root = b"".join(a + b for a, b in way), node.decode()
        for i, x in enumerate(leaves):
            now, siblings, k = (x["now"] or x["leaf"]).encode(), [], i
            for level in near:
                before, after = level[k]
                siblings += (before, after)
                now, k = digest((before, now, after)), k // arity
            for before, after in way:
                now = digest((before, now, after))
            proof = b"".join(siblings) + rest
            listed = [proof[p:p + 64].decode() for p in range(0, len(proof), 64)] if with_siblings else None
            yield (x["id"], key, x["pos"], x["leaf"], subroot.decode(), root, listed, hashlib.sha256(proof).hexdigest(), now.decode())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k in range(b.num_rows):
                yield from batches(expand(*(c[k].as_py() for c in b.columns)), PROOFS)
    return run


def _asker(n_groups: int, levels: int, arity: int):
    """Rows (key, block, n, rank) -> the coordinates that the paths of the block's leaves lack."""
    def rows(b: pa.RecordBatch) -> Iterator[tuple]:
        for key, block, n, rank in zip(*(c.to_pylist() for c in b.columns)):
            own = arity ** levels
            for tier, known, width in ((0, range(block * own, min((block + 1) * own, n)), n), (1, [rank], n_groups)):
                yield from ((key, block, rank, tier, at, i) for at, i in missing(known, width, arity))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield from batches(rows(b), WANTED)
    return run


def proofs(m: Manifest, with_siblings: bool = True) -> DataFrame:
    """For every leaf (columns of ``PROOF``): its siblings from the leaf to the root, their hash, and the root
    that ``now`` and these siblings fold to."""
    ranks = m.groups.withColumnRenamed("key", "of")
    asked = (m.blocks.select("key", "block", "n").join(ranks, F.col("key").eqNullSafe(F.col("of")))
             .select("key", "block", "n", "rank")
             .mapInArrow(_asker(m.n_groups, m.levels, m.arity), "key string, block long, rank long, tier int, level int, idx long"))
    nodes = m.nodes.select(F.col("key").alias("tree"), "tier", "level", "idx", "digest")
    tree = F.when(F.col("tier") == 0, F.col("key"))
    fetched = (asked.withColumn("wanted_tree", tree)
               .join(nodes, (asked.tier == nodes.tier) & (asked.level == nodes.level) & (asked.idx == nodes.idx)
                     & F.col("wanted_tree").eqNullSafe(F.col("tree")))
               .groupBy("key", "block").agg(F.first("rank").alias("rank"), F.collect_list(
                   F.struct(asked.tier, asked.level, asked.idx, "digest")).alias("fetched"))
               .select(F.col("key").alias("of"), F.col("block").alias("b"), "rank", "fetched"))
    joined = m.blocks.join(fetched, F.col("key").eqNullSafe(F.col("of")) & (F.col("block") == F.col("b")), "left")
    return (joined.select("key", "block", "n", "leaves", F.coalesce("rank", F.lit(0).cast("long")).alias("rank"),
                          F.coalesce("fetched", F.array().cast("array<struct<tier: int, level: int, idx: bigint, digest: string>>")).alias("fetched"))
            .mapInArrow(_expander(m.n_groups, m.levels, m.arity, with_siblings), PROOF)
            .withColumn("key", F.unhex("key").cast("string")))


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    m = manifest(docs, leaf_hash(map(F.col, COLUMNS)), leaf_hash([*map(F.col, COLUMNS[:-1]), tampered]))
    return proofs(m, with_siblings=False).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(m.root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(m.root)).alias("verified"))


def _field_sql(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _up_sql(name: str, base: str) -> str:
    """Nodes (key, level, idx, n, digest), level by level, above those of ``base``."""
    return f"""{name} AS ({base} UNION ALL
  SELECT key, level + 1, idx // {ARITY}, (any_value(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY key, level, idx // {ARITY})"""


_HEAD = " || ".join(map(_field_sql, COLUMNS[:-1]))
_TAMPERED = "CASE WHEN " + crc32_sql("doc_id::VARCHAR") + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, source AS key, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n, sha256({_HEAD} || {_field_sql('text')}) AS leaf,
             sha256({_HEAD} || {_field_sql(f'({_TAMPERED})')}) AS now
      FROM documents, crc_table),
{_up_sql('lower_', 'SELECT key, 0 AS level, pos AS idx, n, leaf AS digest FROM d')},
subs AS (SELECT key, digest, row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM lower_ WHERE n = 1),
{_up_sql('upper_', 'SELECT NULL::VARCHAR AS key, 0 AS level, rank AS idx, n, digest FROM subs')},
beside AS (
  SELECT d.doc_id, 0 AS tier, x.level, x.idx, x.digest, d.pos // pow({ARITY}, x.level)::BIGINT AS own
  FROM d JOIN lower_ x ON x.key IS NOT DISTINCT FROM d.key AND x.n > 1
    AND x.idx // {ARITY} = d.pos // pow({ARITY}, x.level)::BIGINT // {ARITY}
  UNION ALL
  SELECT d.doc_id, 1, x.level, x.idx, x.digest, s.rank // pow({ARITY}, x.level)::BIGINT
  FROM d JOIN subs s ON s.key IS NOT DISTINCT FROM d.key JOIN upper_ x ON x.n > 1
    AND x.idx // {ARITY} = s.rank // pow({ARITY}, x.level)::BIGINT // {ARITY}),
way AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY tier, level) AS step,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE idx < own), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE idx > own), '') AS after
  FROM beside GROUP BY doc_id, tier, level),
fold AS (
  SELECT doc_id, 0 AS step, now AS digest FROM d UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(w.before || f.digest || w.after) FROM fold f JOIN way w ON w.doc_id = f.doc_id AND w.step = f.step + 1),
folded AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM fold GROUP BY doc_id),
proof AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM way GROUP BY doc_id),
top AS (SELECT digest AS root FROM upper_ WHERE n = 1)
SELECT d.doc_id, d.leaf, s.digest AS subroot, top.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.folded_root,
       f.folded_root = top.root AS verified
FROM d JOIN subs s ON s.key IS NOT DISTINCT FROM d.key JOIN folded f ON f.doc_id = d.doc_id
LEFT JOIN proof p ON p.doc_id = d.doc_id, top
"""
