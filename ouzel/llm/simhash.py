"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints (64 bits, majority over the hashes of the word shingles) are made
per row. Equal fingerprints become one node, so exact copies cost one row. For
radius r the 2^(r+1)-1 masks come from a linear code: bit i of a fingerprint is
given the vector m(i) of r+1 bits, and mask v keeps bit i if <m(i), v> is odd.
Any r differing bits span at most r dimensions, so some v is orthogonal to all
of them and its mask hides every difference: each pair within the radius
collides in at least one table, without exception.

A bucket (one table, one masked value) is walked breadth-first over its
unvisited members and gives spanning links only, never all pairs. Buckets above
``block`` members are cut into blocks, and each pair of blocks is walked on its
own, so no task holds more than two blocks. Components come from rounds of
min-neighbour contraction on tables in the shared folder.

Defined results: null or empty text has fingerprint zero, linked like any other;
fewer words than a shingle are one shingle; repeated rows share a component; a
component's id is its smallest doc_id, null only if it has none; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import table, utf8, written

BITS = 64
CHUNK = 1 << 16       # shingles hashed at a time
BLOCK = 4096          # members of a bucket that are walked together


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    words = text.lower().split()   # bytes: A-Z and the ASCII spaces only
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [words]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(r), seed) for r in runs], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", id_col: str = "doc_id",
                 ties: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp long, the long columns ``ties``) for every row."""
    names = ("doc_id", "fp", *ties)
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = np.array([fingerprint(t, shingle) for t in utf8(b.column(1))], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), pa.array(fp), *b.columns[2:]], schema=schema)

    return (docs.select(F.col(id_col).cast("long"), F.col(text), *[F.col(f"`{t}`") for t in ties])
            .mapInArrow(run, ", ".join(f"`{n}` long" for n in names)))


def covering_masks(radius: int) -> list[int]:
    """The masks, as signed 64-bit integers."""
    vectors = (1 << radius + 1) - 1
    masks = [sum(1 << i for i in range(BITS) if ((1 + i % vectors) & v).bit_count() % 2) for v in range(1, vectors + 1)]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]


def spanning_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect every chain of ``fps`` (distinct uint64) within the radius."""
    links: list[tuple[int, int]] = []
    rest = fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found, rest = rest[near], rest[~near]
                links += [(x, y) for y in found]
                queue.extend(found)
    return links


def _linker(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def out(links: list) -> pa.RecordBatch:
        e = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.record_batch([pa.array(e.min(1)), pa.array(e.max(1))], schema=schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []   # the rows of the last bucket seen, which may go on in the next batch
        for b in it:
            rows = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)], axis=1)
            rows = np.concatenate([*held, rows])
            cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            starts, links = np.concatenate([[0], cut]), []
            ends = np.append(starts[1:], len(rows))
            for s, e in zip(starts[:-1], ends[:-1]):
                if e - s > 1:
                    links += spanning_links(rows[s:e, 4].view(np.uint64), radius)
            held = [rows[starts[-1]:]]
            if links:
                yield out(links)
        if held and (links := spanning_links(np.ascontiguousarray(held[0][:, 4]).view(np.uint64), radius)):
            yield out(links)
    return run


def near_links(nodes: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Distinct links (a, b), a < b, that connect the distinct ``fp`` of ``nodes`` as all links would."""
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in covering_masks(radius)]))
                         .alias("t", "key"))
    large = (keyed.groupBy("t", "key").count().where(F.col("count") > block)
             .select("t", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    sized = keyed.join(large, ["t", "key"], "left").select("t", "key", "fp", F.coalesce("blocks", F.lit(1)).alias("n"))
    own = sized.select("t", "key", "fp", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int").alias("i"),
                       F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    pairs = own.select("t", "key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp")
    dealt = pairs.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    return dealt.mapInArrow(_linker(radius), "a long, b long").distinct()


def components(links: DataFrame, jumps: int = 2) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); a root is a node of its component.

    Each round maps every node to its smallest neighbour (or itself), follows
    the map ``jumps`` times more, and contracts the links by it.
    """
    edges, roots = written(links, "links"), None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        step = written(least.select("node", F.least("node", "b").alias("root")), "roots")
        for _ in range(jumps):
            far = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
            step = step.join(far, "root").select("node", F.col("far").alias("root"))
        step = written(step, "roots")
        to = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = step if roots is None else written(
            roots.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        moved = (edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
                 .join(step.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
                 .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        edges = written(moved, "links")
    return roots if roots is not None else links.sparkSession.createDataFrame([], "node long, root long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, text: str = "text", id_col: str = "doc_id",
                    block: int = BLOCK, ties: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp long, component_id) for every row.

    ``ties``: long columns that tell rows apart by more than their doc_id. With them, a component's
    id is the struct of its first row: those with a doc_id, the smallest doc_id, the smallest ``ties``;
    the result has the columns ``ties`` too.
    """
    prints = written(fingerprints(docs, shingle, text, id_col, ties), "fingerprints")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ties) if ties else F.col("doc_id")
    nodes = written(prints.groupBy("fp").agg(F.min(name).alias("first")), "nodes")
    roots = components(near_links(nodes, radius, block))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id", *ties)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
