"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ouzel.session import shared_dir
from ouzel.sources.lines import open_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SPACES = " \t\n\x0b\x0c\r"   # \x20 and \x09-\x0D


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def fold(c: Column, folds: int = 5) -> Column:
    """crc32 of the value as text, modulo ``folds`` (null: the empty text)."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % folds


def hash128(*cols: Column) -> list[Column]:
    """Two chained 64-bit hashes: an identity that does not collide in practice."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it if ``df`` has such a column."""
    while name.lower() in map(str.lower, df.columns):
        name = f"_{name}"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and a
    lost executor costs no recomputation of what came before."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filed(df: DataFrame, name: str) -> tuple[str, list[str]]:
    """(folder, files): ``df`` written to the shared folder, a file for each row; tasks read them by ``read_row``."""
    folder = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(folder)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    return folder, sorted(r[0] for r in stored.select(F.col("_metadata.file_name")).distinct().collect())   # names only


def read_row(folder: str, file: str) -> dict:
    fs, root = open_folder(folder)
    return pq.read_table(f"{root}/{file}", filesystem=fs).slice(0, 1).to_pylist()[0]


def utf8(col: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def pack(a: np.ndarray) -> bytes:
    """A numeric array, zstd-compressed with its bytes grouped by significance."""
    a = np.ascontiguousarray(a)
    raw = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
    return len(a).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack(b: bytes, dtype: type | str) -> np.ndarray:
    n, size = int.from_bytes(b[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    raw = pa.decompress(b[8:], decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(size, n).T.copy().view(dtype).reshape(n)


def pack_sorted(a: np.ndarray) -> bytes:
    """An ascending uint64 array as packed differences."""
    return pack(np.diff(a, prepend=np.zeros(1, np.uint64)) if len(a) else a)


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` of the rows."""
    kept: list[tuple] = []
    for r in rows:
        kept.append(r)
        if len(kept) >= size:
            yield batch(kept, schema)
            kept = []
    if kept:
        yield batch(kept, schema)


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


# DuckDB has no crc32: the table of the reversed polynomial, made by its rule, and the sum over a text's bytes.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc_of)"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text; the query needs ``CRC_TABLE`` and ``crc_table`` among its tables."""
    return (f"xor(list_reduce(list_concat([4294967295], list_transform(range(strlen({text})), "
            f"lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)), "
            f"lambda a, b: xor(a >> 8, crc_of[1 + (xor(a, b) & 255)])), 4294967295)")
