"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing: payloads are grouped by digest on narrow rows; of equal payloads of at
least ``min_bytes`` the smallest page_id is the response and the others are
revisits. Each task writes its rows as gzip members (or plain records) into
files of its own in the shared folder and returns an index row for every record
(file, offset, length, url, digest); the index is a table that Spark commits, so
a file left by a lost attempt is in no index.

Reading starts from the index: the selected rows are dealt by file and stretch,
sorted by offset, neighbouring ranges are read in one request, and the records
are parsed from the bytes.

Files are opened with pyarrow's file systems, which know file:, hdfs: and the
object stores; the folder is below ``spark.checkpoint.dir`` unless given.

Defined results: a null payload is empty; a null URL gives a record without a
target URI, bytes of one that are not UTF-8 become replacement characters; null page ids count as the largest; rows that repeat page_id and
payload of a response are responses too; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouzel.llm.common import batch, hash128, table, utf8, written
from ouzel.session import shared_dir

SALTS = 16
INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
INDEX_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                         ("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string())])
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")
RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                           ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                           ("payload", pa.binary())])
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id} {digest}'.encode()).digest())}>"


def to_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
              revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """(page_id, payload_bytes, digest, type, refers_to, payload) of one record; checks a response's digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page_id = int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None
    n, digest, kind = int(http.rpartition(b": ")[2]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "revisit":
        return page_id, n, digest, kind, int(fields["X-Refers-To-Page"]), None
    if (own := base64.b32encode(hashlib.sha1(payload).digest()).decode()) != digest or n != len(payload):
        raise ValueError(f"damaged record of page {page_id}: {own}, {len(payload)} bytes; said {digest}, {n}")
    return page_id, len(payload), digest, kind, None, payload


def _open_fs(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def _writer(folder: str, compress: bool, file_bytes: int):
    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_fs(folder)
        out, name, at = None, "", 0
        try:
            for b in it:
                d, rows = b.drop_columns(["html", "url"]).to_pydict() | {"html": utf8(b.column("html"))}, []
                d["url"] = [None if u is None else u.decode("utf-8", "replace") for u in b.column("url").cast(pa.binary()).to_pylist()]
                for page_id, url, html, sha1, first in zip(d["page_id"], d["url"], d["html"], d["sha1"], d["first"]):
                    revisit = first is not None and first != page_id
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    raw = to_record(page_id, url, html, digest, first, revisit)
                    if compress:
                        z = zlib.compressobj(1, zlib.DEFLATED, 31)
                        raw = z.compress(raw) + z.flush()
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc{'.gz' * compress}", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(raw)
                    rows.append((name, at, len(raw), url, digest, page_id, "revisit" if revisit else "response"))
                    at += len(raw)
                yield batch(rows, INDEX_ARROW)
        finally:
            if out is not None:
                out.close()
    return write


def write_warc(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, compress: bool = True,
               file_bytes: int = 1 << 30) -> tuple[str, DataFrame]:
    """Writes (page_id, url, html) and returns (folder, index table)."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")
    fs, root = _open_fs(folder)
    fs.create_dir(root, recursive=True)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    key = F.array(*hash128(F.col("html")), F.octet_length("html").cast("long"))
    groups = (rows.where(F.octet_length("html") >= min_bytes).groupBy(key.alias("key"))
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
              .select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    keyed = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("sha1"), key.alias("key"),
                        F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt"))
    marked = keyed.join(groups, ["key", "salt"], "left").select("page_id", "url", "html", "sha1", "first")
    index = marked.mapInArrow(_writer(folder, compress, file_bytes), INDEX)
    return folder, written(index, "warc-index")


def _reader(folder: str, gap: int, most: int, with_payload: bool):
    def stretches(it: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Index rows whose ranges are read by one request."""
        run: list[tuple] = []
        for b in it:
            for r in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length", "url"))):
                if run and (r[0] != run[-1][0] or r[1] - (run[-1][1] + run[-1][2]) > gap or r[1] + r[2] - run[0][1] > most):
                    yield run
                    run = []
                run.append(r)
        if run:
            yield run

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_fs(folder)
        name, f = None, None
        for run in stretches(it):
            if run[0][0] != name:
                name, f = run[0][0], fs.open_input_file(f"{root}/{run[0][0]}")
            start = run[0][1]
            data = f.read_at(run[-1][1] + run[-1][2] - start, start)
            rows = []
            for _, offset, length, url in run:
                raw = data[offset - start:offset - start + length]
                page_id, n, digest, kind, refers_to, payload = parse_record(zlib.decompress(raw, 31) if name.endswith(".gz") else raw)
                rows.append((page_id, url, n, digest, kind, refers_to, payload if with_payload else None))
            yield batch(rows, RECORDS_ARROW)
    return read


def read_warc(folder: str, selected: DataFrame, gap: int = 1 << 16, most: int = 4 << 20, stretch: int = 64 << 20,
              with_payload: bool = True) -> DataFrame:
    """The records of the ``selected`` index rows. Ranges at most ``gap`` bytes apart
    are read together, up to ``most`` bytes a request (a longer record alone)."""
    dealt = (selected.select("file", "offset", "length", "url")
             .repartition("file", F.floor(F.col("offset") / stretch)).sortWithinPartitions("file", "offset"))
    return dealt.mapInArrow(_reader(folder, gap, most, with_payload), RECORDS)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder, index = write_warc(table(spark, sf_dir, "pages"), min_bytes=0)
    return read_warc(folder, index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Hexadecimal digits five at a time become four base32 digits.
_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v{g} >> {s}) & 31)::INT, 1)" for g in range(8) for s in (15, 10, 5, 0))
_V = ", ".join(f"('0x' || substr(hex, {1 + 5 * g}, 5))::BIGINT AS v{g}" for g in range(8))
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex,
             min(page_id) OVER (PARTITION BY body) AS first FROM p),
v AS (SELECT page_id, payload_bytes, first, {_V} FROM h)
SELECT page_id, payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM v
"""
