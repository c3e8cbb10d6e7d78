"""WARC: round trip, revisits, coalesced reads, damaged bytes."""

import base64
import hashlib

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from ouzel.llm import warc as W

HTML = ["<p>a</p>", "<p>b</p>", "<p>a</p>", "", None, "é\r\n\r\nWARC/1.1\r\n", "x" * 3_000_000, "<p>a</p>", "\x00", "x" * 3_000_000]
URLS = ["http://a/", None, "http://b/ ü\r\nX: y", ""] + ["http://c/"] * 6


def pages(spark):
    rows = [(10 * i, u, h, i, "z") for i, (u, h) in enumerate(zip(URLS, HTML))]
    return spark.createDataFrame(rows, "page_id long, url string, html string, first int, key string").repartition(3)


def expected(min_bytes):
    out = {}
    for i, h in enumerate(HTML):
        raw = (h or "").encode()
        same = [10 * j for j, g in enumerate(HTML) if (g or "") == (h or "")]
        revisit = len(raw) >= min_bytes and 10 * i != same[0]
        out[10 * i] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response",
                       same[0] if revisit else None, None if revisit else raw, URLS[i])
    return out


@pytest.mark.parametrize("min_bytes,compress,gap,most", [(0, True, 1 << 16, 4 << 20), (5, False, 0, 1000), (0, False, 1 << 30, 1 << 30)])
def test_round_trip(spark, min_bytes, compress, gap, most):
    folder, index = W.write_warc(pages(spark), min_bytes=min_bytes, compress=compress, file_bytes=2_000_000)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                       None if r.payload is None else bytes(r.payload), r.url)
           for r in W.read_warc(folder, index, gap, most, stretch=1_000_000).collect()}
    assert got == expected(min_bytes)
    some = W.read_warc(folder, index.where("page_id % 20 = 0"), gap, most).select("page_id").collect()
    assert sorted(r.page_id for r in some) == [0, 20, 40, 60, 80]


def test_index_says_where_records_are(spark):
    folder, index = W.write_warc(pages(spark), compress=False)
    fs, root = W._open_fs(folder)
    for r in index.collect():
        with fs.open_input_file(f"{root}/{r.file}") as f:
            raw = f.read_at(r.length, r.offset)
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and f"sha1:{r.digest}".encode() in raw


def test_damaged_record_is_an_error(spark):
    folder, index = W.write_warc(pages(spark).where("page_id = 0"), compress=False)
    fs, root = W._open_fs(folder)
    name = index.first().file
    with fs.open_input_file(f"{root}/{name}") as f:
        raw = f.read()
    with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
        f.write(raw.replace(b"<p>a", b"<p>A"))
    with pytest.raises(Exception, match="damaged record of page 0"):
        W.read_warc(folder, index).collect()


def test_null_ids_repeats_and_empty(spark):
    df = pages(spark).where("page_id in (0, 20, 70)").withColumn("page_id", F.when(F.col("page_id") != 20, F.col("page_id")))
    df = df.union(df.where("page_id = 0"))
    folder, index = W.write_warc(df)
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in W.read_warc(folder, index).collect())
    assert got == [("0", "response", "None"), ("0", "response", "None"), ("70", "revisit", "0"), ("None", "revisit", "0")]
    folder, index = W.write_warc(df.limit(0))
    assert index.count() == 0 and W.read_warc(folder, index).count() == 0
    assert isinstance(W._open_fs(folder)[0], pafs.FileSystem)
