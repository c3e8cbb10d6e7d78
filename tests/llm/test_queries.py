"""Every query with SQL against DuckDB; the queries' columns; nothing depends on how rows are dealt."""

import duckdb
import pytest

from ouzel.llm.queries import ORACLES, QUERIES
from scripts.check_oracles import canon

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_model": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op3_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op4_maxscore": ["query_id", "rank", "vec_id", "score"],
    "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op6_simhash": ["doc_id", "fingerprint", "component_id"],
    "op7_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op8_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op10_quality": ["doc_id", "held_out", "score", "predicted"],
    "op11_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op12_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_resample": ["doc_id", "n_features", "weight", "score", "rank"],
}


def test_all_are_registered():
    assert sorted(QUERIES) == sorted(COLUMNS) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, exp = QUERIES[key](spark, SF).toPandas(), con.execute(ORACLES[key]).df()
    assert sorted(got.columns) == sorted(exp.columns) and canon(got) == canon(exp)


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_columns(spark, key):
    assert QUERIES[key](spark, SF).columns[:len(COLUMNS[key])] == COLUMNS[key]
