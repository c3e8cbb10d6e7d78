"""The queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from ouzel.llm import (decontaminate, language_model, line_dedup, maxscore, merkle, packing, quality, resample, sharding, simhash,
                       suffix_dedup, url_filter, warc)

QUERIES = {
    "op1_language_model": language_model.op1_language_model,
    "op2_packing": packing.op2_packing,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_maxscore": maxscore.op4_maxscore,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_simhash": simhash.op6_simhash,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_warc": warc.op9_warc,
    "op10_quality": quality.op10_quality,
    "op11_sharding": sharding.op11_sharding,
    "op12_merkle": merkle.op12_merkle,
    "op13_resample": resample.op13_resample,
}

ORACLES = {
    "op4_maxscore": maxscore.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op9_warc": warc.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_resample": resample.ORACLE,
}
