"""The corpus pipeline: documents through five operators of ``ouzel.llm``.

quality classifier -> line dedup -> SimHash near-dedup -> benchmark
decontamination -> packing. Each stage takes all that the one before kept; all
but the last return the columns of ``documents``.

Defined results: null text is judged as empty and is empty after line dedup;
``n_chars``, if there, follows the text; near-dedup keeps one row of each group of
near copies, also where rows repeat, share a doc_id or have none (these come last);
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ouzel.llm.common import free_name, hash128, table, written
from ouzel.llm.decontaminate import benchmark_items, decontaminate, is_contaminated
from ouzel.llm.line_dedup import drop_frequent_lines
from ouzel.llm.packing import pack_documents, tokenizer_path
from ouzel.llm.quality import predicted, quality_labels, scored, train
from ouzel.llm.simhash import near_duplicates

ORACLE_SQL = None   # tokenizer, fingerprints and the fitted model are beyond SQL; see tests/llm/test_pipeline.py


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    score = free_name(docs, "quality_score")
    model = train(docs, quality_labels(spark, sf_dir))
    return scored(docs, model, out=score).where(predicted(score) == 1).drop(score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    out = free_name(docs, "line_dedup")
    kept = drop_frequent_lines(docs, min_docs=10, min_chars=1, out=out).drop(out)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest doc_id, of its rows the one with the smallest hash."""
    pair = [F.col("doc_id").isNull(), F.col("doc_id"), F.coalesce("text", F.lit(""))]   # hashes skip nulls
    ties = tuple(free_name(docs, n) for n in ("row_1", "row_2"))
    named = docs.withColumns(dict(zip(ties, hash128(*pair))))
    copies = (near_duplicates(named, shingle=4, radius=4, ties=ties)
              .where(" or ".join(f"{t} <> component_id.{t}" for t in ties)).select(*ties).distinct())
    return named.join(copies, list(ties), "left_anti").dropDuplicates(list(ties)).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the contamination rule lets pass, as they are."""
    hits = free_name(docs, "hits")
    return decontaminate(docs, benchmark_items(spark, sf_dir), window=13, out=hits).where(~is_contaminated(hits)).drop(hits)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("quality classifier", keep_quality), ("line dedup", dedup_lines), ("SimHash near-dedup", dedup_near),
          ("benchmark decontamination", decontaminated), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
