"""The pipeline, stage by stage, against plain versions of each decision."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from cases import AWKWARD, write_tables
from ouzel.llm import packing as P
from ouzel.llm.common import table
from test_decontaminate import plain as contaminated_by
from test_line_dedup import brute as without_lines
from test_packing import check_pieces
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def folder(spark, words, tmp_path_factory):
    item = " ".join(words[:20])
    texts = AWKWARD[:8] + [f"{' '.join(words[i:i + 60])}\nshared line of all\n{words[i]}" for i in range(30)]
    texts += [texts[12]] * 3 + [texts[14] + " x"] + [f"{item} {' '.join(words[i:i + 30])}" for i in (50, 90)]
    texts += [f"{item} {' '.join(words[k % 299] for k in range(i, i + 900))}" for i in (3, 4)]   # hits under a twentieth
    from cases import make_docs

    docs = make_docs(spark, texts, extra=False)
    return write_tables(tmp_path_factory.mktemp("tables"), docs,
                        labels=spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int"),
                        benchmark=spark.createDataFrame([(7, item)], "item_id long, text string"))


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_each_stage_on_its_own_input(spark, folder):
    docs = table(spark, folder, "documents")
    columns = docs.columns
    kept = C.keep_quality(spark, docs, folder)
    assert kept.columns == columns and texts_of(kept) == texts_of(docs)        # all labels are good

    lines = C.dedup_lines(spark, docs, folder)
    before, after = texts_of(docs), texts_of(lines)
    assert lines.columns == columns
    assert after == {i: x[0] for i, x in zip(before, without_lines(list(before.values()), 10, 1))}
    assert lines.where(F.col("n_chars") != F.length("text")).count() == 0

    near = C.dedup_near(spark, lines, folder)
    ids = list(after)
    comps = plain_components(ids, [plain_fingerprint(after[i]) for i in ids], 4)
    assert near.columns == columns and texts_of(near) == {i: t for i, t in after.items() if comps[i] == i}

    clean = C.decontaminated(spark, near, folder)
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    had = texts_of(near)
    rule = {i: (lambda n, hit, _: bool(hit) and 20 * len(hit) >= n)(*contaminated_by(t, items)) for i, t in had.items()}
    assert any(rule.values()) and clean.columns == columns
    assert texts_of(clean) == {i: t for i, t in had.items() if not rule[i]}

    from tokenizers import Tokenizer

    left = texts_of(clean)
    rows = C.packed(spark, clean, folder).collect()
    tok = Tokenizer.from_file(P.tokenizer_path())
    by_doc = defaultdict(int)
    for r in rows:
        by_doc[r.doc_id] += r.length
    assert dict(by_doc) == {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in left.items()}

    out = C.run(spark, folder)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(left)


def test_repeated_rows_null_ids_and_odd_columns(spark, folder):
    docs = table(spark, folder, "documents").withColumn("hits", F.lit(1)).withColumn("quality_score", F.lit("q")).withColumn("line_dedup", F.lit(2))
    docs = docs.union(docs.limit(5)).union(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns[-3:] == ["hits", "quality_score", "line_dedup"]
    assert docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    assert C.packed(spark, docs, folder).count() > 0


def test_near_dedup_by_row(spark, words):
    """Rows that share a doc_id, or have none, are judged by their own text."""
    one, two, three, four = (" ".join(words[i:i + 60]) for i in (0, 70, 140, 210))
    rows = [(1, one), (2, one), (2, two),                     # 2's second text is no copy
            (3, three), (3, three + " "), (3, three),         # copies under one id
            (None, four), (None, four + "  "), (None, one)]   # and without id
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, row_1 int")
    got = C.dedup_near(spark, docs, "")
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text.strip()) for r in got.collect()]
    assert sorted(left, key=str) == sorted([(1, one), (2, two), (3, three), (None, four)], key=str)


def test_empty_tables(spark, folder, tmp_path):
    empty = write_tables(tmp_path, *(table(spark, folder, "documents").limit(0),),
                         labels=table(spark, folder, "labels").limit(0), benchmark=table(spark, folder, "benchmark").limit(0))
    assert C.run(spark, empty).count() == 0


def test_given_tables(spark):
    """All stages on the small tables: each drops something, and what is left is packed whole."""
    docs, counts = table(spark, SF, "documents"), []
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        counts.append(docs.count())
    labels = table(spark, SF, "labels")
    bad = docs.join(labels, "doc_id").where("quality = 0").count()
    assert 1000 > counts[0] == counts[1] > counts[2] > counts[3] > 700 and bad < 10
    from tokenizers import Tokenizer

    rows = [r for r in C.packed(spark, docs, SF).collect()]
    texts = texts_of(docs)
    order = sorted(texts)
    place = {d: k for k, d in enumerate(order)}

    class Row:
        def __init__(self, r):
            self.__dict__ = r.asDict() | {"doc_id": place[r.doc_id]}
    check_pieces([Row(r) for r in rows], [texts[d] for d in order], Tokenizer.from_file(P.tokenizer_path()), 4096)
    docs.unpersist()
