"""Line dedup against a plain count; the cases each operator has to define."""

from collections import Counter

from ouzel.llm.line_dedup import drop_frequent_lines
from cases import AWKWARD

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(texts, min_docs, min_chars):
    lines = [(t or "").split("\n") for t in texts]
    df = Counter(k for ls in lines for k in {key(x) for x in ls} if len(k) >= min_chars)
    out = []
    for ls in lines:
        kept = [x for x in ls if not (len(key(x)) >= min_chars and df[key(x)] >= min_docs)]
        out.append(("\n".join(kept), len(ls), len(ls) - len(kept)))
    return out


def test_against_brute_force(spark, docs_of, words):
    texts = [f"{words[i]}\n  Common Line\t\n{words[i + 1]} x\ncommon line\n\n{words[i % 9]}" for i in range(40)] + AWKWARD
    for min_docs, min_chars in ((10, 1), (3, 1), (10, 0), (2, 6)):
        got = {r.doc_id: (r.text, r.line_dedup.n_lines, r.line_dedup.n_dropped)
               for r in drop_frequent_lines(docs_of(texts), min_docs, min_chars).collect()}
        assert got == dict(enumerate(brute(texts, min_docs, min_chars)))


def test_other_columns_and_empty_table(spark, docs_of):
    docs = docs_of(["a\nb"])
    out = drop_frequent_lines(docs, 1)
    assert out.columns == [*docs.columns, "line_dedup"]
    assert out.first().text == "" and out.first().row == [1]
    assert drop_frequent_lines(docs.limit(0)).count() == 0
    assert drop_frequent_lines(out).columns == out.columns


def test_many_lines_in_one_text(spark, docs_of):
    text = "\n".join(str(i % 5000) for i in range(20_000))
    got = drop_frequent_lines(docs_of([text, "7", None]), 2).orderBy("doc_id").collect()
    assert [r.line_dedup.n_dropped for r in got] == [4, 1, 0] and "\n7\n" not in got[0].text
