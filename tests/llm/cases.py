"""Inputs and helpers of these tests."""

LONG = "word " * 60_000
AWKWARD = ["", " ", "\n\n", None, "one", "a b c", "é ü ß", "x\x00y \x0b z", LONG, LONG, "Ünï cödé   words", "same same", "same same"]


def make_docs(spark, texts, extra=True):
    """documents with columns whose names the operators use themselves."""
    rows = [(i, t, f"src{i % 3}" if i % 7 else None, "en", len(t or ""), i, "k", [1], 0.5) for i, t in enumerate(texts)]
    ddl = "doc_id long, text string, source string, lang string, n_chars long"
    clash = ", id long, key string, row array<int>, hits double"
    if not extra:
        rows, clash = [r[:5] for r in rows], ""
    return spark.createDataFrame(rows, ddl + clash).repartition(3)


def write_tables(folder, docs, **tables):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
