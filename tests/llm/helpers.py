"""Small fixtures shared by the tests of bookflow.llm."""



SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["id", "ids", "fp", "h", "pos", "word", "n", "u", "v", "part", "text_col", "offsets"]


def documents(spark, texts, extra=False):
    """A documents table; texts may hold None; rows may be (doc_id, text)."""
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], SCHEMA)
    if extra:
        for c in CLASHING:
            df = df.selectExpr("*", f"'clash' AS {c}")
    return df


def as_dir(df, path, name="documents"):
    df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
