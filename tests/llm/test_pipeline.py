import hashlib

import corpus_pipeline
import pandas as pd
from bookflow.llm import pii, quality
from bookflow.llm.common import table

from .helpers import as_dir, documents
from .test_decontaminate import plain as leaks
from .test_decontaminate import plain_words
from .test_shingles import plain_kept
from .test_tokens import reference

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    source = table(spark, SF, "documents")
    model = quality.learn(source, table(spark, SF, "labels"))
    symbols = quality.Symbols(model["rows"])
    kept = [(i, t) for i, t in zip(docs.doc_id, docs.text) if quality.scores(model, symbols, [t])[0] >= 0.5]
    stay = set(plain_kept(kept))
    kept = [r for r in kept if r[0] in stay]
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    words = {i: plain_words(t) for i, t in kept}
    items = [*zip(items.item_id, items.text)]
    bad = {i for i, t in kept if leaks([(i, t)], [x for x in items if len(set(words[i]) & set(plain_words(x[1]))) > 4])}
    kept = [r for r in kept if r[0] not in bad]
    assert bad and len(kept) < len(docs)
    texts = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(kept, "doc_id long, text string")).collect()}
    enc = reference()
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256, list(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: (len(ids := enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest(), ids) for i, t in texts.items()}


def test_rows_without_id_and_clashing_names(spark, tmp_path):
    """A dirty and a clean row without doc_id, and helper names of the operators as columns of documents."""
    item = " ".join(f"x{i}" for i in range(20))
    texts = [(None, f"some words and {item}"), (None, "clean words without an id and a mail x@y.com"), (8, item + " end"), (8, "another clean text of that id")]
    df = documents(spark, texts, extra=True).selectExpr("*", "'a' pii_found", "'b' pii_kinds", "'c' near_text", "'d' bad_id", "'e' near_id", "'f' text_key", "'g' node")
    as_dir(df, tmp_path)
    as_dir(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    as_dir(spark.createDataFrame([(1, item)], "item_id long, text string"), tmp_path, "benchmark")
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    rows = docs.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["8", "None"] and {(r.pii_found, r.pii_kinds, r.near_text, r.bad_id) for r in rows} == {("a", "b", "c", "d")}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 2


def test_columns_and_odd_rows(spark, tmp_path):
    texts = [None, "", "", "plain words of a text with a few more", "plain words of a text with a few more", "mail x@y.com", "word " * 30_000]
    df = documents(spark, [*enumerate(texts), (None, "no id at all here"), (3, "plain words of a text with a few more")], extra=True)
    sf = as_dir(df, tmp_path)
    as_dir(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    as_dir(spark.createDataFrame([(1, None)], "item_id long, text string"), tmp_path, "benchmark")
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == df.columns and docs.schema.simpleString() == df.schema.simpleString()
    rows = docs.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["0", "3", "5", "6", "None"] and not any("x@y.com" in (r.text or "") for r in rows)
    assert all(r.n_chars == len(r.text or "") for r in rows)
    assert corpus_pipeline.run(spark, sf).count() == 5
    assert corpus_pipeline.run(spark, as_dir(documents(spark, []), tmp_path / "none") if as_dir(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path / "none", "labels") and as_dir(spark.createDataFrame([], "item_id long, text string"), tmp_path / "none", "benchmark") else "").count() == 0
