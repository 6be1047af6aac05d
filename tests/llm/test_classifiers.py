import zlib

import numpy as np
import pandas as pd
import pytest

from bookflow.llm import language, quality, sampling

from .helpers import as_dir, documents

SF = "/root/testdata/sf0.01"


def test_codebook_tells_languages_apart():
    for n in (1, 2, 4, 9):
        book = language.codebook(n)
        assert book.shape == (n, language.BITS) and set(np.unique(book)) <= {-1.0, 1.0}
        gap = (language.BITS - book @ book.T) / 2 + np.eye(n) * language.BITS
        assert gap.min() >= 8


def test_a_wrong_bit_is_corrected():
    book = language.codebook(4)
    model = {"w": np.zeros((1, language.BITS)), "b": np.zeros(language.BITS), "book": book, "weight": np.full(language.BITS, 1 / language.BITS)}
    for k in range(4):
        word = book[k].copy()
        word[:3] *= -1
        assert language.decode(model | {"b": 4 * word}, np.zeros((1, 1)))[0][0] == k
    assert language.decode(model, np.zeros((1, 1)))[2][0] < language.LEAD


def test_held_out_languages(spark):
    got = {r.doc_id: r for r in language.op5(spark, SF).collect()}
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert len(got) == len(docs)
    right = []
    for i, lang in zip(docs.doc_id, docs.lang):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1
        if got[i].held_out:
            right.append(got[i].lang_pred == lang)
    assert np.mean(right) > 0.98


def test_held_out_quality(spark):
    got = {r.doc_id: r for r in quality.op9(spark, SF).collect()}
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    held = [(got[i].predicted, q) for i, q in zip(labels.doc_id, labels.quality) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert np.mean([p for p, q in held if q == 1]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_rows(spark, tmp_path, labelled):
    texts = [None, "", "123 !!", "word " * 30_000, *(f"the cat number {i} sat here" for i in range(30)), *(f"%%% {i} $$$" for i in range(30))]
    df = documents(spark, [*enumerate(texts), (None, "no id"), (5, "the cat again")], extra=True)
    sf = as_dir(df, tmp_path)
    rows = [(i, int(i < 34), 0, "x") for i in range(4, 64)] + [(4, None, None, "x"), (None, 1, 0, "x"), (4, 1, 0, "x")] if labelled else []
    as_dir(spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string"), tmp_path, "labels")
    got = quality.op9(spark, sf).collect()
    assert len(got) == len(texts) + 2 and all(0 <= r.score <= 1 for r in got)
    assert labelled or {r.score for r in got} == {0.5}
    langs = {(r.doc_id, r.lang_pred) for r in language.op5(spark, sf).collect()}
    assert {(i, "und") for i in (0, 1, 2)} <= langs and (3, "en") in langs and (None, "en") in langs


def test_no_language_is_left_out(spark, tmp_path):
    """230 languages of a few rows each, every one with an alphabet pair of its own."""
    rows = [(i * 10 + j, f"{chr(0x4E00 + 3 * i)}{chr(0x4E01 + 3 * i)} " * 6, f"l{i:03d}") for i in range(230) for j in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, model = language.learn(df)
    assert len(names) == 230
    got = {r.doc_id: r.lang_pred for r in language.predict(df, names, model).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.9


def test_repeated_labels_and_ids_keep_the_sample_small(spark):
    docs = documents(spark, [(1, f"row {i}") for i in range(3000)] + [(2, "other text")])
    labels = spark.createDataFrame([(1, 1)] * 500 + [(2, 0)], "doc_id long, quality int")
    sample, counts = sampling.per_class(docs.select("doc_id", "text", "lang"), [docs.doc_id, docs.text], "lang", 100, 1000)
    assert counts == {"en": 3001} and 50 < sample.count() < 200
    assert quality.learn(docs, labels) is not None


def test_scores_against_plain_scoring(spark):
    """The score of every row of a table from the model, one text at a time and in plain Python."""
    docs = pd.read_parquet(f"{SF}/documents.parquet").head(150)
    df = spark.createDataFrame(docs[["doc_id", "text", "lang"]])
    model = quality.learn(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    for i, t in zip(docs.doc_id, docs.text):
        tokens, rows = t.split(), []
        for k, token in enumerate(tokens):
            again = any(tokens[k - lag] == token for lag in range(1, quality.PERIOD + 1) if k >= lag)
            rows.append(model["rows"][quality.AGAIN] if again else model["rows"].get(token, model["rows"].get(quality.shape(token), 0)))
        x = np.zeros(2 * quality.SIZE + 2)
        if tokens:
            x[: quality.SIZE] = np.mean([model["vectors"][r] for r in rows], axis=0)
            x[quality.SIZE : -2] = np.mean([model["vectors"][r] for r in set(rows)], axis=0)
            x[-2:] = np.log1p(len(tokens)) / 8, len(set(tokens)) / len(tokens)
        net = model["net"]
        z = np.tanh(((x - net["mean"]) / net["spread"]) @ net["w1"] + net["b1"]) @ net["w2"] + net["b2"][0]
        assert abs(got[i] - 1 / (1 + np.exp(-z / net["heat"]))) < 1e-4
    names, lang = language.learn(df)
    found = {r.doc_id: r for r in language.predict(df, names, lang).collect()}
    for i, t in zip(docs.doc_id, docs.text):
        x, _ = language.gram_counts([t])
        loss = [sum(w * np.log1p(np.exp(-m * b)) for m, b, w in zip((x @ lang["w"] + lang["b"])[0], word, lang["weight"])) for word in lang["book"]]
        assert found[i].lang_pred == names[int(np.argmin(loss))]


def test_empty_tables(spark, tmp_path):
    sf = as_dir(documents(spark, []), tmp_path)
    as_dir(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    assert language.op5(spark, sf).count() == quality.op9(spark, sf).count() == 0


def test_nothing_labelled(spark, tmp_path):
    df = documents(spark, ["some text"]).selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    assert [(r.lang_pred, r.score) for r in language.op5(spark, as_dir(df, tmp_path)).collect()] == [("und", 0.0)]
