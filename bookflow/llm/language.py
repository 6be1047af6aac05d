"""Language identification (operator 5), with error-correcting output codes.

Each language has a codeword of +1 and -1. One binary linear classifier for each bit, over hashed character n-grams of
the whole text, predicts that bit. Decoding adds up the logistic losses against each codeword, weighted by how well the
bit's classifier did in training, and takes the nearest codeword; a small lead over the second flags the row as
ambiguous. The classifiers are fitted on a bounded sample of all languages: about PER_LANGUAGE rows of each, fewer if
that were over SAMPLE rows in all, but at least 20. The executors turn the sample into n-gram shares; only these vectors
(BUCKETS numbers a row) come to the driver.

Defined results: `und` with score 0 where the text is null, empty or has no letters, or nothing could be learned; a row
without doc_id isn't learned from and isn't held out; ties between codewords go to the first language by name; repeated
rows are repeated (and learned from once); a very long text is one vector like any other, with arrays of some thirty
times its size in work; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, pieces, table
from .pretoken import LETTER, code_classes
from .sampling import per_class

PER_LANGUAGE, SAMPLE = 500, 20_000
#: Hash buckets of n-grams, bits of a codeword, rounds of fitting, weight decay, lead under which a row is ambiguous.
BUCKETS, BITS, ROUNDS, DECAY, LEAD = 2048, 31, 150, 1e-4, 0.2


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of the shares of hashed 1- to 3-grams, of length 1, and the number of letters of each text."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32).copy()
    letter = code_classes()[codes] == LETTER
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    codes[~letter] = 32
    x = codes * np.uint32(0x9E3779B1)
    two, three = np.zeros_like(x), np.zeros_like(x)
    two[1:] = (x[:-1] * np.uint32(3) + x[1:]) * np.uint32(0x85EBCA6B)
    three[2:] = (x[:-2] * np.uint32(7) + x[1:-1] * np.uint32(5) + x[2:]) * np.uint32(0xC2B2AE35)
    use2 = letter | np.concatenate([[False], letter[:-1]])
    use3 = use2 & np.concatenate([[False], use2[:-1]])
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    out, letters = np.zeros((len(texts), BUCKETS), np.float32), np.zeros(len(texts), np.int64)
    for i, (a, b) in enumerate(zip((starts + 1).tolist(), (ends + 1).tolist())):
        letters[i] = np.count_nonzero(letter[a:b])
        if letters[i]:
            row = sum(np.bincount((g[a:b] >> shift)[use[a:b]], minlength=BUCKETS) for g, use in ((x, letter), (two, use2), (three, use3)))
            out[i] = np.sqrt(row / row.sum())
    return out, letters


def codebook(n: int, bits: int = BITS) -> np.ndarray:
    """A codeword for each of n languages: of many random books, that with the largest least distance."""
    rng, best, far = np.random.default_rng(11), None, -1
    for _ in range(200):
        book = rng.choice(np.array([-1.0, 1.0], np.float32), (n, bits))
        mixed = np.abs(book.sum(axis=0)) < n
        book[:, ~mixed] *= np.where(np.arange(n) % 2, 1, -1)[:, None]  # no bit is the same for all languages
        gap = (bits - book @ book.T) / 2 + np.eye(n) * bits
        if gap.min() > far:
            best, far = book, gap.min()
    return best


def fit(x: np.ndarray, y: np.ndarray, n: int) -> dict:
    """All bits' logistic classifiers at once, by Adam over the whole sample; languages weigh the same."""
    book = codebook(n)
    target = book[y]
    share = (1 / np.bincount(y, minlength=n))[y][:, None].astype(np.float32) / n
    w, b = np.zeros((x.shape[1], book.shape[1]), np.float32), np.zeros(book.shape[1], np.float32)
    m, v = np.zeros((len(w) + 1, len(b)), np.float32), np.zeros((len(w) + 1, len(b)), np.float32)
    for t in range(1, ROUNDS + 1):
        g = -target / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30))) * share
        grad = np.vstack([x.T @ g + DECAY * w, g.sum(axis=0)])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    right = (np.sign(x @ w + b) == target).mean(axis=0)
    return {"w": w, "b": b, "book": book, "weight": np.maximum(right - 0.5, 1e-3) / np.maximum(right - 0.5, 1e-3).sum()}


def decode(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword by weighted loss, its probability and its lead over the next."""
    margins = x @ model["w"] + model["b"]
    loss = np.stack([(np.logaddexp(0, -margins * word) * model["weight"]).sum(axis=1) for word in model["book"]], axis=1)
    likely = np.exp(-3 * (loss - loss.min(axis=1, keepdims=True)))
    likely /= likely.sum(axis=1, keepdims=True)
    ordered = np.sort(likely, axis=1)
    lead = ordered[:, -1] - ordered[:, -2] if likely.shape[1] > 1 else ordered[:, -1]
    return loss.argmin(axis=1), ordered[:, -1], lead


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], dict | None]:
    """The languages and the model, from a bounded sample of the rows of df that have a language."""
    rows = df.filter(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sample, _ = per_class(rows, [F.col("id"), F.col("text")], "lang", PER_LANGUAGE, SAMPLE)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            x, letters = gram_counts(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v.tobytes() for v in x.astype(np.float16)], pa.binary())], ["lang", "x"]).filter(pa.array(letters > 0))

    got = sorted((r["lang"], bytes(r["x"])) for r in sample.select("lang", "text").mapInArrow(vectors, "lang string, x binary").collect())
    if not got:
        return [], None
    names = sorted({lang for lang, _ in got})
    at = {lang: i for i, lang in enumerate(names)}
    x = np.frombuffer(b"".join(v for _, v in got), np.float16).reshape(-1, BUCKETS).astype(np.float32)
    return names, fit(x, np.array([at[lang] for lang, _ in got]), len(names))


def predict(df: DataFrame, names: list[str], model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            lang, score, unclear = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            for at in range(0, len(texts) if model else 0, 512):
                x, letters = gram_counts(texts[at : at + 512])
                some = np.flatnonzero(letters)
                if len(some):
                    best, likely, lead = decode(model, x[some])
                    for i, k in zip((some + at).tolist(), best.tolist()):
                        lang[i] = names[k]
                    score[some + at], unclear[some + at] = likely, lead < LEAD
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang), pa.array(score), pa.array(unclear)], ["id", "lang_pred", "score", "ambiguous"])

    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "id long, lang_pred string, score double, ambiguous boolean").withColumnRenamed("id", id_col)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names, model = learn(docs.filter(crc_mod("doc_id", 4) != 2))
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return predict(docs, names, model).select("doc_id", held, "lang_pred", "score", "ambiguous")
