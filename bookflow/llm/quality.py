"""Quality classifier (operator 9): random-indexing word vectors, pooled, and a two-layer network.

Every symbol has a fixed sparse index vector of +1 and -1. A symbol's word vector is the sum of the index vectors of
its neighbours, over a bounded sample of labelled texts, with its own index vector. Words that the sample hasn't often
enough are represented by their shape (letter case, digits, marks). A document is the mean over its tokens, the mean
over its distinct symbols, and its size; a network with one hidden layer gives a score, whose temperature is fitted on
a part of the sample that the weights haven't seen. The sample has about PER_CLASS rows of each label; rows weigh as
their label does among all labelled rows. The executors count its words, add up its word vectors and pool its documents;
only the WORDS most frequent words, their vectors and one pooled vector for each row of the sample come to the driver.

Defined results: null and empty texts are scored like any text without tokens; rows without a label in {0, 1} aren't
learned from; with nothing to learn from every score is 0.5; a row without doc_id isn't held out; a document with several
labels counts with each; a score of exactly 0.5 is label 1; repeated rows are repeated (and learned from once); very
long texts are scored whole; an empty table gives no rows; other columns are ignored by score() and kept by keep().
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, pieces, table, written
from .sampling import per_class

PER_CLASS = 1200
#: Size of vectors, nonzero entries of an index vector, neighbours on each side, uses that make a word known, words known.
SIZE, NONZERO, REACH, USES, WORDS = 48, 6, 2, 5, 20_000
HIDDEN, ROUNDS, RATE, DECAY = 24, 250, 0.01, 1e-3
CACHE_ENTRIES = 200_000
#: Stands for a token that equals one of the last PERIOD tokens.
AGAIN, PERIOD = "~again", 4



def shape(token: str) -> str:
    """Letter case, digits and marks of a token, without its letters."""
    if token.islower() and token.isalpha():
        return f"~{min(len(token) // 4, 4)}"
    marks = "".join(c for c in token if not c.isalnum())[:4]
    case = "A" if token.isupper() and len(token) > 1 else "T" if token[:1].isupper() else "a" if any(map(str.isalpha, token)) else ""
    return f"~{case}{'d' if any(map(str.isdigit, token)) else ''}{marks}"


def index_vector(symbol: str) -> np.ndarray:
    rng = np.random.default_rng(zlib.crc32(symbol.encode()))
    v = np.zeros(SIZE, np.float32)
    v[rng.choice(SIZE, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return v


class Symbols(dict):
    """Token to row of the vector table."""

    def __init__(self, rows: dict[str, int]):
        super().__init__(rows)
        self.rows = rows

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
            self.update(self.rows)
        self[token] = row = self.rows.get(shape(token), 0)
        return row


def rows_of(tokens: list[str], symbols: Symbols) -> np.ndarray:
    """Row of each token; immediate repetition has a row of its own."""
    rows, same = np.fromiter(map(symbols.__getitem__, tokens), np.int64, len(tokens)), np.fromiter(map(hash, tokens), np.int64, len(tokens))
    for lag in range(1, min(PERIOD, len(tokens) - 1) + 1):
        rows[lag:][same[lag:] == same[:-lag]] = symbols.rows[AGAIN]
    return rows


def known_symbols(sample: DataFrame) -> dict[str, int]:
    """Rows of the symbols in the vector table: repetition, shapes, and words with USES or more uses; row 0 stands for all else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches, "text"):
            uses = Counter(t for text in texts for t in text.split())
            shapes = {shape(t) for t in uses}
            yield pa.RecordBatch.from_arrays([pa.array([*uses, *shapes]), pa.array([*uses.values(), *[0] * len(shapes)], pa.int64())], ["symbol", "n"])

    counts = sample.select("text").mapInArrow(run, "symbol string, n long").groupBy("symbol", (F.col("n") == 0).alias("shape")).agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("shape") | (F.col("n") >= USES)).orderBy(F.desc("shape"), F.desc("n"), "symbol").limit(WORDS).collect()
    shapes, words = (sorted(r["symbol"] for r in top if r["shape"] == k) for k in (True, False))
    return {s: i + 1 for i, s in enumerate(dict.fromkeys([AGAIN, *shapes, *words]))}


def word_vectors(sample: DataFrame, rows: dict[str, int]) -> np.ndarray:
    """The vectors of the symbols: sums of whole numbers, so that their order doesn't matter."""
    index = np.stack([index_vector(s) for s in ["", *rows]])
    shared = sample.sparkSession.sparkContext.broadcast((rows, index))  # bounded by WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, index = shared.value
        symbols, sums = Symbols(rows), np.zeros(index.shape, np.float32)
        for _, texts in pieces(batches, "text"):
            for text in texts:
                s = rows_of(text.split(), symbols)
                for reach in range(1, min(REACH, len(s) - 1) + 1):
                    np.add.at(sums, s[:-reach], index[s[reach:]])
                    np.add.at(sums, s[reach:], index[s[:-reach]])
        some = np.flatnonzero(sums.any(axis=1))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(sums[some].astype(np.int64).ravel()), SIZE).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), lists], ["row", "v"])

    sums = sample.select("text").mapInArrow(run, "row int, v array<long>").groupBy("row").agg(F.array(*(F.sum(F.get("v", F.lit(i))) for i in range(SIZE))).alias("v"))
    vectors = index.astype(np.float64)
    for r in sums.collect():
        vectors[r["row"]] += r["v"]
    length = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return (vectors / np.maximum(length, 1e-6)).astype(np.float32)


def features(texts: list[str], symbols: Symbols, vectors: np.ndarray) -> np.ndarray:
    """Pooled vectors and sizes of the texts."""
    out = np.zeros((len(texts), 2 * SIZE + 2), np.float32)
    for i, t in enumerate(texts):
        tokens = t.split()
        if not tokens:
            continue
        seen = np.bincount(rows_of(tokens, symbols))
        at = np.flatnonzero(seen)
        own = vectors[at]
        out[i, :SIZE] = seen[at].astype(np.float32) @ own / len(tokens)
        out[i, SIZE : 2 * SIZE] = own.mean(axis=0)
        out[i, -2:] = np.log1p(len(tokens)) / 8, len(set(tokens)) / len(tokens)
    return out


def forward(net: dict, x: np.ndarray) -> np.ndarray:
    return np.tanh(((x - net["mean"]) / net["spread"]) @ net["w1"] + net["b1"]) @ net["w2"] + net["b2"]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """The network by Adam over four fifths of the rows, then the temperature over the rest."""
    rng = np.random.default_rng(5)
    order = rng.permutation(len(x))
    fit, rest = (order[: len(x) * 4 // 5], order[len(x) * 4 // 5 :]) if len(x) >= 20 else (order, order)
    net = {"mean": x[fit].mean(axis=0), "spread": x[fit].std(axis=0) + 1e-2}
    net |= {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
    names = ("w1", "b1", "w2", "b2")
    m, v = ({k: np.zeros_like(net[k]) for k in names} for _ in range(2))
    z, target, share = (x[fit] - net["mean"]) / net["spread"], y[fit], weight[fit] / weight[fit].sum()
    for t in range(1, ROUNDS + 1):
        hidden = np.tanh(z @ net["w1"] + net["b1"])
        error = (sigmoid(hidden @ net["w2"] + net["b2"]) - target) * share
        back = np.outer(error, net["w2"]) * (1 - hidden**2)
        grads = {"w1": z.T @ back + DECAY * net["w1"], "b1": back.sum(axis=0), "w2": hidden.T @ error + DECAY * net["w2"], "b2": error.sum(keepdims=True)}
        for k in names:
            m[k], v[k] = 0.9 * m[k] + 0.1 * grads[k], 0.999 * v[k] + 0.001 * grads[k] ** 2
            net[k] = net[k] - RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    raw, target, share = forward(net, x[rest]), y[rest], weight[rest]
    losses = [(float((share * np.logaddexp(0, -(2 * target - 1) * raw / heat)).sum()), heat) for heat in np.geomspace(0.25, 8, 61)]
    return net | {"heat": min(losses)[1]}


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict | None:
    """The model, from a bounded sample of labels (id, label) and their documents."""
    rows = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    sample, counts = per_class(rows, [F.col("id")], "label", PER_CLASS, 2 * PER_CLASS)
    if not counts:
        return None
    # The sample has about 2 x PER_CLASS distinct ids at any size of the table, so it is safe to broadcast.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "id")
    drawn = written(per_class(written(texts, "labelled"), [F.col("id"), F.col("text")], "label", PER_CLASS, 2 * PER_CLASS)[0], "sample")
    if drawn.isEmpty():
        return None
    known = known_symbols(drawn)
    vectors = word_vectors(drawn, known)
    shared = docs.sparkSession.sparkContext.broadcast((known, vectors))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, own = shared.value
        symbols = Symbols(rows)
        for part, texts in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v.tobytes() for v in features(texts, symbols, own)], pa.binary())], ["label", "x"])

    got = sorted((r["label"], bytes(r["x"])) for r in drawn.select("label", "text").mapInArrow(pooled, "label int, x binary").collect())
    x = np.frombuffer(b"".join(v for _, v in got), np.float32).reshape(len(got), -1).astype(np.float64)
    y = np.array([label for label, _ in got], np.float64)
    taken = Counter(y.astype(int).tolist())
    weight = np.array([counts[int(k)] / taken[int(k)] for k in y])
    return {"net": train(x, y, weight), "rows": known, "vectors": vectors}


def scores(own: dict | None, symbols: Symbols | None, texts: list[str]) -> np.ndarray:
    return sigmoid(forward(own["net"], features(texts, symbols, own["vectors"])) / own["net"]["heat"]) if own else np.full(len(texts), 0.5)


def score(df: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        symbols = Symbols(own["rows"]) if own else None
        for part, texts in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(own, symbols, texts), pa.float64())], ["id", "score"])

    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)


def keep(df: DataFrame, model: dict | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of df whose score is `least` or more, with all their columns; no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        symbols = Symbols(own["rows"]) if own else None
        for part, texts in pieces(batches, text_col):
            yield part.filter(pa.array(scores(own, symbols, texts) >= least))

    return df.mapInArrow(run, df.schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.filter(crc_mod("doc_id", 3) != 1))
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
