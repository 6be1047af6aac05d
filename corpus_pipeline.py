"""A corpus pipeline of five operators of bookflow.llm, over the table documents.

Each stage takes (spark, docs, sf_dir) and returns a table with the columns of documents; the last returns token ids.
run() writes every stage's result to the shared folder and reads it back as the next one's docs.

Defined results: null and empty texts go through like others (scored as a text without words, one of all texts
without words stays, no tokens); rows without doc_id are kept where their group has no other;
empty tables give an empty result; other columns are carried along up to the last stage, whatever their names; very
long texts are handled whole; of near-duplicates that tie by id the smaller text hash stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.llm import bpe, decontaminate, pii, quality, shingles
from bookflow.llm.common import table, unused, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of operator 9 rejects go. It learns from all labels."""
    return quality.keep(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 2 on five-word shingles, verified at a Jaccard of 0.8) stays."""
    return shingles.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a stretch of a benchmark item (operator 4) go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become surrogates (operator 3); n_chars follows the text."""
    # the stage's rows keep their own columns; an input column named pii_kinds comes back beside them
    own, = unused(docs, "pii_kinds_of_input")
    given = docs.withColumnRenamed("pii_kinds", own) if "pii_kinds" in docs.columns else docs
    found = pii.replace(given)
    n_chars = F.when(F.size("pii_kinds") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    found = found.withColumn("n_chars", n_chars).drop("pii_kinds")
    return found.withColumnRenamed(own, "pii_kinds").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and offsets of the texts (operator 1), and a digest of what they decode to."""
    encoded = bpe.encode(docs, verify=True).withColumn("n_tokens", F.size("ids").cast("long"))
    return encoded.select("doc_id", "n_tokens", "ids", "offsets", "decoded_sha256")


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii_surrogates), ("byte_bpe", byte_bpe)]

#: Classifiers, fingerprints and token ids can't be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
