"""Shared helpers: table reads, written intermediate tables, hashing of ids, Arrow batching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points handled at once by the vectorised text kernels.
CHUNK_CHARS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only in local mode and where none is configured (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='bookflow-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/bookflow/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Removes the files of a table from written() that nothing reads any more."""
    remove(df.sparkSession, df.written_to.rpartition("/")[0])


def clean_up(spark: SparkSession) -> None:
    """Removes all intermediate tables and archives below the shared folder; results read from them must be saved before."""
    remove(spark, f"{shared_dir(spark)}/bookflow")


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has, in any letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def crc_mod(id_col: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cuts record batches so that each holds about `limit` code points, and gives the texts (null as '')."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        start, size, texts = 0, 0, []
        for i in range(0, batch.num_rows, 256):
            for t in batch.column(at).slice(i, 256).to_pylist():
                texts.append(t or "")
                size += len(texts[-1])
                if size >= limit:
                    yield batch.slice(start, len(texts)), texts
                    start, size, texts = start + len(texts), 0, []
        if texts:
            yield batch.slice(start, len(texts)), texts


def segments(text: str, limit: int) -> Iterator[str]:
    """Cuts a text of more than `limit` code points before blanks or line ends that follow other characters.

    A pre-token never reaches over such a place, so the pre-tokens of the segments are those of the text.
    """
    start, nearest = 0, {" ": -1, "\n": -1}
    while len(text) - start > limit:
        at = start + limit
        while True:
            for c, place in nearest.items():
                if place < at:
                    found = text.find(c, at)
                    nearest[c] = found if found >= 0 else len(text)
            at = min(nearest.values())
            if at == len(text) or not text[at - 1].isspace():
                break
            at += 1
        if at == len(text):
            break
        yield text[start:at]
        start = at
    yield text[start:]


def blocks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Segments of the texts with the place of their text, in order; about `limit` code points together, one segment of a text at most."""
    owners, held, size = [], [], 0
    for i, text in enumerate(texts):
        for part in segments(text, limit):
            if held and (size + len(part) > limit or owners[-1] == i):
                yield np.array(owners, np.int64), held
                owners, held, size = [], [], 0
            owners.append(i)
            held.append(part)
            size += len(part)
    if held:
        yield np.array(owners, np.int64), held
