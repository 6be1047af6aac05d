"""Checkpoint tables: tolerant scans, what is left to do, merges and the choice of a run to resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from bookflow.functions import text as T

PAGE = t.StructType([t.StructField("source", t.StringType()), t.StructField("kind", t.StringType()), t.StructField("page_number", t.IntegerType()), *(t.StructField(n, t.StringType()) for n in ("embedded_text", "ocr_text", "translation", "notes", "image_path"))])
REQUIRED = ["source", "kind", "page_number"]
OPTIONAL = ["embedded_text", "ocr_text", "translation", "notes", "image_path"]


def tolerant(rows: DataFrame) -> DataFrame:
    """Page records without those that lack a required field; missing texts are empty."""
    return rows.dropna(subset=REQUIRED).fillna("", subset=OPTIONAL)


def scan(rows: DataFrame, order: str = "file_name") -> DataFrame:
    """The record of the last file for each page."""
    last = Window.partitionBy("book_id", "page_number").orderBy(F.desc(order))
    return rows.withColumn("nth", F.row_number().over(last)).filter("nth = 1").drop("nth")


def pending(pages: DataFrame, done: DataFrame) -> DataFrame:
    """Pages without a checkpoint; put before any costly stage, since joins aren't pushed below Python stages."""
    return pages.join(done.select("book_id", "page_number"), ["book_id", "page_number"], "left_anti")


def reused(pages: DataFrame, done: DataFrame) -> DataFrame:
    return pages.join(done.select("book_id", "page_number"), ["book_id", "page_number"], "left_semi")


def merge(new: DataFrame, old: DataFrame, values: list[str]) -> DataFrame:
    """Pages of both; a new record wins as a whole."""
    keys = ["book_id", "page_number"]
    a = new.select(*keys, F.struct(*values).alias("new_record"))
    b = old.select(*keys, F.struct(*values).alias("old_record"))
    return a.join(b, keys, "full_outer").select(*keys, F.coalesce("new_record", "old_record").alias("r")).select(*keys, "r.*")


def needs_translation() -> Column:
    return T.strip(F.coalesce(F.col("translation"), F.lit(""))) == ""


def resume_point(done: DataFrame) -> DataFrame:
    """(book_id, resume_page): one past the largest checkpointed page; gaps below are not filled."""
    return done.groupBy("book_id").agg((F.max("page_number") + 1).alias("resume_page"))


def page_range(pages: DataFrame, start: int = 1, most: int | None = None, resume: DataFrame | None = None) -> DataFrame:
    """Pages from max(1, start), or from the book's resume page, and at most so many."""
    first = F.lit(max(1, start))
    if resume is not None:
        pages, first = pages.join(resume, "book_id", "left"), F.coalesce("resume_page", F.lit(max(1, start)))
    kept = pages.filter(F.col("page_number") >= first)
    if most is not None:
        kept = kept.filter(F.col("page_number") < first + most)
    return kept.drop("resume_page")


def gaps(pages: DataFrame, done: DataFrame) -> DataFrame:
    """The other way to resume: every page without a checkpoint, gaps included."""
    return pending(pages, done)


RESUME_ORDER = ["n_checkpoints", "n_images", "mtime", "run_dir"]


def best_run(runs: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The first run of each group by the order; partial aggregation, no window over all runs."""
    return runs.groupBy(group).agg(F.max_by(F.struct(*runs.columns), F.struct(*order)).alias("r")).select("r.*")


def resume_choice(runs: DataFrame, group: str = "slug") -> DataFrame:
    """Most checkpoints, then most images, then newest."""
    return best_run(runs, group, [F.col(c) for c in RESUME_ORDER])


def monitor_choice(runs: DataFrame, group: str = "slug") -> DataFrame:
    """Unfinished first, then most files, then newest."""
    done = F.col("has_translation") & F.col("has_summary")
    return best_run(runs, group, [~done, F.col("n_images") + F.col("n_checkpoints"), F.col("mtime"), F.col("run_dir")])
