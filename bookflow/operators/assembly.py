"""Assembly of page, chunk and section texts into documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators.lines import joined


def page_markdown(pages: DataFrame, field: str) -> DataFrame:
    """(book_id, text): the pages' values under page headers, in page order; notes follow recognised text. One line end if there is none."""
    value = T.strip(F.coalesce(F.col(field), F.lit("")))
    note = F.when(F.lit(field == "ocr_text") & (F.coalesce("notes", F.lit("")) != ""), F.concat(F.lit("\n\n> OCR 备注："), F.col("notes"))).otherwise("")
    part = F.when(value != "", F.concat(F.format_string("## 第 %d 页\n\n", F.col("page_number")), value, note))
    rows = pages.select("book_id", "page_number", part.alias("part"))
    return rows.groupBy("book_id").agg(joined("page_number", "part", "\n\n").alias("text")).select("book_id", F.concat(T.strip(F.col("text")), F.lit("\n")).alias("text"))


def has_any(field: str) -> F.Column:
    return F.max(T.strip(F.coalesce(F.col(field), F.lit(""))) != "")


def extracted(pages: DataFrame) -> DataFrame:
    """(book_id, field, text): recognised text if any page has some, else embedded text."""
    own = F.max(T.strip(F.col("ocr_text")) != "").over(Window.partitionBy("book_id"))
    chosen = pages.withColumn("recognised", own)
    value = chosen.select("book_id", "page_number", "notes", "recognised", F.when(F.col("recognised"), F.col("ocr_text")).otherwise(F.col("embedded_text")).alias("value"))
    bare = T.strip(F.col("value"))
    note = F.when(F.col("recognised") & (F.col("notes") != ""), F.concat(F.lit("\n\n> OCR 备注："), F.col("notes"))).otherwise("")
    part = F.when(bare != "", F.concat(F.format_string("## 第 %d 页\n\n", F.col("page_number")), bare, note))
    out = value.select("book_id", "page_number", "recognised", part.alias("part")).groupBy("book_id", "recognised").agg(joined("page_number", "part", "\n\n").alias("text"))
    return out.select("book_id", F.when(F.col("recognised"), "ocr_text").otherwise("embedded_text").alias("field"), F.concat(T.strip(F.col("text")), F.lit("\n")).alias("text"))


def summary_source(pages: DataFrame) -> DataFrame:
    """(book_id, field, text): the translation if there is any, else recognised text; embedded text is never used."""
    a = page_markdown(pages, "translation").withColumnRenamed("text", "a")
    b = page_markdown(pages, "ocr_text").withColumnRenamed("text", "b")
    both = a.join(b, "book_id")
    some = T.strip(F.col("a")) != ""
    return both.select("book_id", F.when(some, "translation").otherwise("ocr_text").alias("field"), F.when(some, F.col("a")).otherwise(F.col("b")).alias("text"))


def reassemble(sections: DataFrame) -> DataFrame:
    """(book_id, text) of repaired sections under headers; the preamble is dropped."""
    part = F.concat(F.lit("## "), F.col("title"), F.lit("\n\n"), F.col("content"))
    return sections.filter(F.col("title") != rules.PREAMBLE).select("book_id", "section_no", part.alias("part")).groupBy("book_id").agg(joined("section_no", "part", "\n\n\n").alias("text"))
