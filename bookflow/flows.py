"""Whole flows: documents to report, translated Markdown to typeset book, and repair of broken lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators import assembly, checkpoints, lines, model_calls, rendering, sections


def book_id(pages: DataFrame) -> DataFrame:
    """Page records (source, ...) with a book id made of the file's name."""
    stem = F.regexp_extract("source", r"([^/\\]+?)(\.[^./\\]*)?$", 1)
    return pages.withColumn("book_id", T.slugify(stem))


def ocr_pages(pages: DataFrame, done: DataFrame, state: str, client: str = "fake", pause: float = 0.0) -> DataFrame:
    """Pages (book_id, page_number, image, embedded_text, ...) with ocr_text, notes and error.

    Pages that `done` (book_id, page_number, ocr_text, notes) has aren't read again (with images of a broken run as
    pages this is its recovery). Replies are saved below `state` as they come.
    """
    keys = ["book_id", "page_number"]
    new = model_calls.ocr(checkpoints.pending(pages, done), client=client, pause=pause, journal=f"{state}/ocr_replies")
    old = pages.drop("ocr_text", "notes").join(done.select(*keys, "ocr_text", "notes"), keys).withColumn("error", F.lit(None).cast("string"))
    return new.union(old.select(*new.columns))


def translate_report(pages: DataFrame, done: DataFrame, state: str, client: str = "fake", resume: bool = True, translate_chars: int = 16000, summary_chars: int = 24000, pause: float = 0.0, summarize: bool = True) -> dict[str, DataFrame]:
    """Pages (book_id, page_number, kind, embedded_text, ocr_text, notes) to extracted text, translation and summary of each book.

    Pages that `done` has translated are taken from there if resume is set. Each paid reply is saved below `state` as it
    comes, so that a run that broke off goes on from there. `failures` counts the pages that couldn't be translated; they
    have no translation and are sent again by the next run.
    """
    spark, keys = pages.sparkSession, ["book_id", "page_number"]

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{state}/{name}")
        return spark.read.parquet(f"{state}/{name}")

    translated = done.filter(~checkpoints.needs_translation()).select(*keys, "translation") if resume else None
    todo = pages if translated is None else checkpoints.pending(pages, translated)
    new = kept(model_calls.translate(todo, translate_chars, client=client, pause=pause, journal=f"{state}/replies"), "translation")
    both = new if translated is None else new.union(checkpoints.reused(translated, pages).select(*keys, "translation", F.lit(None).cast("string")))
    full = pages.drop("error").join(both, keys)
    out = {"extracted": assembly.extracted(full), "translation": assembly.page_markdown(full, "translation"), "pages": full, "failures": model_calls.failures(full)}
    if summarize:
        source = assembly.summary_source(full)
        out["summary"] = kept(model_calls.two_level_summary(source, summary_chars, client=client, pause=pause, journal=f"{state}/replies"), "summary")
    return out


def typeset(books: DataFrame) -> dict[str, DataFrame]:
    """(book_id, text) of translated Markdown to LaTeX bodies and to the blocks of the final, the formatted and the report file."""
    marked = books.select("book_id", T.strip_page_markers(F.col("text")).alias("text"))
    cut = sections.section_extents(marked, lines.explode_lines(marked))
    merged = lines.merge_paragraphs(lines.clean_content(lines.explode_lines(books)))
    return {"sections": cut, "latex": rendering.latex_body(cut), "formatted": rendering.formatted_blocks(merged), "final": rendering.final_blocks(cut), "formatted_parts": rendering.formatted_parts(merged), "report": rendering.report_blocks(books, "docx")}


def repair(books: DataFrame, client: str = "fake", most: int = 8000, titles: list[str] = rules.REPAIR_TITLES) -> DataFrame:
    """(book_id, text, n_before, n_after): repaired text and the broken lines before and after."""
    fixed = model_calls.repair(sections.section_split_lines(lines.explode_lines(books), titles), most, client=client)
    after = assembly.reassemble(fixed)
    before = books.select("book_id", T.broken_lines(F.col("text")).alias("n_before"))
    return after.join(before, "book_id").withColumn("n_after", T.broken_lines(F.col("text")))
