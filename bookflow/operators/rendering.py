"""Block tables for LaTeX, Word and PDF outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators.lines import joined


def paragraphs(content: F.Column, pack: list[str] = rules.SECTION_NOISE) -> F.Column:
    """array<string>: paragraphs of a text without noise lines, within the row; lines of a paragraph are joined by a blank."""
    kept = F.filter(F.transform(F.split(content, "\n"), lambda x: T.strip(x)), lambda x: ~T.matches(x, pack))
    parts = F.transform(F.split(F.array_join(kept, "\n"), "\n{2,}"), lambda p: F.replace(F.btrim(p, F.lit("\n")), F.lit("\n"), F.lit(" ")))
    return F.filter(parts, lambda p: p != "")


def latex_body(sections: DataFrame) -> DataFrame:
    """(book_id, latex): headings and escaped paragraphs of all sections but the preamble, a blank line after each."""
    title = T.escape_latex(F.col("title"))

    def starred(name: F.Column) -> F.Column:
        return F.concat(F.lit("\\chapter*{"), name, F.lit("}\n\\addcontentsline{toc}{chapter}{"), name, F.lit("}\n"))

    head = F.when(F.col("title") == "序 文", starred(F.lit("序 文"))).when(F.col("title").isin(rules.STARRED), starred(title)).otherwise(F.concat(F.lit("\\section{"), title, F.lit("}\n")))
    body = F.transform(paragraphs(F.col("content")), lambda p: F.concat(F.when(p.rlike(rules.FOOTNOTE), "\\noindent ").otherwise(""), T.escape_latex(p), F.lit("\n")))
    block = F.array_join(F.concat(F.array(head), body), "\n")
    own = sections.filter(F.col("title") != rules.PREAMBLE).select("book_id", "section_no", block.alias("block"))
    return own.groupBy("book_id").agg(joined("section_no", "block", "\n").alias("latex"))


def latex_document(body: str, title: str, author: str = "") -> str:
    """A compilable book around a body made by latex_body."""
    return "\n".join(["\\documentclass[a4paper,12pt]{book}", "\\usepackage[UTF8]{ctex}", "\\usepackage{geometry,setspace,parskip}", "\\onehalfspacing", f"\\title{{{title}}}", f"\\author{{{author}}}", "\\begin{document}", "\\maketitle", "\\tableofcontents", body, "\\end{document}", ""])


def toc_page_blocks(contents: DataFrame) -> DataFrame:
    """(toc_no, kind, title, points): how each line of the contents page is set."""
    child, part = F.col("parent").isNotNull(), F.col("title").isin("Ⅰ", "Ⅱ")
    return contents.select("toc_no", F.when(child, "child").when(part, "part").otherwise("top").alias("kind"), "title", F.when(child, 11).when(part, 14).otherwise(12).alias("points"))


def formatted_blocks(merged: DataFrame) -> DataFrame:
    """(book_id, para_no, style, n_lines, content) of merged paragraphs; a paragraph's lines are soft breaks."""
    style = F.when(F.col("level") > 0, F.concat(F.lit("heading"), F.col("level").cast("string"))).when(F.col("content").rlike(rules.FOOTNOTE), "footnote").otherwise("body")
    return merged.select("book_id", "para_no", style.alias("style"), F.size(F.split("content", "\n")).alias("n_lines"), "content")


def final_blocks(sections: DataFrame) -> DataFrame:
    """(book_id, part_no, section_no, para_no, style, page_before, centred, points, text): cover, contents page and body of the final Word file.

    Parts 0, 1 and 2; the two parts of the book and titles with a star begin a page; footnotes are small, other paragraphs are indented.
    """
    columns = ["part_no", "section_no", "para_no", "style", "page_before", "centred", "points", "text"]
    part = lambda title: title in ("Ⅰ", "Ⅱ")
    front = [(0, i, 0, "cover", False, True, points, text) for i, (text, points) in enumerate(rules.COVER)] + [(1, 0, 0, "heading1", True, True, 16, rules.CONTENTS_HEAD)]
    front += [(1, i, 0, "child" if parent else "part" if part(title) else "top", False, False, 11 if parent else 14 if part(title) else 12, title) for i, (title, parent, _) in enumerate(rules.CONTENTS, 1)]
    listed = F.array(*(F.struct(*(F.lit(x).alias(c) for c, x in zip(columns, row, strict=True))) for row in front))
    fixed = sections.select("book_id").distinct().select("book_id", F.explode(listed).alias("b")).select("book_id", "b.*")
    own = sections.filter(F.col("title") != rules.PREAMBLE)
    new_page = F.col("title").isin("Ⅰ", "Ⅱ", *rules.STARRED)
    first = new_page | (F.col("title") == "序 文")
    head = F.struct(F.when(first, "heading1").otherwise("heading2").alias("style"), new_page.alias("page_before"), first.alias("centred"), F.when(first, 16).otherwise(14).alias("points"), F.col("title").alias("text"))
    note = lambda p: p.rlike(rules.FOOTNOTE)
    body = F.transform(paragraphs(F.col("content")), lambda p: F.struct(F.when(note(p), "footnote").otherwise("indented").alias("style"), F.lit(False).alias("page_before"), F.lit(False).alias("centred"), F.when(note(p), 9).otherwise(11).alias("points"), p.alias("text")))
    text = own.select("book_id", F.lit(2).alias("part_no"), F.col("section_no").cast("int").alias("section_no"), F.posexplode(F.concat(F.array(head), body)).alias("para_no", "b")).select("book_id", "part_no", "section_no", "para_no", "b.*")
    return fixed.union(text)


def formatted_parts(merged: DataFrame) -> DataFrame:
    """The blocks of the formatted Word file in the columns of final_blocks: a title page, then merged paragraphs; a first-level title begins a page."""
    front = F.array(*(F.struct(F.lit(0).alias("part_no"), F.lit(i).alias("para_no"), F.lit("title" if i == 0 else "cover").alias("style"), F.lit(False).alias("page_before"), F.lit(True).alias("centred"), F.lit(points).alias("points"), F.lit(text).alias("text")) for i, (text, points) in enumerate([(rules.COVER[0][0], 28), (rules.COVER_LINE, 11)])))
    top = F.col("level") == 1
    body = merged.select("book_id", F.lit(1).alias("part_no"), F.lit(0).alias("section_no"), F.col("para_no").cast("int"), F.when(F.col("level") > 0, F.concat(F.lit("heading"), F.col("level").cast("string"))).otherwise("body").alias("style"), top.alias("page_before"), top.alias("centred"), F.when(F.col("level") > 0, 18 - 2 * F.col("level")).otherwise(11).cast("int").alias("points"), F.col("content").alias("text"))
    cover = merged.select("book_id").distinct().select("book_id", F.explode(front).alias("b")).select("book_id", "b.part_no", F.lit(0).alias("section_no"), "b.para_no", "b.style", "b.page_before", "b.centred", "b.points", "b.text")
    return cover.union(body)


def report_blocks(texts: DataFrame, kind: str) -> DataFrame:
    """Blocks of a report for a Word or a PDF writer, of (book_id, text, ...): parts for info, summary, the translation (text) and extracted.

    The parts of info and extracted are left out where their column isn't there; any other that is empty says so. Lines of info are set small.
    """
    names = [("info", ""), ("summary", rules.NO_SUMMARY), ("text", rules.NO_TRANSLATION), ("extracted", rules.NO_EXTRACT)]
    given = [(i, name, none) for i, (name, none) in enumerate(names) if name in texts.columns or name == "summary"]
    texts = texts if "summary" in texts.columns else texts.withColumn("summary", F.lit(""))
    value = lambda name, none: F.when(T.is_blank(F.coalesce(F.col(name), F.lit(""))), none).otherwise(F.col(name))
    parts = texts.select("book_id", F.explode(F.array(*(F.struct(F.lit(i).alias("part_no"), F.lit(rules.REPORT_PARTS[i]).alias("head"), value(name, none).alias("text")) for i, name, none in given))).alias("p"))
    each = parts.select("book_id", "p.part_no", "p.head", F.posexplode(T.splitlines(F.col("p.text"))).alias("line_no", "line"))
    if kind == "docx":
        return each.select("book_id", "part_no", "head", "line_no", T.block_docx(F.col("line")).alias("b")).select("book_id", "part_no", "head", "line_no", "b.*")
    return each.select("book_id", "part_no", "head", "line_no", F.posexplode(T.blocks_pdf(F.col("line"))).alias("block_no", "b")).select("book_id", "part_no", "head", "line_no", "block_no", F.when(F.col("part_no") == 0, "meta").otherwise(F.col("b.kind")).alias("kind"), "b.text")
