"""Line tables: explosion of texts, offsets, cleaning and paragraphs, as windows over (book_id, line_no).

A book is the unit of order, so its lines share one window partition; books are bounded, tables of books are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T


def ordered(*more: str) -> Window:
    return Window.partitionBy("book_id").orderBy("line_no", *more)


def upto() -> Window:
    return ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def joined(order: str, value: str | Column, sep: str) -> Column:
    """Ordered concatenation of a group's strings; null values are left out."""
    value = F.col(value) if isinstance(value, str) else value
    entries = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(F.col(order).alias("o"), value.alias("v")))))
    return F.array_join(F.transform(entries, lambda e: e["v"]), sep)


def explode_lines(books: DataFrame) -> DataFrame:
    """(book_id, text) to (book_id, line_no, line), line_no from 0; the line after a last line end is kept."""
    return books.select("book_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def with_offsets(lines: DataFrame) -> DataFrame:
    """Adds the offset of each line in its text, in code points."""
    before = ordered().rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("line_offset", F.coalesce(F.sum((F.length("line") + 1).cast("long")).over(before), F.lit(0).cast("long")))


def clean_sections(lines: DataFrame, pack: list[str] = rules.SECTION_NOISE) -> DataFrame:
    """Lines without noise; kept lines stay as they are."""
    return lines.filter(~T.is_noise(F.col("line"), pack))


def clean_content(lines: DataFrame) -> DataFrame:
    """Lines of the body: no page headers, numbers, noise, first pages or copyright parts."""
    line, bare = F.col("line"), T.strip(F.col("line"))
    marker = T.is_page_marker(line)
    opens = marker & (F.regexp_extract(line, rf"^## 第 ({T.DIGIT}+) 页", 1).cast("int") >= rules.FIRST_KEPT_PAGE)
    starts = T.matches(bare, rules.COPYRIGHT_STARTS)
    ends = T.matches(bare, [rules.COPYRIGHT_END])
    event = F.when(opens, F.lit(False)).when(starts, F.lit(True)).when(ends, F.lit(False))
    flagged = lines.select("*", marker.alias("marker"), starts.alias("starts"), event.alias("event"), F.when(opens, 1).otherwise(0).alias("opens"))
    state = flagged.withColumn("inside", F.coalesce(F.last("event", ignorenulls=True).over(upto()), F.lit(False))).withColumn("begun", F.max("opens").over(upto()))
    kept = state.filter((F.col("begun") == 1) & ~F.col("marker") & ~F.col("starts") & ~F.col("inside") & ~T.is_page_number(line) & ~T.is_noise(line))
    return kept.select(*lines.columns)


def text_to_paragraphs(lines: DataFrame) -> DataFrame:
    """(book_id, para_no, paragraph): stripped lines between blank ones, joined by a blank; para_no from 1."""
    marked = lines.select("book_id", "line_no", T.strip(F.col("line")).alias("bare")).withColumn("island", F.sum((F.col("bare") == "").cast("int")).over(upto()))
    paras = marked.filter("bare <> ''").groupBy("book_id", "island").agg(joined("line_no", "bare", " ").alias("paragraph"))
    return paras.select("book_id", F.row_number().over(Window.partitionBy("book_id").orderBy("island")).alias("para_no"), "paragraph")


def merge_paragraphs(lines: DataFrame) -> DataFrame:
    """(book_id, para_no, content, level): paragraphs (level 0) and titles, each title once where it comes first."""
    marked = lines.select("book_id", "line_no", T.strip(F.col("line")).alias("bare")).withColumn("level", T.title_level(F.col("bare")))
    cut = (F.col("bare") == "") | F.col("level").isNotNull()
    # a title opens an island of its own, so one aggregation gathers titles and paragraphs
    marked = marked.withColumn("island", F.sum(cut.cast("int")).over(upto())).filter("bare <> ''")
    part = F.struct("book_id", "island", F.coalesce("level", F.lit(0)).alias("level"))
    whole = marked.groupBy(part.alias("g")).agg(F.min("line_no").alias("at"), joined("line_no", "bare", "\n").alias("content")).select("g.*", "at", "content")
    first = Window.partitionBy("book_id", "content", F.col("level") > 0).orderBy("at")
    kept = whole.withColumn("nth", F.when(F.col("level") > 0, F.row_number().over(first)).otherwise(1)).filter("nth = 1")
    return kept.select("book_id", F.row_number().over(Window.partitionBy("book_id").orderBy("at")).alias("para_no"), "content", "level")
