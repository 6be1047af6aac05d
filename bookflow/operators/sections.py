"""Sections of books: by a table of contents, and by title lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators.lines import joined, ordered, upto, with_offsets


def contents(spark: SparkSession) -> DataFrame:
    """The contents as a table; a rule pack, small by its nature."""
    rows = [(i + 1, t, p, k) for i, (t, p, k) in enumerate(rules.CONTENTS)]
    return spark.createDataFrame(rows, "toc_no int, title string, parent string, keywords array<string>")


def toc_region(lines: DataFrame) -> DataFrame:
    """(book_id, toc_start, toc_end), both inclusive, of books with a region: the last start line before the first end line after a start, and two lines past that. A start at line 0 does not count."""
    bare = T.strip(F.col("line"))
    start, end = T.matches(bare, [rules.CONTENTS_START]), T.matches(bare, [rules.CONTENTS_END])
    marked = lines.select("book_id", "line_no", F.when(start, F.col("line_no")).alias("s"), end.alias("e"))
    marked = marked.withColumn("last_start", F.last("s", ignorenulls=True).over(upto()))
    hits = marked.filter(F.col("e") & (F.col("last_start") > 0))
    return hits.groupBy("book_id").agg(F.min(F.struct("line_no", "last_start")).alias("h")).select("book_id", F.col("h.last_start").alias("toc_start"), (F.col("h.line_no") + rules.CONTENTS_TAIL).alias("toc_end"))


def with_region(lines: DataFrame) -> DataFrame:
    """Adds bare (the stripped line) and in_toc; windows over the book alone, so there is no join and no other shuffle."""
    bare = T.strip(F.col("line"))
    marked = lines.withColumn("bare", bare).withColumn("toc_s", F.when(T.matches(F.col("bare"), [rules.CONTENTS_START]), F.col("line_no")))
    marked = marked.withColumn("toc_s", F.last("toc_s", ignorenulls=True).over(upto()))
    hit = F.when(T.matches(F.col("bare"), [rules.CONTENTS_END]) & (F.col("toc_s") > 0), F.struct("line_no", "toc_s"))
    first = F.min(hit).over(Window.partitionBy("book_id"))
    inside = F.col("line_no").between(F.col("toc_h.toc_s"), F.col("toc_h.line_no") + rules.CONTENTS_TAIL)
    return marked.withColumn("toc_h", first).withColumn("in_toc", F.coalesce(inside, F.lit(False))).drop("toc_s", "toc_h")


def section_positions(lines: DataFrame, titles: list[str] = rules.REPAIR_TITLES) -> DataFrame:
    """(book_id, section_no, title, line_offset): the first line outside the contents that equals each title."""
    placed = with_region(with_offsets(lines)).filter(F.col("bare").isin(titles) & ~F.col("in_toc"))
    first = placed.groupBy("book_id", F.col("bare").alias("title")).agg(F.min("line_offset").alias("line_offset"))
    return first.select("book_id", F.row_number().over(Window.partitionBy("book_id").orderBy("line_offset")).alias("section_no"), "title", "line_offset")


def section_extents(books: DataFrame, lines: DataFrame) -> DataFrame:
    """(book_id, section_no, title, content): from each title to the next, stripped; what precedes the first is section 0. Both sides of the join are dealt by book already."""
    at = section_positions(lines).groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("line_offset", "section_no", "title"))).alias("at"))
    whole = at.join(books.select("book_id", "text"), "book_id")

    def content(x, i):
        stop = F.coalesce(F.get("at", i + 1)["line_offset"], F.length("text").cast("long"))
        return T.strip(F.substr(F.col("text"), (x["line_offset"] + 1).cast("int"), (stop - x["line_offset"]).cast("int")))

    own = F.transform("at", lambda x, i: F.struct(x["section_no"].alias("section_no"), x["title"].alias("title"), content(x, i).alias("content")))
    front = F.struct(F.lit(0).alias("section_no"), F.lit(rules.PREAMBLE).alias("title"), T.strip(F.substr(F.col("text"), F.lit(1), F.get("at", F.lit(0))["line_offset"].cast("int"))).alias("content"))
    all_ = F.concat(F.filter(F.array(front), lambda x: x["content"] != ""), own)
    return whole.select("book_id", F.explode(all_).alias("s")).select("book_id", "s.*")


def section_split_lines(lines: DataFrame, titles: list[str] = rules.REPAIR_TITLES) -> DataFrame:
    """(book_id, section_no, title, content): a title line starts a section and isn't in it; a section without lines is dropped."""
    bare = T.strip(F.col("line"))
    marked = lines.select("book_id", "line_no", "line", F.when(bare.isin(titles), bare).alias("title"))
    marked = marked.withColumn("section_no", F.count("title").over(upto())).withColumn("name", F.coalesce(F.last("title", ignorenulls=True).over(upto()), F.lit(rules.PREAMBLE)))
    return marked.filter("title is null").groupBy("book_id", F.col("section_no").cast("int").alias("section_no"), F.col("name").alias("title")).agg(joined("line_no", "line", "\n").alias("content"))
