"""Page, book and line views of the driver's tables, for both engines.

A book is a block of BLOCK documents of one source, so a book's size doesn't grow with the table. Titles, running
heads, noise, footnotes and broken lines are injected by page number, with the same SQL text in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bookflow import rules
from bookflow.functions.text import any_of

BLOCK = 4000
NL = "chr(10)"


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


#: Lines put in front of a page's text, by page number.
TITLE_AT = {7 + i: t for i, t in enumerate(rules.REPAIR_TITLES)} | {7 + len(rules.REPAIR_TITLES) + i: t for i, t in enumerate(["夏目漱石论", "第一部", "麦克白论", "文学的衰灭"])}
EXTRA = {
    "page_number = 1": ["定本 柄谷行人文学论集"], "page_number = 2": ["图书在版编目", "ISBN 978"], "page_number = 3": ["《亚历山大四重奏》的辩证法 / 12", "译后记 / 320", "柄谷行人：移动的文学批评 / 330", "", "Ⅰ"],
    "page_number = 10": ["定本 柄谷行人文学论集 [存疑]", "版  次：1"], "page_number % 3 = 0": ["12"], "page_number % 4 = 0": ["004 | 定本柄谷行人文学论集", "序文 | 001"], "page_number % 5 = 0": ["ISBN 9", "  ① a note_5% "],
    "page_number % 6 = 0": ["定价：38", "责任编辑：x"], "page_number % 7 = 0": ["一、小节", "1.5 倍"], "page_number % 8 = 0": ["# Head 「q」", "### Sub", "- item", "2. second"], "page_number % 9 = 0": [" # $ & {x} ~ ^ \"q\" "],
}


def lines_sql(lines: list[str]) -> str:
    return " || ".join(f"{quoted(x)} || {NL}" for x in lines)


def body_sql() -> str:
    titles = " ".join(f"WHEN {n} THEN {quoted(t)} || {NL} || {NL}" for n, t in TITLE_AT.items())
    extra = " || ".join(f"CASE WHEN {c} THEN {lines_sql(ls)} ELSE '' END" for c, ls in EXTRA.items())
    spaced = f"CASE WHEN page_number % 2 = 0 THEN replace(embedded_text, {NL}, '//' || {NL} || {NL}) ELSE embedded_text END"
    return f"(CASE page_number {titles} ELSE '' END) || {extra} || {spaced}"


PAGES = f"""
SELECT *, {{body}} AS translation FROM (
 SELECT source || '-' || CAST(CAST(floor(doc_id / {BLOCK}.0) AS BIGINT) AS STRING) AS book_id, doc_id, 'pdf_page' AS kind,
  CAST(row_number() OVER (PARTITION BY source, CAST(floor(doc_id / {BLOCK}.0) AS BIGINT) ORDER BY doc_id) AS INT) AS page_number,
  coalesce(text, '') AS embedded_text, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 11 = 0 THEN '  ' ELSE coalesce(text, '') END AS ocr_text,
  CASE WHEN doc_id % 7 = 0 THEN 'n' || CAST(doc_id AS STRING) ELSE '' END AS notes
 FROM {{documents}}) p
"""
#: White space of a strip, for DuckDB's trim.
WHITE = "(" + " || ".join(f"chr({c})" for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]) + ")"


def strip_sql(x: str) -> str:
    return f"trim({x}, {WHITE})"


def rstrip_sql(x: str) -> str:
    return f"rtrim({x}, {WHITE})"


def matches_sql(x: str, patterns: list[str]) -> str:
    return f"regexp_matches({x}, {quoted(any_of(patterns))})"


def pages_sql(documents: str = "documents") -> str:
    return PAGES.replace("{body}", body_sql()).replace("{documents}", documents)


BOOKS_SQL = "SELECT book_id, string_agg('## 第 ' || CAST(page_number AS STRING) || ' 页' || chr(10) || chr(10) || " + strip_sql("translation") + ", chr(10) || chr(10) ORDER BY page_number) || chr(10) AS text FROM v_pages WHERE " + strip_sql("translation") + " <> '' GROUP BY book_id"
LINES_SQL = "SELECT book_id, CAST(unnest(range(len(parts))) AS INT) AS line_no, unnest(parts) AS line FROM (SELECT book_id, string_split(text, chr(10)) AS parts FROM v_book) b"
CHECKPOINTS = """
SELECT book_id, page_number, kind, embedded_text, ocr_text, translation, notes, 'page_' || lpad(CAST(page_number AS STRING), 4, '0') || '.json' AS file_name FROM v_pages WHERE page_number % 4 <> 0
UNION ALL SELECT book_id, page_number, kind, embedded_text, 'stale', '', '', 'page_' || lpad(CAST(page_number AS STRING), 4, '0') || '-.json' FROM v_pages WHERE page_number % 8 = 1
"""


#: Pages of which every fifth has no translation yet.
PARTLY = "SELECT * EXCLUDE (translation), CASE WHEN doc_id % 5 <> 0 THEN translation ELSE '  ' END AS translation FROM v_pages"


def with_views(sql: str) -> str:
    """DuckDB SQL with the views in front."""
    return f"WITH v_pages AS ({pages_sql()}), v_book AS ({BOOKS_SQL}), v_lines AS ({LINES_SQL}), v_ckpt AS ({CHECKPOINTS}), v_partly AS ({PARTLY}) {sql}"


def bound(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL over data frames named @name@; other braces are literal."""
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in frames:
        sql = sql.replace(f"@{name}@", f"{{{name}}}")
    return spark.sql(sql, **frames)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, pages_sql("@docs@"), docs=table(spark, sf_dir, "documents"))


def partly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, PARTLY.replace("EXCLUDE", "EXCEPT").replace("v_pages", "@p@"), p=pages(spark, sf_dir))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, CHECKPOINTS.replace("v_pages", "@p@"), p=pages(spark, sf_dir))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bookflow.operators.assembly import page_markdown

    return page_markdown(pages(spark, sf_dir), "translation").filter("text <> chr(10)")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bookflow.operators.lines import explode_lines

    return explode_lines(books(spark, sf_dir))
