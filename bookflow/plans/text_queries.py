"""Queries of scalar functions and line tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators import assembly, lines as L
from bookflow.plans import fixtures as X
from bookflow.plans.fixtures import matches_sql, quoted, rstrip_sql, strip_sql, with_views
from bookflow.plans.registry import query

SOURCE_TEXT = strip_sql("CASE WHEN ocr_text <> '' THEN ocr_text ELSE embedded_text END")
NOTE = "CASE WHEN notes <> '' THEN chr(10) || chr(10) || '> OCR 备注：' || notes ELSE '' END"


def markdown_sql(value: str, note: str = "''", keep: str = "book_id", extra: str = "") -> str:
    part = f"CASE WHEN {strip_sql(value)} <> '' THEN '## 第 ' || CAST(page_number AS STRING) || ' 页' || chr(10) || chr(10) || {strip_sql(value)} || {note} END"
    return f"SELECT {keep}{extra}, {strip_sql(f'coalesce(string_agg({part}, chr(10) || chr(10) ORDER BY page_number), {quoted('')})')} || chr(10) AS text FROM v_pages GROUP BY {keep}"


@query("source_text", with_views(f"SELECT book_id, page_number, {SOURCE_TEXT} AS source_text FROM v_pages"))
def source_text(spark, sf_dir):
    return X.pages(spark, sf_dir).select("book_id", "page_number", T.source_text(F.col("ocr_text"), F.col("embedded_text")).alias("source_text"))


@query("page_markdown", with_views(markdown_sql("ocr_text", NOTE)))
def page_markdown(spark, sf_dir):
    return assembly.page_markdown(X.pages(spark, sf_dir), "ocr_text")


@query("text_totals", with_views("SELECT book_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, CAST(sum(length(line) + 1) - 1 AS BIGINT) AS n_text FROM v_lines GROUP BY book_id"))
def text_totals(spark, sf_dir):
    return X.lines(spark, sf_dir).groupBy("book_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), (F.sum(F.length("line") + 1) - 1).alias("n_text"))


RECOGNISED = f"SELECT *, max({strip_sql('ocr_text')} <> '') OVER (PARTITION BY book_id) AS recognised FROM v_pages"


EXTRACTED = (
    "SELECT book_id, CASE WHEN recognised THEN 'ocr_text' ELSE 'embedded_text' END AS field, text FROM ("
    + markdown_sql("CASE WHEN recognised THEN ocr_text ELSE embedded_text END", f"CASE WHEN recognised THEN {NOTE} ELSE '' END", "book_id, recognised").replace("FROM v_pages", f"FROM ({RECOGNISED}) r")
    + ") m"
)


@query("extracted_fallback", with_views(EXTRACTED))
def extracted_fallback(spark, sf_dir):
    return assembly.extracted(X.pages(spark, sf_dir))


@query(
    "summary_source",
    with_views(f"SELECT a.book_id, CASE WHEN {strip_sql('a.text')} <> '' THEN 'translation' ELSE 'ocr_text' END AS field, CASE WHEN {strip_sql('a.text')} <> '' THEN a.text ELSE b.text END AS text FROM ({markdown_sql('translation')}) a JOIN ({markdown_sql('ocr_text', NOTE)}) b ON a.book_id = b.book_id"),
)
def summary_source(spark, sf_dir):
    return assembly.summary_source(X.pages(spark, sf_dir))


@query("line_explode", with_views("SELECT * FROM v_lines"))
def line_explode(spark, sf_dir):
    return X.lines(spark, sf_dir)


@query("scan_lines", with_views("SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS line_no, unnest(parts) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d"))
def scan_lines(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))


MIXED = "replace(replace(replace(html, '</p>', chr(13) || chr(10)), '<li>', chr(8232)), '</li>', chr(12))"
SPLIT = rf"regexp_split_to_array(h, '{T.LINE_END}')"


@query("splitlines", f"SELECT page_id, CAST(unnest(range(len(ls))) AS INT) AS line_no, unnest(ls) AS line FROM (SELECT page_id, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM (SELECT page_id, {SPLIT} AS ls FROM (SELECT page_id, {MIXED} AS h FROM pages) a) b) c")
def splitlines(spark, sf_dir):
    html = F.expr(MIXED.replace("chr(8232)", "decode(unhex('E280A8'), 'UTF-8')"))
    return X.table(spark, sf_dir, "pages").select("page_id", F.posexplode(T.splitlines(html)).alias("line_no", "line"))


@query("line_offsets", with_views("SELECT book_id, line_no, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY book_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS line_offset FROM v_lines"))
def line_offsets(spark, sf_dir):
    return L.with_offsets(X.lines(spark, sf_dir)).select("book_id", "line_no", "line_offset")


def removals_sql(x: str) -> str:
    for p in rules.MARKER_REMOVALS:
        x = f"regexp_replace({x}, {quoted('(?m)' + T.portable(p))}, '', 'g')"
    return x


@query("strip_page_markers", with_views(f"SELECT book_id, {removals_sql('text')} AS text FROM v_book"))
def strip_page_markers(spark, sf_dir):
    return X.books(spark, sf_dir).select("book_id", T.strip_page_markers(F.col("text")).alias("text"))


def flag(name: str, column, sql: str):
    @query(name, with_views(f"SELECT book_id, line_no, {sql} AS flag FROM v_lines"))
    def run(spark, sf_dir):
        return X.lines(spark, sf_dir).select("book_id", "line_no", column(F.col("line")).alias("flag"))


BARE = strip_sql("line")
flag("is_page_marker", T.is_page_marker, matches_sql("line", [rules.PAGE_MARKER]))
flag("is_page_number", T.is_page_number, matches_sql(BARE, rules.PAGE_NUMBERS))
flag("is_noise_line", T.is_noise, matches_sql(BARE, rules.NOISE))
flag("is_footnote", T.is_footnote, matches_sql(BARE, [rules.FOOTNOTE]))


def level_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {matches_sql(x, rules.TITLES[k])} THEN {k}" for k in sorted(rules.TITLES)) + " END"


@query("detect_title", with_views(f"SELECT book_id, line_no, CAST(coalesce({level_sql(BARE)}, 0) AS INT) AS level FROM v_lines"))
def detect_title(spark, sf_dir):
    return X.lines(spark, sf_dir).select("book_id", "line_no", F.coalesce(T.title_level(F.col("line")), F.lit(0)).alias("level"))  # 0: no title


@query("clean_text", with_views(f"SELECT book_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM v_lines WHERE NOT {matches_sql(BARE, rules.SECTION_NOISE)} GROUP BY book_id"))
def clean_text(spark, sf_dir):
    return L.clean_sections(X.lines(spark, sf_dir)).groupBy("book_id").agg(L.joined("line_no", "line", "\n").alias("text"))


BROKEN = f"CAST(len(regexp_extract_all(text, {quoted('(?m)' + T.portable(rules.BROKEN_LINE))})) AS BIGINT)"


@query("broken_line_count", with_views(f"SELECT book_id, {BROKEN} AS n_broken FROM v_book"))
def broken_line_count(spark, sf_dir):
    return X.books(spark, sf_dir).select("book_id", T.broken_lines(F.col("text")).cast("long").alias("n_broken"))


def nested(x: str, pairs) -> str:
    for old, new in pairs:
        x = f"replace({x}, {quoted(old)}, {quoted(new)})"
    return x


@query("escape_latex", with_views(f"SELECT book_id, line_no, {nested('line', T.LATEX)} AS latex FROM v_lines"))
def escape_latex(spark, sf_dir):
    return X.lines(spark, sf_dir).select("book_id", "line_no", T.escape_latex(F.col("line")).alias("latex"))


@query("html_escape", f"SELECT page_id, {nested('html', T.HTML)} AS escaped FROM pages")
def html_escape(spark, sf_dir):
    return X.table(spark, sf_dir, "pages").select("page_id", T.html_escape(F.col("html")).alias("escaped"))


SAFE = r"""regexp_replace(trim(regexp_replace(x, '[<>:"/\\|?*\x00-\x1F]', '_', 'g'), ' ._'), '_+', '_', 'g')"""


@query("slugify", f"SELECT page_id, trim(CASE WHEN s = '' THEN 'document' ELSE substring(s, 1, 80) END, ' ._') AS slug FROM (SELECT page_id, {SAFE} AS s FROM (SELECT page_id, url || CASE WHEN page_id % 5 = 0 THEN ' ._' || repeat('/x:', 40) ELSE '' END AS x FROM pages) a) b")
def slugify(spark, sf_dir):
    x = F.expr("url || CASE WHEN page_id % 5 = 0 THEN ' ._' || repeat('/x:', 40) ELSE '' END")
    return X.table(spark, sf_dir, "pages").select("page_id", T.slugify(x).alias("slug"))


KEPT = strip_sql("coalesce(text, '')")


@query("truncate_reference", f"SELECT doc_id, CASE WHEN length({KEPT}) > {rules.REFERENCE_CHARS} THEN substring({KEPT}, 1, {rules.REFERENCE_CHARS}) || chr(10) || {quoted(rules.CUT_REFERENCE.strip())} ELSE {KEPT} END AS reference FROM documents")
def truncate_reference(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", T.truncate_reference(F.coalesce("text", F.lit(""))).alias("reference"))


@query("data_url", "SELECT page_id, 'data:' || CASE WHEN page_id % 2 = 0 THEN 'image/png' ELSE 'image/jpeg' END || ';base64,' || base64(encode(coalesce(html, ''))) AS data_url FROM pages")
def data_url(spark, sf_dir):
    suffix = F.expr("CASE WHEN page_id % 2 = 0 THEN '.PNG' ELSE '.jpg' END")
    return X.table(spark, sf_dir, "pages").select("page_id", T.data_url(F.coalesce("html", F.lit("")).cast("binary"), suffix).alias("data_url"))


@query("size_format", "SELECT doc_id, CASE WHEN n >= 1048576 THEN format('{:.1f} MB', n / 1048576.0) ELSE format('{:.1f} KB', n / 1024.0) END AS size FROM (SELECT doc_id, n_chars * 1024 AS n FROM documents) d")
def size_format(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", T.size_format(F.col("n_chars") * 1024).alias("size"))


@query("hard_slice", "SELECT doc_id, CAST(i / 1800 + 1 AS INT) AS piece_no, substring(text, CAST(i AS INT) + 1, 1800) AS piece FROM (SELECT doc_id, text, unnest(range(0, length(text), 1800)) AS i FROM documents) d")
def hard_slice(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.hard_slices(F.col("text"), 1800)).alias("p", "piece")).select("doc_id", (F.col("p") + 1).alias("piece_no"), "piece")


X_ = rstrip_sql("line")
BULLET, NUMBER = quoted(T.portable(r"^\s*[-*]\s+")), quoted(T.portable(r"^\s*\d+[.、]\s+"))
KIND = f"CASE WHEN x = '' THEN 'empty' WHEN starts_with(x, '# ') OR starts_with(x, '## ') OR starts_with(x, '### ') THEN 'heading' WHEN regexp_matches(x, {BULLET}) THEN 'bullet' WHEN regexp_matches(x, {NUMBER}) THEN 'number' ELSE 'paragraph' END"
LEVEL = "CASE WHEN starts_with(x, '# ') THEN 1 WHEN starts_with(x, '## ') THEN 2 WHEN starts_with(x, '### ') THEN 3 ELSE 0 END"
DOCX = f"SELECT book_id, line_no, kind, CAST(level AS INT) AS level, CASE WHEN level > 0 THEN {strip_sql('substring(x, level + 2)')} WHEN kind = 'bullet' THEN regexp_replace(x, {BULLET}, '') ELSE x END AS text FROM (SELECT *, {KIND} AS kind, {LEVEL} AS level FROM (SELECT book_id, line_no, {X_} AS x FROM v_lines) a) b"


@query("markdown_blocks_docx", with_views(DOCX))
def markdown_blocks_docx(spark, sf_dir):
    return X.lines(spark, sf_dir).select("book_id", "line_no", T.block_docx(F.col("line")).alias("b")).select("book_id", "line_no", "b.*")


E_ = nested("x", T.HTML)
PDF = f"""
SELECT book_id, line_no, CAST(unnest(range(len(bs))) AS INT) AS block_no, unnest(bs).kind AS kind, unnest(bs).text AS text FROM (
 SELECT book_id, line_no, CASE WHEN x = '' THEN [{{'kind': 'space', 'text': ''}}]
  WHEN starts_with(x, '# ') THEN [{{'kind': 'h1', 'text': {strip_sql('substring(e, 3)')}}}] WHEN starts_with(x, '## ') THEN [{{'kind': 'h2', 'text': {strip_sql('substring(e, 4)')}}}]
  WHEN starts_with(x, '### ') THEN [{{'kind': 'h2', 'text': {strip_sql('substring(e, 5)')}}}]
  ELSE [{{'kind': 'body', 'text': substring(e, CAST(i AS INT) + 1, 1800)}} for i in range(0, length(e), 1800)] END AS bs
 FROM (SELECT *, {E_} AS e FROM (SELECT book_id, line_no, {X_} AS x FROM v_lines) a) b) c"""


@query("markdown_blocks_pdf", with_views(PDF))
def markdown_blocks_pdf(spark, sf_dir):
    return X.lines(spark, sf_dir).select("book_id", "line_no", F.posexplode(T.blocks_pdf(F.col("line"))).alias("block_no", "b")).select("book_id", "line_no", "block_no", "b.kind", "b.text")
