"""Queries of ordered operators: cleaning, paragraphs, sections, chunks and rendering."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators import assembly, chunking, lines as L, rendering, sections as S
from bookflow.plans import fixtures as X
from bookflow.plans.fixtures import matches_sql, quoted, strip_sql, with_views
from bookflow.plans.registry import query
from bookflow.plans.text_queries import BARE, DOCX, EXTRACTED, PDF, level_sql, nested
from bookflow.sources import writers

UPTO = "OVER (PARTITION BY book_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
MARKER = matches_sql("line", [rules.PAGE_MARKER])
OPENS = f"CASE WHEN {MARKER} THEN CAST(regexp_extract(line, '^## 第 ([0-9]+) 页', 1) AS INT) >= {rules.FIRST_KEPT_PAGE} ELSE false END"
STARTS = matches_sql(BARE, rules.COPYRIGHT_STARTS)
EVENT = f"CASE WHEN {OPENS} THEN false WHEN {STARTS} THEN true WHEN {matches_sql(BARE, [rules.COPYRIGHT_END])} THEN false END"
CLEAN = f"""
SELECT book_id, line_no, line FROM (
 SELECT *, coalesce(last_value(event IGNORE NULLS) {UPTO}, false) AS inside, max(opens) {UPTO} AS begun FROM (SELECT book_id, line_no, line, {MARKER} AS marker, {STARTS} AS starts, CAST({OPENS} AS INT) AS opens, {EVENT} AS event FROM v_lines) a) b
WHERE begun = 1 AND NOT marker AND NOT starts AND NOT inside AND NOT {matches_sql(BARE, rules.PAGE_NUMBERS)} AND NOT {matches_sql(BARE, rules.NOISE)}"""


@query("clean_content", with_views(CLEAN))
def clean_content(spark, sf_dir):
    return L.clean_content(X.lines(spark, sf_dir))


PARAS = f"SELECT book_id, CAST(row_number() OVER (PARTITION BY book_id ORDER BY island) AS INT) AS para_no, string_agg(bare, ' ' ORDER BY line_no) AS paragraph FROM (SELECT *, sum(CAST(bare = '' AS INT)) {UPTO} AS island FROM (SELECT book_id, line_no, {BARE} AS bare FROM v_lines) a) b WHERE bare <> '' GROUP BY book_id, island"


@query("text_to_paragraphs", with_views(PARAS))
def text_to_paragraphs(spark, sf_dir):
    return L.text_to_paragraphs(X.lines(spark, sf_dir))


MERGED = f"""
SELECT book_id, CAST(row_number() OVER (PARTITION BY book_id ORDER BY pos) AS INT) AS para_no, content, CAST(level AS INT) AS level FROM (
 SELECT book_id, line_no AS pos, bare AS content, level FROM (SELECT *, row_number() OVER (PARTITION BY book_id, bare ORDER BY line_no) AS nth FROM marked WHERE level IS NOT NULL) t WHERE nth = 1
 UNION ALL SELECT book_id, min(line_no), string_agg(bare, chr(10) ORDER BY line_no), 0 FROM marked WHERE bare <> '' AND level IS NULL GROUP BY book_id, island) u"""
MARKED = f", marked AS (SELECT *, sum(CAST(bare = '' OR level IS NOT NULL AS INT)) {UPTO} AS island FROM (SELECT book_id, line_no, {BARE} AS bare, {level_sql(BARE)} AS level FROM v_lines) a) "


def with_marked(sql: str) -> str:
    return with_views(sql).replace(f") {sql}", f"){MARKED}{sql}")


@query("merge_paragraphs", with_marked(MERGED))
def merge_paragraphs(spark, sf_dir):
    return L.merge_paragraphs(X.lines(spark, sf_dir))


@query("title_level_counts", with_marked(f"SELECT book_id, count(*) AS n_paragraphs, count(*) FILTER (level > 0) AS n_titles, count(*) FILTER (level = 1) AS n_level1, count(*) FILTER (level = 2) AS n_level2, count(*) FILTER (level = 3) AS n_level3 FROM ({MERGED}) m GROUP BY book_id"))
def title_level_counts(spark, sf_dir):
    merged = L.merge_paragraphs(X.lines(spark, sf_dir))
    return merged.groupBy("book_id").agg(F.count("*").alias("n_paragraphs"), F.count_if(F.col("level") > 0).alias("n_titles"), *(F.count_if(F.col("level") == k).alias(f"n_level{k}") for k in (1, 2, 3)))


REGION = f"SELECT book_id, arg_min(last_start, line_no) AS toc_start, min(line_no) + {rules.CONTENTS_TAIL} AS toc_end FROM (SELECT book_id, line_no, {matches_sql(BARE, [rules.CONTENTS_END])} AS e, last_value(CASE WHEN {matches_sql(BARE, [rules.CONTENTS_START])} THEN line_no END IGNORE NULLS) {UPTO} AS last_start FROM v_lines) a WHERE e AND last_start > 0 GROUP BY book_id"
OFFSETS = "SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY book_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS line_offset FROM v_lines"
IN_TITLES = f"({', '.join(quoted(t) for t in rules.REPAIR_TITLES)})"
POSITIONS = f"SELECT book_id, CAST(row_number() OVER (PARTITION BY book_id ORDER BY line_offset) AS INT) AS section_no, title, line_offset FROM (SELECT o.book_id, {BARE} AS title, min(line_offset) AS line_offset FROM ({OFFSETS}) o LEFT JOIN ({REGION}) r ON o.book_id = r.book_id WHERE {BARE} IN {IN_TITLES} AND (toc_start IS NULL OR line_no < toc_start OR line_no > toc_end) GROUP BY o.book_id, {BARE}) f"
EXTENTS = f"""
SELECT p.book_id, section_no, title, {strip_sql('substring(text, line_offset + 1, coalesce(stop - line_offset, length(text)))')} AS content FROM (SELECT *, lead(line_offset) OVER (PARTITION BY book_id ORDER BY line_offset) AS stop FROM ({POSITIONS}) q) p JOIN v_book b ON p.book_id = b.book_id
UNION ALL SELECT p.book_id, 0, {quoted(rules.PREAMBLE)}, {strip_sql('substring(text, 1, line_offset)')} FROM ({POSITIONS}) p JOIN v_book b ON p.book_id = b.book_id WHERE section_no = 1 AND {strip_sql('substring(text, 1, line_offset)')} <> ''"""


@query("toc_region", with_views(f"SELECT book_id, toc_start, CAST(toc_end AS INT) AS toc_end FROM ({REGION}) r"))
def toc_region(spark, sf_dir):
    return S.toc_region(X.lines(spark, sf_dir))


@query("section_positions", with_views(POSITIONS))
def section_positions(spark, sf_dir):
    return S.section_positions(X.lines(spark, sf_dir))


@query("section_extents", with_views(EXTENTS))
def section_extents(spark, sf_dir):
    return S.section_extents(X.books(spark, sf_dir), X.lines(spark, sf_dir))


@query("section_sizes", with_views(f"SELECT book_id, section_no, title, CAST(length(content) AS INT) AS n_chars FROM ({EXTENTS}) e"))
def section_sizes(spark, sf_dir):
    return section_extents(spark, sf_dir).select("book_id", "section_no", "title", F.length("content").alias("n_chars"))


SPLIT = f"""
SELECT book_id, CAST(section_no AS INT) AS section_no, name AS title, string_agg(line, chr(10) ORDER BY line_no) AS content FROM (
 SELECT *, count(title) {UPTO} AS section_no, coalesce(last_value(title IGNORE NULLS) {UPTO}, {quoted(rules.PREAMBLE)}) AS name FROM (SELECT book_id, line_no, line, CASE WHEN {BARE} IN {IN_TITLES} THEN {BARE} END AS title FROM v_lines) a) b
WHERE title IS NULL GROUP BY book_id, section_no, name"""


@query("section_split_lines", with_views(SPLIT))
def section_split_lines(spark, sf_dir):
    return S.section_split_lines(X.lines(spark, sf_dir))


def fold_sql(keys: str, source: str, units: str, most: int, strict: bool) -> str:
    """Recursive greedy packing over (keys, k, text, solo); strict: a unit's solo flag and separators count."""
    size = "length(u.text) + 2" if strict else "length(u.text)"
    use = f"CASE WHEN u.solo THEN {most} ELSE {size} END" if strict else size
    over = f"(u.solo OR f.used + {size} > {most})" if strict else f"f.used + {size} > {most}"
    on = " AND ".join(f"u.{c.strip()} = f.{c.strip()}" for c in keys.split(","))
    own = ", ".join(f"u.{c.strip()}" for c in keys.split(","))
    return f"""WITH RECURSIVE {source}, units AS ({units}), f AS (
 SELECT {keys}, k, 1 AS chunk_no, {use} AS used FROM units u WHERE k = 1
 UNION ALL SELECT {own}, u.k, CASE WHEN {over} THEN f.chunk_no + 1 ELSE f.chunk_no END, CASE WHEN {over} THEN {use} ELSE f.used + {use} END FROM f JOIN units u ON {on} AND u.k = f.k + 1)
SELECT {', '.join(f'f.{c.strip()}' for c in keys.split(','))}, CAST(chunk_no AS INT) AS chunk_no, string_agg(u.text, chr(10) || chr(10) ORDER BY u.k) AS chunk FROM f JOIN units u ON {on} AND u.k = f.k GROUP BY {', '.join(f'f.{c.strip()}' for c in keys.split(','))}, chunk_no"""


SPACED = "replace(coalesce(text, ''), chr(10), chr(10) || chr(10))"
SPLIT_MOST = 1000
TEXT_UNITS = f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p, s) AS k, text, solo FROM (
 SELECT doc_id, p, i AS s, CASE WHEN length(para) > {SPLIT_MOST} THEN substring(para, CAST(i AS INT) + 1, {SPLIT_MOST}) ELSE para END AS text, length(para) > {SPLIT_MOST} AS solo FROM (
  SELECT doc_id, p, para, unnest(CASE WHEN length(para) > {SPLIT_MOST} THEN range(0, length(para), {SPLIT_MOST}) ELSE [0] END) AS i FROM (
   SELECT doc_id, unnest(range(len(ps))) AS p, {strip_sql('unnest(ps)')} AS para FROM (SELECT doc_id, regexp_split_to_array({strip_sql(SPACED)}, '\\n{{2,}}') AS ps FROM documents) a) b WHERE para <> '') c) d"""


@query("split_text", fold_sql("doc_id", "x AS (SELECT 1)", TEXT_UNITS, SPLIT_MOST, True))
def split_text(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").select("doc_id", F.expr(SPACED).alias("text"))
    return docs.select("doc_id", F.posexplode(chunking.split_text(F.col("text"), SPLIT_MOST)).alias("p", "chunk")).select("doc_id", (F.col("p") + 1).alias("chunk_no"), "chunk")


CHUNK_UNITS = f"SELECT doc_id, unnest(range(1, len(ps) + 1)) AS k, unnest(ps) AS text, false AS solo FROM (SELECT doc_id, string_split({SPACED}, chr(10) || chr(10)) AS ps FROM documents) a"


@query("chunk_text", fold_sql("doc_id", "x AS (SELECT 1)", CHUNK_UNITS, 2000, False))
def chunk_text(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").select("doc_id", F.expr(SPACED).alias("text"))
    return docs.select("doc_id", F.posexplode(chunking.chunk_text(F.col("text"), 2000)).alias("p", "chunk")).select("doc_id", (F.col("p") + 1).alias("chunk_no"), "chunk")


CHUNKS = fold_sql("doc_id", "x AS (SELECT 1)", TEXT_UNITS, SPLIT_MOST, True)


@query("chunk_label", f"SELECT doc_id, chunk_no, '第 ' || CAST(doc_id AS STRING) || ' 页' || CASE WHEN n > 1 THEN '，分段 ' || CAST(chunk_no AS STRING) || '/' || CAST(n AS STRING) ELSE '' END AS label FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM ({CHUNKS}) c) d")
def chunk_label(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").select("doc_id", chunking.split_text(F.expr(SPACED), SPLIT_MOST).alias("cs"))
    each = docs.select("doc_id", F.size("cs").alias("n"), F.posexplode("cs").alias("p", "chunk"))
    part = F.when(F.col("n") > 1, F.format_string("，分段 %d/%d", F.col("p") + 1, F.col("n"))).otherwise("")
    return each.select("doc_id", (F.col("p") + 1).alias("chunk_no"), F.concat(F.format_string("第 %d 页", F.col("doc_id")), part).alias("label"))


# Rendering.
SECTION_LINES = f"SELECT book_id, section_no, title, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (SELECT *, string_split(content, chr(10)) AS ls FROM ({EXTENTS}) e) s"
UPTO_SECTION = UPTO.replace("PARTITION BY book_id", "PARTITION BY book_id, section_no")
SECTION_PARAS = f"SELECT book_id, section_no, title, CAST(row_number() OVER (PARTITION BY book_id, section_no ORDER BY island) AS INT) AS para_no, string_agg(bare, ' ' ORDER BY line_no) AS paragraph FROM (SELECT *, sum(CAST(bare = '' AS INT)) {UPTO_SECTION} AS island FROM (SELECT *, {BARE} AS bare FROM ({SECTION_LINES}) l WHERE NOT {matches_sql(BARE, rules.SECTION_NOISE)}) a) b WHERE bare <> '' GROUP BY book_id, section_no, title, island"
HEAD = f"CASE WHEN title = '序 文' THEN '\\chapter*{{序 文}}' || chr(10) || '\\addcontentsline{{toc}}{{chapter}}{{序 文}}' || chr(10) WHEN title IN ({', '.join(map(quoted, rules.STARRED))}) THEN '\\chapter*{{' || {nested('title', T.LATEX)} || '}}' || chr(10) || '\\addcontentsline{{toc}}{{chapter}}{{' || {nested('title', T.LATEX)} || '}}' || chr(10) ELSE '\\section{{' || {nested('title', T.LATEX)} || '}}' || chr(10) END"
LATEX = f"""
SELECT h.book_id, string_agg(head || coalesce(chr(10) || body, ''), chr(10) ORDER BY h.section_no) AS latex FROM (SELECT book_id, section_no, {HEAD} AS head FROM ({EXTENTS}) e WHERE title <> {quoted(rules.PREAMBLE)}) h
LEFT JOIN (SELECT book_id, section_no, string_agg(CASE WHEN {matches_sql('paragraph', [rules.FOOTNOTE])} THEN '\\noindent ' ELSE '' END || {nested('paragraph', T.LATEX)} || chr(10), chr(10) ORDER BY para_no) AS body FROM ({SECTION_PARAS}) p GROUP BY book_id, section_no) b ON h.book_id = b.book_id AND h.section_no = b.section_no GROUP BY h.book_id"""


@query("latex_body", with_views(LATEX))
def latex_body(spark, sf_dir):
    return rendering.latex_body(section_extents(spark, sf_dir))


TOC_VALUES = ", ".join(f"({i + 1}, {quoted(t)}, {quoted(p) if p else 'NULL'}, {len(k)})" for i, (t, p, k) in enumerate(rules.CONTENTS))


@query("toc_page_blocks", f"SELECT toc_no, CASE WHEN parent IS NOT NULL THEN 'child' WHEN title IN ('Ⅰ', 'Ⅱ') THEN 'part' ELSE 'top' END AS kind, title, CASE WHEN parent IS NOT NULL THEN 11 WHEN title IN ('Ⅰ', 'Ⅱ') THEN 14 ELSE 12 END AS points FROM (VALUES {TOC_VALUES}) t(toc_no, title, parent, n)")
def toc_page_blocks(spark, sf_dir):
    return rendering.toc_page_blocks(S.contents(spark))


@query(
    "formatted_blocks",
    with_marked(f"SELECT book_id, para_no, CASE level WHEN 0 THEN CASE WHEN {matches_sql('content', [rules.FOOTNOTE])} THEN 'footnote' ELSE 'body' END ELSE 'heading' || CAST(level AS STRING) END AS style, CAST(len(string_split(content, chr(10))) AS INT) AS n_lines, content FROM ({MERGED}) m"),
)
def formatted_blocks(spark, sf_dir):
    return rendering.formatted_blocks(L.merge_paragraphs(X.lines(spark, sf_dir)))


def front_sql() -> str:
    """Cover and contents page of the final Word file, as VALUES."""
    rows = [(0, i, "cover", False, True, points, text) for i, (text, points) in enumerate(rules.COVER)] + [(1, 0, "heading1", True, True, 16, rules.CONTENTS_HEAD)]
    for i, (title, parent, _) in enumerate(rules.CONTENTS, 1):
        style, points = ("child", 11) if parent else ("part", 14) if title in ("Ⅰ", "Ⅱ") else ("top", 12)
        rows.append((1, i, style, False, False, points, title))
    return ", ".join(f"({a}, {b}, {quoted(c)}, {d}, {e}, {f}, {quoted(g)})" for a, b, c, d, e, f, g in rows)


ALONE = f"title IN ('Ⅰ', 'Ⅱ', {', '.join(map(quoted, rules.STARRED))})"
FIRST = f"({ALONE} OR title = '序 文')"
NOTED = matches_sql("paragraph", [rules.FOOTNOTE])
FINAL = f"""
SELECT b.book_id, part_no, section_no, 0 AS para_no, style, page_before, centred, points, text FROM (SELECT DISTINCT book_id FROM ({EXTENTS}) e) b CROSS JOIN (VALUES {front_sql()}) v(part_no, section_no, style, page_before, centred, points, text)
UNION ALL SELECT book_id, 2, CAST(section_no AS INT), 0, CASE WHEN {FIRST} THEN 'heading1' ELSE 'heading2' END, {ALONE}, {FIRST}, CASE WHEN {FIRST} THEN 16 ELSE 14 END, title FROM ({EXTENTS}) e WHERE title <> {quoted(rules.PREAMBLE)}
UNION ALL SELECT book_id, 2, CAST(section_no AS INT), para_no, CASE WHEN {NOTED} THEN 'footnote' ELSE 'indented' END, false, false, CASE WHEN {NOTED} THEN 9 ELSE 11 END, paragraph FROM ({SECTION_PARAS}) p WHERE title <> {quoted(rules.PREAMBLE)}"""


@query("final_blocks", with_views(FINAL))
def final_blocks(spark, sf_dir):
    return rendering.final_blocks(section_extents(spark, sf_dir))


@query("final_files")
def final_files(spark, sf_dir):
    """Word files of all books: (book_id, n_bytes)."""
    return writers.final_files(final_blocks(spark, sf_dir)).select("book_id", F.length("content").alias("n_bytes"))


FORMATTED = f"""
SELECT DISTINCT book_id, 0 AS part_no, 0 AS section_no, p AS para_no, CASE p WHEN 0 THEN 'title' ELSE 'cover' END AS style, false AS page_before, true AS centred, CASE p WHEN 0 THEN 28 ELSE 11 END AS points, CASE p WHEN 0 THEN {quoted(rules.COVER[0][0])} ELSE {quoted(rules.COVER_LINE)} END AS text FROM ({MERGED}) m, (VALUES (0), (1)) v(p)
UNION ALL SELECT book_id, 1, 0, CAST(para_no AS INT), CASE WHEN level > 0 THEN 'heading' || CAST(level AS STRING) ELSE 'body' END, level = 1, level = 1, CAST(CASE WHEN level > 0 THEN 18 - 2 * level ELSE 11 END AS INT), content FROM ({MERGED}) m"""


@query("formatted_parts", with_marked(FORMATTED))
def formatted_parts(spark, sf_dir):
    return rendering.formatted_parts(L.merge_paragraphs(X.lines(spark, sf_dir)))


#: The report of a book: its id, a summary (none for texts of even length), the translation and the extracted text.
REPORTED = f"SELECT b.book_id, 'book: ' || b.book_id AS info, CASE WHEN length(b.text) % 2 = 1 THEN substring(b.text, 1, 80) ELSE ' ' END AS summary, b.text, x.text AS extracted FROM v_book b JOIN ({EXTRACTED}) x ON b.book_id = x.book_id"
NONE = {"info": "", "summary": rules.NO_SUMMARY, "text": rules.NO_TRANSLATION, "extracted": rules.NO_EXTRACT}
PARTS = " UNION ALL ".join(f"SELECT book_id, {i} AS part_no, {quoted(rules.REPORT_PARTS[i])} AS head, CASE WHEN {strip_sql(name)} = '' THEN {quoted(none)} ELSE {name} END AS text FROM ({REPORTED}) r{i}" for i, (name, none) in enumerate(NONE.items()))
PART_LINES = "SELECT book_id, part_no, head, CAST(unnest(range(len(ls))) AS INT) AS line_no, unnest(ls) AS line FROM (SELECT *, CASE WHEN ls0[-1] = '' THEN ls0[:-2] ELSE ls0 END AS ls FROM (SELECT *, string_split(text, chr(10)) AS ls0 FROM (" + PARTS + ") p) q) r"


def reported(spark, sf_dir):
    """(book_id, info, summary, text, extracted) of all books."""
    text, summary = F.col("text"), F.when(F.length("text") % 2 == 1, F.substring("text", 1, 80)).otherwise(" ")
    extracted = assembly.extracted(X.pages(spark, sf_dir)).select("book_id", F.col("text").alias("extracted"))
    return X.books(spark, sf_dir).select("book_id", F.concat(F.lit("book: "), "book_id").alias("info"), summary.alias("summary"), text).join(extracted, "book_id")


@query("docx_blocks", with_views(DOCX.replace("SELECT book_id, line_no, kind", "SELECT book_id, part_no, head, line_no, kind").replace("SELECT book_id, line_no, ", "SELECT book_id, part_no, head, line_no, ").replace("FROM v_lines", f"FROM ({PART_LINES}) v")))
def docx_blocks(spark, sf_dir):
    return rendering.report_blocks(reported(spark, sf_dir), "docx")


@query("pdf_blocks", with_views(f"SELECT * REPLACE (CASE WHEN part_no = 0 THEN 'meta' ELSE kind END AS kind) FROM ({PDF.replace('book_id, line_no', 'book_id, part_no, head, line_no').replace('FROM v_lines', f'FROM ({PART_LINES}) v')}) k"))
def pdf_blocks(spark, sf_dir):
    return rendering.report_blocks(reported(spark, sf_dir), "pdf")


@query("report_files")
def report_files(spark, sf_dir):
    """Word and PDF reports of all books: (book_id, suffix, n_bytes)."""
    texts = reported(spark, sf_dir)
    word, pdf = writers.report_files(rendering.report_blocks(texts, "docx")), writers.pdf_files(rendering.report_blocks(texts, "pdf"))
    return word.select("book_id", F.lit(".docx").alias("suffix"), F.length("content").alias("n_bytes")).union(pdf.select("book_id", F.lit(".pdf"), F.length("content")))
