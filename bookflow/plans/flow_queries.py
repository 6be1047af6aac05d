"""Queries of checkpoints and model stages (with the deterministic stand-in for models)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators import assembly, checkpoints as C, model_calls as M, sections as S
from bookflow.plans import fixtures as X
from bookflow.plans.fixtures import matches_sql, quoted, strip_sql, with_views
from bookflow.plans.registry import query
from bookflow.plans.section_queries import SPLIT, fold_sql
from bookflow.plans.text_queries import NOTE, SOURCE_TEXT, markdown_sql

LATEST = "SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY book_id, page_number ORDER BY file_name DESC) AS nth FROM v_ckpt) c WHERE nth = 1"
VALUES = ["ocr_text", "translation", "notes"]


@query("checkpoint_scan", with_views(f"SELECT book_id, page_number, file_name, ocr_text FROM ({LATEST}) l"))
def checkpoint_scan(spark, sf_dir):
    return C.scan(X.checkpoints(spark, sf_dir)).select("book_id", "page_number", "file_name", "ocr_text")


@query("pending_pages", with_views("SELECT book_id, page_number FROM v_pages p WHERE NOT EXISTS (SELECT 1 FROM v_ckpt c WHERE c.book_id = p.book_id AND c.page_number = p.page_number)"))
def pending_pages(spark, sf_dir):
    return C.pending(X.pages(spark, sf_dir), X.checkpoints(spark, sf_dir)).select("book_id", "page_number")


@query("reused_pages", with_views("SELECT book_id, page_number FROM v_pages p WHERE EXISTS (SELECT 1 FROM v_ckpt c WHERE c.book_id = p.book_id AND c.page_number = p.page_number)"))
def reused_pages(spark, sf_dir):
    return C.reused(X.pages(spark, sf_dir), X.checkpoints(spark, sf_dir)).select("book_id", "page_number")


NEW = "SELECT book_id, page_number, 'new ' || ocr_text AS ocr_text, '' AS translation, notes FROM v_pages WHERE page_number % 3 = 0"


@query("checkpoint_merge", with_views(f"SELECT coalesce(n.book_id, o.book_id) AS book_id, coalesce(n.page_number, o.page_number) AS page_number, {', '.join(f'CASE WHEN n.book_id IS NOT NULL THEN n.{v} ELSE o.{v} END AS {v}' for v in VALUES)} FROM ({NEW}) n FULL JOIN ({LATEST}) o ON n.book_id = o.book_id AND n.page_number = o.page_number"))
def checkpoint_merge(spark, sf_dir):
    new = X.bound(spark, NEW.replace("v_pages", "@p@"), p=X.pages(spark, sf_dir))
    return C.merge(new, C.scan(X.checkpoints(spark, sf_dir)), VALUES)


@query("resume_point", with_views("SELECT book_id, CAST(max(page_number) + 1 AS INT) AS resume_page FROM v_ckpt GROUP BY book_id"))
def resume_point(spark, sf_dir):
    return C.resume_point(X.checkpoints(spark, sf_dir))


@query("page_range", with_views("SELECT book_id, page_number FROM v_pages WHERE page_number >= 3"))
def page_range(spark, sf_dir):
    return C.page_range(X.pages(spark, sf_dir), 3).select("book_id", "page_number")


@query("page_window", with_views("SELECT p.book_id, p.page_number FROM v_pages p LEFT JOIN (SELECT book_id, max(page_number) + 1 AS r FROM v_ckpt GROUP BY book_id) c ON p.book_id = c.book_id WHERE page_number >= coalesce(r, 1) AND page_number < coalesce(r, 1) + 25"))
def page_window(spark, sf_dir):
    """The 25 pages after the last checkpoint: the window is the feature."""
    return C.page_range(X.pages(spark, sf_dir), 1, 25, C.resume_point(X.checkpoints(spark, sf_dir))).select("book_id", "page_number")


@query("pending_translation", with_views(f"SELECT book_id, page_number FROM v_partly WHERE {strip_sql('translation')} = ''"))
def pending_translation(spark, sf_dir):
    return X.partly(spark, sf_dir).filter(C.needs_translation()).select("book_id", "page_number")


IMAGES = "SELECT book_id, 'page_' || lpad(CAST(page_number AS STRING), 4, '0') || '.jpg' AS image_name FROM v_pages WHERE page_number % 5 <> 0 UNION ALL SELECT book_id, 'image_0001.jpg' FROM v_pages WHERE page_number = 1"
IMAGE_NO = "CAST(nullif(regexp_extract(image_name, '^page_([0-9]+)\\.jpg', 1), '') AS INT)"


@query("recoverable_pages", with_views(f"SELECT book_id, n AS page_number FROM (SELECT book_id, {IMAGE_NO} AS n FROM ({IMAGES}) i) j WHERE n IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v_ckpt c WHERE c.book_id = j.book_id AND c.page_number = j.n)"))
def recoverable_pages(spark, sf_dir):
    images = X.bound(spark, IMAGES.replace("v_pages", "@p@"), p=X.pages(spark, sf_dir))
    number = F.regexp_extract("image_name", r"^page_([0-9]+)\.jpg", 1)
    return C.pending(images.filter(number != "").select("book_id", number.try_cast("int").alias("page_number")), X.checkpoints(spark, sf_dir))


# Model stages.
MOST = 2000
PAGE_UNITS = f"""
SELECT book_id, page_number, row_number() OVER (PARTITION BY book_id, page_number ORDER BY p, s) AS k, text, solo FROM (
 SELECT book_id, page_number, p, i AS s, CASE WHEN length(para) > {MOST} THEN substring(para, CAST(i AS INT) + 1, {MOST}) ELSE para END AS text, length(para) > {MOST} AS solo FROM (
  SELECT book_id, page_number, p, para, unnest(CASE WHEN length(para) > {MOST} THEN range(0, length(para), {MOST}) ELSE [0] END) AS i FROM (
   SELECT book_id, page_number, unnest(range(len(ps))) AS p, {strip_sql('unnest(ps)')} AS para FROM (SELECT book_id, page_number, regexp_split_to_array({SOURCE_TEXT}, '\\n{{2,}}') AS ps FROM v_pages) a) b WHERE para <> '') c) d"""
VIEWS = with_views("").strip().removeprefix("WITH ").rstrip()
PAGE_CHUNKS = fold_sql("book_id, page_number", VIEWS, PAGE_UNITS, MOST, True)


@query("translate_join", f"SELECT p.book_id, p.page_number, {strip_sql('coalesce(t.translation, chr(32))')} AS translation FROM ({with_views('SELECT book_id, page_number FROM v_pages')}) p LEFT JOIN (SELECT book_id, page_number, string_agg(replace(chunk, 'e', 'E'), chr(10) || chr(10) ORDER BY chunk_no) AS translation FROM ({PAGE_CHUNKS}) c GROUP BY book_id, page_number) t ON p.book_id = t.book_id AND p.page_number = t.page_number")
def translate_join(spark, sf_dir):
    return M.translate(X.pages(spark, sf_dir), MOST).drop("error")


@query("ocr_pages", with_views(f"SELECT book_id, page_number, {strip_sql('replace(embedded_text, chr(111), chr(79))')} AS ocr_text, CAST(strlen(embedded_text) AS STRING) || ' bytes' AS notes FROM v_pages"))
def ocr_pages(spark, sf_dir):
    pages = X.pages(spark, sf_dir).withColumn("image", F.col("embedded_text").cast("binary"))
    return M.ocr(pages).select("book_id", "page_number", "ocr_text", "notes")


SUMMARY_MOST = 3000
BOOK_UNITS = PAGE_UNITS.replace("book_id, page_number", "book_id").replace(SOURCE_TEXT, strip_sql("text")).replace("v_pages", "v_book").replace(str(MOST), str(SUMMARY_MOST))
BOOK_CHUNKS = fold_sql("book_id", VIEWS, BOOK_UNITS, SUMMARY_MOST, True)
SUMMARIES = f"SELECT book_id, string_agg('## 分块 ' || CAST(chunk_no AS STRING) || chr(10) || substring(chunk, 1, 80), chr(10) || chr(10) ORDER BY chunk_no) AS summaries FROM ({BOOK_CHUNKS}) c GROUP BY book_id"


@query("summary_join", SUMMARIES)
def summary_join(spark, sf_dir):
    return M.chunk_summaries(X.books(spark, sf_dir), SUMMARY_MOST).drop("error")


@query("two_level_summary", f"SELECT book_id, substring(summaries, 1, 80) AS summary FROM ({SUMMARIES}) s")
def two_level_summary(spark, sf_dir):
    return M.two_level_summary(X.books(spark, sf_dir), SUMMARY_MOST).drop("error")


REPAIR_UNITS = f"SELECT book_id, section_no, unnest(range(1, len(ps) + 1)) AS k, unnest(ps) AS text, false AS solo FROM (SELECT book_id, section_no, string_split(content, chr(10) || chr(10)) AS ps FROM ({SPLIT}) s WHERE {strip_sql('content')} <> '') a"
REPAIR_CHUNKS = fold_sql("book_id, section_no", VIEWS, REPAIR_UNITS, 8000, False)
SPLIT_ALL = with_views(SPLIT)
REPAIRED = f"SELECT s.book_id, s.section_no, s.title, coalesce(r.content, s.content) AS content FROM ({SPLIT_ALL}) s LEFT JOIN (SELECT book_id, section_no, string_agg(replace(chunk, '//' || chr(10), ''), chr(10) || chr(10) ORDER BY chunk_no) AS content FROM ({REPAIR_CHUNKS}) c GROUP BY book_id, section_no) r ON s.book_id = r.book_id AND s.section_no = r.section_no"


def repaired(spark, sf_dir):
    return M.repair(S.section_split_lines(X.lines(spark, sf_dir))).drop("error")


@query("repair_join", REPAIRED)
def repair_join(spark, sf_dir):
    return repaired(spark, sf_dir)


REASSEMBLED = f"SELECT book_id, string_agg('## ' || title || chr(10) || chr(10) || content, chr(10) || chr(10) || chr(10) ORDER BY section_no) AS text FROM ({REPAIRED}) r WHERE title <> {quoted(rules.PREAMBLE)} GROUP BY book_id"


@query("reassemble_sections", REASSEMBLED)
def reassemble_sections(spark, sf_dir):
    return assembly.reassemble(repaired(spark, sf_dir))


def broken_sql(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {quoted('(?m)' + T.portable(rules.BROKEN_LINE))})) AS BIGINT)"


@query("repair_stats", f"SELECT b.book_id, {broken_sql('b.text')} AS n_before, {broken_sql('r.text')} AS n_after FROM ({with_views('SELECT * FROM v_book')}) b JOIN ({REASSEMBLED}) r ON b.book_id = r.book_id")
def repair_stats(spark, sf_dir):
    after = assembly.reassemble(repaired(spark, sf_dir)).select("book_id", T.broken_lines(F.col("text")).cast("long").alias("n_after"))
    return X.books(spark, sf_dir).select("book_id", T.broken_lines(F.col("text")).cast("long").alias("n_before")).join(after, "book_id")


@query("retry_schedule", "SELECT event_id, array_to_string([CAST(i * 2 AS STRING) for i in range(1, least(event_id % 5, 2) + 1)], ',') AS waits, event_id % 5 >= 3 AS failed FROM events")
def retry_schedule(spark, sf_dir):
    failures = (F.col("event_id") % 5).cast("int")
    waits = F.transform(M.retry_waits(F.lit(3), failures, 2.0), lambda w: w.cast("int").cast("string"))
    return X.table(spark, sf_dir, "events").select("event_id", F.array_join(waits, ",").alias("waits"), (failures >= 3).alias("failed"))


def refusing(kind: str, text: str) -> str:
    """A stand-in that fails on chunks whose length is divisible by nine."""
    if len(text) % 9 == 0:
        raise M.AuthenticationError("401")
    return text


FAILED = f"SELECT DISTINCT book_id, page_number FROM ({PAGE_CHUNKS}) c WHERE length(chunk) % 9 = 0"


@query("failures", f"SELECT p.book_id, count(*) AS n_pages, count(f.page_number) AS n_failed, CAST(CASE WHEN count(f.page_number) > 0 THEN 1 ELSE 0 END AS INT) AS exit_code FROM ({with_views('SELECT book_id, page_number FROM v_pages')}) p LEFT JOIN ({FAILED}) f ON p.book_id = f.book_id AND p.page_number = f.page_number GROUP BY p.book_id")
def failures(spark, sf_dir):
    return M.failures(M.translate(X.pages(spark, sf_dir), MOST, client=lambda: refusing))
