"""Queries of scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.plans import fixtures as X
from bookflow.plans.fixtures import with_views
from bookflow.plans.registry import query
from bookflow.sources import scans, sinks

SUFFIX = "CASE page_id % 6 WHEN 0 THEN '.PDF' WHEN 1 THEN '.jpg' WHEN 2 THEN '.tiff' WHEN 3 THEN '.txt' WHEN 4 THEN '' ELSE '.webp' END"


@query("source_kind", "SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'image' WHEN 2 THEN 'image' WHEN 5 THEN 'image' END AS kind FROM pages")
def source_kind(spark, sf_dir):
    return X.table(spark, sf_dir, "pages").select("page_id", T.source_kind(F.expr(f"'/in/a.b/file' || CAST(page_id AS STRING) || {SUFFIX}")).alias("kind"))


PAGED = "SELECT page_id, CAST(unnest(range(1, len(ps) + 1)) AS INT) AS page_number, trim(unnest(ps)) AS embedded_text FROM (SELECT page_id, string_split(html, '<p>') AS ps FROM pages) a"


def paged(spark, sf_dir, start, most):
    scans.register_decoder(".html", lambda content: [x.strip(" ") for x in content.decode().split("<p>")])
    documents = X.table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("source"), F.col("html").cast("binary").alias("content"))
    return scans.scan_pages(documents, ".html", start, most).select(F.col("source").cast("long").alias("page_id"), "page_number", "embedded_text")


@query("scan_pages", PAGED)
def scan_pages(spark, sf_dir):
    return paged(spark, sf_dir, 1, None)


@query("scan_page_window", f"SELECT * FROM ({PAGED}) p WHERE page_number <= 5 AND page_number >= 2")
def scan_page_window(spark, sf_dir):
    """Pages 2 to 5 of each document: the window is the feature."""
    return paged(spark, sf_dir, 2, 4)


@query("scan_images", "SELECT page_id, 'image' AS kind, 1 AS page_number, 'image_0001.jpg' AS image_path FROM pages WHERE page_id % 6 IN (1, 2, 5)")
def scan_images(spark, sf_dir):
    files = X.table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("source"), T.source_kind(F.expr(f"'f' || {SUFFIX}")).alias("kind"))
    return scans.scan_images(files).select(F.col("source").cast("long").alias("page_id"), "kind", "page_number", "image_path")


#: Names as write_page_images makes them: at least four digits (lpad would cut longer numbers).
NAME = "CASE doc_id % 3 WHEN 0 THEN format_string('page_%04d.jpg', doc_id) WHEN 1 THEN 'page_' || CAST(doc_id AS STRING) || '.jpgx' ELSE 'image_0001.jpg' END"


@query("image_page_number", "SELECT doc_id, CAST(CASE WHEN doc_id % 3 < 2 THEN doc_id ELSE -1 END AS INT) AS page_number FROM documents")
def image_page_number(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", F.coalesce(scans.page_of_image(F.expr(NAME)), F.lit(-1)).alias("page_number"))


W, H = "CAST(event_id % 5000 + 1 AS INT)", "CAST(event_id * 7 % 9000 + 1 AS INT)"
S = f"least(1.0::DOUBLE, {rules.MAX_SIDE}::DOUBLE / greatest({W}, {H}))"


@query("image_scale", f"SELECT event_id, CASE WHEN s < 1 THEN greatest(1, CAST(trunc(w * s) AS INT)) ELSE w END AS width, CASE WHEN s < 1 THEN greatest(1, CAST(trunc(h * s) AS INT)) ELSE h END AS height FROM (SELECT event_id, {W} AS w, {H} AS h, {S} AS s FROM events) e")
def image_scale(spark, sf_dir):
    w, h = scans.scaled(F.expr(W), F.expr(H))
    return X.table(spark, sf_dir, "events").select("event_id", w.alias("width"), h.alias("height"))


@query("checkpoint_name", with_views("SELECT book_id, page_number, 'page_' || CASE WHEN page_number < 10000 THEN lpad(CAST(page_number AS STRING), 4, '0') ELSE CAST(page_number AS STRING) END || '.json' AS file_name FROM v_pages"))
def checkpoint_name(spark, sf_dir):
    return X.pages(spark, sf_dir).select("book_id", "page_number", sinks.checkpoint_name(F.col("page_number")).alias("file_name"))


RECORD = "'{\"book_id\":\"' || book_id || '\",\"page_number\":' || CAST(page_number AS STRING) || ',\"ocr_text\":' || to_json(ocr_text) || ',\"notes\":\"' || notes || '\"}'"
FIELDS = ["book_id", "page_number", "ocr_text", "notes"]


@query("page_to_json", with_views(f"SELECT book_id, page_number, {RECORD} AS record FROM v_pages"))
def page_to_json(spark, sf_dir):
    return X.pages(spark, sf_dir).select("book_id", "page_number", sinks.page_json(*FIELDS).alias("record"))


ARRAY = "'{\"page_number\":' || CAST(page_number AS STRING) || ',\"kind\":\"' || kind || '\",\"ocr_text\":' || to_json(ocr_text) || '}'"


@query("pages_json_array", with_views(f"SELECT book_id, '[' || string_agg({ARRAY}, ',' ORDER BY page_number) || ']' AS pages FROM v_pages GROUP BY book_id"))
def pages_json_array(spark, sf_dir):
    return sinks.pages_array(X.pages(spark, sf_dir), ["page_number", "kind", "ocr_text"])


META = "'{\"source\":\"' || book_id || '\",\"target_language\":\"" + rules.TARGET + f"\",\"dpi\":{rules.DPI},\"max_side\":{rules.MAX_SIDE},\"image_quality\":{rules.JPEG_QUALITY},\"items\":' || CAST(n AS STRING) || ',\"notes\":null}}'"


@query("run_metadata", with_views(f"SELECT book_id, {META} AS metadata FROM (SELECT book_id, count(*) AS n FROM v_pages GROUP BY book_id) c"))
def run_metadata(spark, sf_dir):
    counts = X.pages(spark, sf_dir).groupBy("book_id").agg(F.count("*").alias("n"))
    fields = F.struct(F.col("book_id").alias("source"), F.lit(rules.TARGET).alias("target_language"), F.lit(rules.DPI).alias("dpi"), F.lit(rules.MAX_SIDE).alias("max_side"), F.lit(rules.JPEG_QUALITY).alias("image_quality"), F.col("n").alias("items"), F.lit(None).cast("string").alias("notes"))
    return counts.select("book_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("metadata"))


@query("stamp_format", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events")
def stamp_format(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyyMMdd_HHmmss").alias("stamp"))
