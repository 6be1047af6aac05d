"""Command line: report (documents to translation and summary), typeset, repair, progress and monitor."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow import flows, rules
from bookflow.functions import text as T
from bookflow.operators import assembly, checkpoints, model_calls, rendering, transport
from bookflow.sources import scans, sinks, writers
from bookflow.streaming import panel, progress


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bookflow", description=__doc__)
    p.add_argument("--env-file", help="KEY=VALUE lines for settings that the environment lacks")
    p.add_argument("--core", default="fake", help="model provider, or fake for the deterministic stand-in")
    p.add_argument("--ocr-core", help="model provider that reads page images; the same one if it can, else the first that can")
    p.add_argument("--api-key")
    p.add_argument("--api-base")
    p.add_argument("--model")
    p.add_argument("--request-sleep", type=float, default=0.2, help="seconds to wait after each call")
    p.add_argument("--target", default=rules.TARGET, help="language of translations and summaries")
    sub = p.add_subparsers(dest="command", required=True)
    report = sub.add_parser("report", help="pages of documents to extracted text, translation and summary")
    report.add_argument("inputs", nargs="+")
    report.add_argument("--output", required=True)
    report.add_argument("--start-page", type=int, default=1)
    report.add_argument("--max-pages", type=int)
    report.add_argument("--skip-ocr", action="store_true", help="don't read page images; the embedded text is used")
    report.add_argument("--skip-translation", action="store_true")
    report.add_argument("--skip-summary", action="store_true")
    report.add_argument("--resume", action="store_true", help="take read and translated pages from the output's checkpoints")
    report.add_argument("--resume-from", help="the same from another output: a path, or a name beside the output")
    report.add_argument("--ocr-recover", action="store_true", help="read kept page images of pages that the checkpoints lack")
    report.add_argument("--keep-page-images", action="store_true", help="keep the images of pages below the output")
    report.add_argument("--vision-detail", choices=["low", "high", "xhigh"])
    for name, what in (("dpi", "dots an inch of rendered pages"), ("max-image-side", "longest side of an image in pixels"), ("jpeg-quality", "quality of page images")):
        report.add_argument(f"--{name}", type=int, help=what)
    for name in ("ocr", "translate", "summary"):
        report.add_argument(f"--{name}-max-tokens", type=int, help="output budget that replaces the provider's")
    report.add_argument("--translation-chunk-chars", type=int, default=0)
    report.add_argument("--summary-chunk-chars", type=int, default=0)
    for name in ("typeset", "repair"):
        one = sub.add_parser(name, help=f"{name} translated Markdown")
        one.add_argument("inputs", nargs="+")
        one.add_argument("--output", required=True)
    watch = sub.add_parser("progress", help="pages, translated pages and last page of each source")
    watch.add_argument("folder")
    live = sub.add_parser("monitor", help="a panel of a run, shown again and again until it is done or its process is gone")
    live.add_argument("folder")
    live.add_argument("--interval", type=int, default=120, help="seconds between two looks")
    live.add_argument("--total", type=int, default=rules.TOTAL_PAGES, help="pages of the source")
    live.add_argument("--process", default="bookflow", help="a word of the command line of the run's process")
    return p


def ocr_core(a: argparse.Namespace) -> str:
    """The provider that reads images."""
    if a.ocr_core or a.core == "fake" or transport.profile(a.core)["supports_image_input"]:
        return a.ocr_core or a.core
    return "mimo"


def client_of(a: argparse.Namespace, core: str | None = None) -> str:
    core = core or a.core
    if core != "fake":
        tokens = {"ocr": "ocr_max_tokens", "translate": "translate_max_tokens", "summarize": "summary_max_tokens", "reduce": "summary_max_tokens"}
        same = core == a.core  # overrides of key, address and model are of the text provider
        given = {"api_key": a.api_key, "base_url": a.api_base, "model": a.model} if same else {}
        model_calls.register_model_client(core, transport.http_client(core, a.target, tokens={k: getattr(a, n, None) for k, n in tokens.items()}, detail=getattr(a, "vision_detail", None), **given))
    return core


def run_info(a: argparse.Namespace) -> dict[str, object]:
    """What a run was made with; no keys."""
    p, o = transport.profile(None if a.core == "fake" else a.core), transport.profile(None if a.core == "fake" else ocr_core(a))
    return {
        "llm_core": a.core, "provider_model": a.model or p["default_model"], "provider_base_url": a.api_base or p["default_base_url"], "ocr_llm_core": ocr_core(a), "ocr_provider_model": o["default_model"],
        "context_window_tokens": p["context_window_tokens"], "thinking": p["thinking"] or "default", "reasoning_effort": p["reasoning_effort"], "ocr_max_tokens": a.ocr_max_tokens or o["default_ocr_max_tokens"],
        "translate_max_tokens": a.translate_max_tokens or p["default_translate_max_tokens"], "summary_max_tokens": a.summary_max_tokens or p["default_summary_max_tokens"],
        "translation_chunk_chars": a.translation_chunk_chars or p["default_translation_chunk_chars"], "summary_chunk_chars": a.summary_chunk_chars or p["default_summary_chunk_chars"],
        "vision_detail": a.vision_detail or o["default_vision_detail"], "target_language": a.target,
    }


def told(rows: DataFrame, what: str) -> int:
    """Prints up to 20 errors (source, error); how many there are."""
    bad = rows.filter("error IS NOT NULL")
    for r in bad.limit(20).collect():
        print(f"{what} {r[0]}: {r['error']}", file=sys.stderr)
    return bad.count()


def report(spark: SparkSession, a: argparse.Namespace) -> int:
    """Documents to extracted text, translation and summary; the number of pages and documents that failed."""
    p, pause = transport.profile(None if a.core == "fake" else a.core), 0.0 if a.core == "fake" else a.request_sleep
    documents = scans.read_documents(spark, a.inputs)
    scanned = scans.scan_pages(documents.filter("kind = 'pdf'"), start=a.start_page, most=a.max_pages)
    failed = told(scanned.select("source", "error"), "not readable:")
    images = scans.scan_images(documents).filter(F.lit(a.start_page <= 1)).select("source", "kind", "page_number", F.lit("").alias("embedded_text"))
    pages = flows.book_id(scanned.filter("error IS NULL").drop("error").union(images))
    client, state, saved = client_of(a), f"{a.output}/state", f"{a.output}/pages"
    keys = "book_id string, page_number int"
    former = a.output if a.resume or a.ocr_recover else None
    if a.resume_from:
        former = a.resume_from if "/" in a.resume_from else os.path.join(os.path.dirname(a.output.rstrip("/")), a.resume_from)

    def before(columns: str, order: str) -> DataFrame:
        """Page records of the former run, the fullest of each page."""
        rows = spark.read.schema(f"{keys}, {columns}").json(f"{former}/pages") if former else spark.createDataFrame([], f"{keys}, {columns}")
        return checkpoints.scan(rows.filter(~T.is_blank(F.coalesce(F.col(order), F.lit("")))), order)

    if a.skip_ocr:
        pages = pages.withColumn("ocr_text", F.lit("")).withColumn("notes", F.lit(""))
    else:
        if a.dpi or a.max_image_side is not None or a.jpeg_quality:
            side = rules.MAX_SIDE if a.max_image_side is None else a.max_image_side
            scans.register_renderer(".pdf", scans.pdf_renderer(a.dpi or rules.DPI, side, a.jpeg_quality or rules.JPEG_QUALITY))
        ids = ["book_id", "page_number"]
        drawn = scans.page_images(documents).filter("image IS NOT NULL").select("source", "page_number", "image")
        pages = pages.join(drawn, ["source", "page_number"], "left")
        if a.keep_page_images:
            writers.write_page_images(pages, f"{a.output}/page_images")
            pages = pages.drop("image").join(scans.cached_images(spark, f"{a.output}/page_images"), ids, "left")
        if a.ocr_recover:
            kept = scans.cached_images(spark, f"{former}/page_images")
            found = checkpoints.pending(kept, pages).select(F.col("book_id").alias("source"), F.lit("pdf_page").alias("kind"), "page_number", F.lit("").alias("embedded_text"), "book_id", "image")
            pages = pages.join(kept.withColumnRenamed("image", "kept"), ids, "left").withColumn("image", F.coalesce("image", "kept")).drop("kept").unionByName(found)
        read = flows.ocr_pages(pages, before("ocr_text string, notes string", "ocr_text"), state, client_of(a, ocr_core(a)), pause)
        read.drop("image").write.mode("overwrite").parquet(f"{state}/ocr")
        pages = spark.read.parquet(f"{state}/ocr")
        failed += told(pages.select("book_id", "error"), "page not read:")
        pages = pages.drop("error")
    if a.skip_translation:
        out = {"pages": pages.withColumn("translation", F.lit(""))}
        out["extracted"] = assembly.extracted(out["pages"])
    else:
        out = flows.translate_report(pages, before("translation string", "translation"), state, client, True, a.translation_chunk_chars or p["default_translation_chunk_chars"], a.summary_chunk_chars or p["default_summary_chunk_chars"], pause, not a.skip_summary)
        failed += told(out["pages"].select("book_id", "error"), "page not translated:")
    out["pages"].write.mode("overwrite").parquet(f"{state}/all")
    out["pages"] = spark.read.parquet(f"{state}/all")
    sinks.write_checkpoints(out["pages"].select("book_id", "page_number", "kind", "embedded_text", "ocr_text", "translation", "notes"), saved)
    for name in ("extracted", "translation"):
        if name in out:
            sinks.write_texts(out[name].select("book_id", "text"), f"{a.output}/{name}", a_folder_each=True)
    if "summary" in out:
        failed += told(out["summary"].select("book_id", "error"), "no summary:")
        sinks.write_texts(out["summary"].filter("summary IS NOT NULL").select("book_id", F.col("summary").alias("text")), f"{a.output}/summary", a_folder_each=True)
    write_reports(spark, a, out)
    return failed


def write_reports(spark: SparkSession, a: argparse.Namespace, out: dict[str, DataFrame]) -> None:
    """metadata.json, extracted_pages.json, summary.docx and summary.pdf of each book, in output/reports."""
    info = run_info(a)
    items = out["pages"].groupBy("book_id").agg(F.count("*").alias("items"), F.min("source").alias("input"))
    constant = [F.lit(v).alias(k) for k, v in info.items()]
    meta = items.select("book_id", F.struct("input", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"), *constant, "items").alias("m"))
    named = ["input", "generated_at", *info, "items"]
    lines = F.array_join(F.array(*(F.concat(F.lit(f"{k}: "), F.coalesce(F.col(f"m.{k}").cast("string"), F.lit("None"))) for k in named)), "\n")
    texts = meta.select("book_id", lines.alias("info"))
    for name, column in (("translation", "text"), ("summary", "summary"), ("extracted", "extracted")):
        one = out[name].select("book_id", F.col("summary" if name == "summary" else "text").alias(column)) if name in out else None
        texts = texts.withColumn(column, F.lit("")) if one is None else texts.join(one, "book_id", "left")
    fields = [f for f in sinks.PAGE_FIELDS if f in out["pages"].columns]
    named_files = [
        meta.select(F.concat("book_id", F.lit("/metadata.json")).alias("name"), F.to_json("m", {"ignoreNullFields": "false"}).cast("binary").alias("content")),
        sinks.pages_array(out["pages"], fields).select(F.concat("book_id", F.lit("/extracted_pages.json")).alias("name"), F.col("pages").cast("binary").alias("content")),
        writers.report_files(rendering.report_blocks(texts, "docx")).select(F.concat("book_id", F.lit("/summary.docx")).alias("name"), "content"),
        writers.pdf_files(rendering.report_blocks(texts, "pdf")).select(F.concat("book_id", F.lit("/summary.pdf")).alias("name"), "content"),
    ]
    for rows in named_files:
        writers.write_each(rows, f"{a.output}/reports")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code: 1 if something failed."""
    a = parser().parse_args(argv)
    if a.env_file:
        with open(a.env_file, encoding="utf-8") as f:
            transport.load_env(f.read(), os.environ)
    spark = spark or SparkSession.builder.appName("bookflow").getOrCreate()
    if a.command == "progress":
        progress.snapshot(scans.read_checkpoints(spark, a.folder)).orderBy("source").show(1000, False)
    elif a.command == "monitor":
        panel.watch(spark, a.folder, a.total, a.interval, a.process)
    elif a.command == "report":
        return int(report(spark, a) > 0)
    else:
        books = scans.read_markdown(spark, a.inputs).withColumn("book_id", T.slugify(F.regexp_extract("book_id", r"([^/\\]+?)(\.[^./\\]*)?$", 1)))
        if a.command == "repair":
            sinks.write_texts(flows.repair(books, client_of(a)).select("book_id", "text"), f"{a.output}/repaired", a_folder_each=True)
        else:
            made = flows.typeset(books)
            sinks.write_texts(made["latex"].select("book_id", F.col("latex").alias("text")), f"{a.output}/latex", a_folder_each=True)
            for name, blocks in (("word", made["final"]), ("formatted", made["formatted_parts"])):
                writers.final_files(blocks).write.mode("overwrite").parquet(f"{a.output}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
