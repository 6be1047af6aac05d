"""Progress of runs: directory statistics, phase, speed, time left, the dashboard; as batch columns and as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bookflow import rules
from bookflow.operators.checkpoints import PAGE, tolerant


def dir_stats(files: DataFrame) -> DataFrame:
    """(run_dir, n_images, n_checkpoints, mtime, last_image, last_checkpoint, has_*) of a listing (run_dir, folder, name, mtime)."""
    image = (F.col("folder") == "_page_images") & F.col("name").rlike(r"^page_.*\.jpg$")
    point = (F.col("folder") == "_checkpoints") & F.col("name").rlike(r"^page_.*\.json$")
    has = lambda name: F.coalesce(F.max((F.col("folder") == "") & (F.col("name") == name)), F.lit(False))
    return files.groupBy("run_dir").agg(
        F.count_if(image).alias("n_images"), F.count_if(point).alias("n_checkpoints"), F.max("mtime").alias("mtime"), F.max(F.when(image, F.col("name"))).alias("last_image"), F.max(F.when(point, F.col("name"))).alias("last_checkpoint"),
        has("translation.md").alias("has_translation"), has("summary.md").alias("has_summary"), has("summary.docx").alias("has_docx"),
    )


def candidates(runs: DataFrame) -> DataFrame:
    """Runs that hold images or checkpoints and whose top folder doesn't start with _; depth 1 or 2."""
    parts = F.split("run_dir", "/")
    return runs.filter((F.size(parts) <= 2) & ~F.element_at(parts, 1).startswith("_") & ((F.col("n_images") > 0) | (F.col("n_checkpoints") > 0)))


def phase(has_translation: Column, has_summary: Column, has_docx: Column, known: Column | None = None) -> Column:
    out = F.when(has_docx | has_summary, "done").when(has_translation, "summary").otherwise("ocr")
    return out if known is None else F.when(known, out).otherwise("unknown")


def percent(done: Column, total: Column) -> Column:
    return F.when(total > 0, F.bround(done / total * 100, 1)).otherwise(0.0)


def progress_bar(done: Column, total: Column, width: int = rules.BAR) -> Column:
    filled = (percent(done, total) / 100 * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled))


def pages_per_minute(done: Column, seconds: Column) -> Column:
    return F.when((seconds > 0) & (done > 0), F.bround(done / (seconds / 60), 3)).otherwise(0.0)


def minutes_per_page(done: Column, seconds: Column) -> Column:
    return F.when(done > 0, F.bround(seconds / 60 / done, 2)).otherwise(0.0)


def seconds_per_page(done: Column, seconds: Column) -> Column:
    return F.when(done > 0, F.bround(seconds / done, 1)).otherwise(0.0)


def minutes_left(phase_: Column, done: Column, total: Column, seconds: Column) -> Column:
    speed, rest = pages_per_minute(done, seconds), total - done
    recognise = F.when(speed > 0, F.bround(rest / speed, 1)).otherwise(0.0)
    return (
        F.when(phase_ == "ocr", recognise + F.bround(total * rules.TRANSLATE_MINUTES, 0) + rules.SUMMARY_MINUTES)
        .when(phase_ == "translate", F.bround(rest * rules.TRANSLATE_MINUTES, 0) + rules.SUMMARY_MINUTES)
        .when(phase_ == "summary", F.lit(float(rules.SUMMARY_MINUTES)))
        .otherwise(0.0)
    )


def recent_speed(polls: DataFrame, key: str = "run_dir", at: str = "ts", done: str = "done", interval: int = 120) -> DataFrame:
    """Adds pages since the last poll and pages a minute over the poll's interval."""
    before = F.lag(done).over(Window.partitionBy(key).orderBy(at))
    delta = F.coalesce(F.col(done) - before, F.lit(0))
    return polls.withColumn("delta", delta).withColumn("recent_speed", F.bround(F.col("delta") / (interval / 60), 2))


def dashboard_lines(done: Column, total: Column, phase_: Column, seconds: Column) -> Column:
    """array<string>: the figures of the panel, a line each."""
    name = F.when(phase_ == "ocr", "OCR 识别").when(phase_ == "translate", "翻译").when(phase_ == "summary", "总结").otherwise(phase_)
    left = minutes_left(phase_, done, total, seconds)
    return F.array(
        F.format_string("  当前阶段:        %s", name), F.concat(F.lit("  ["), progress_bar(done, total), F.format_string("] %.1f%%", percent(done, total))), F.format_string("  已完成: %d/%d 页  |  剩余: %d 页", done, total, total - done),
        F.format_string("    平均速度:      %.3f 页/分钟 (%.1f 秒/页)", pages_per_minute(done, seconds), seconds_per_page(done, seconds)), F.format_string("    总计剩余:      %.0f 分钟", F.bround(left, 0)),
    )


def creation_date(text: Column) -> Column:
    """Start of a process from yyyyMMddHHmmss with whatever follows; null if it doesn't fit."""
    return F.to_timestamp_ntz(F.when(text.rlike("^[0-9]{14}"), F.substring(text, 1, 14)), F.lit("yyyyMMddHHmmss"))


def snapshot(records: DataFrame) -> DataFrame:
    """(source, n_pages, n_translated, last_page): progress of each source from its page records, latest per page counted once."""
    done = records.groupBy("source", "page_number").agg(F.max((F.trim("translation") != "").cast("int")).alias("t"))
    return done.groupBy("source").agg(F.count("*").alias("n_pages"), F.sum("t").alias("n_translated"), F.max("page_number").alias("last_page"))


def watch(spark: SparkSession, folder: str, sink: Callable[[DataFrame, int], None], state: str, **trigger) -> StreamingQuery:
    """Watches a folder of page records (one JSON object a file) and gives the sink, after each batch, the latest record of each page so far.

    New files of a batch are merged by key into the table at `state`/pages; a batch that runs again merges the same rows.
    """
    stream = spark.readStream.schema(PAGE).option("multiLine", True).json(folder)

    def merge(batch: DataFrame, number: int) -> None:
        own = f"{state}/pages/batch={number}"
        tolerant(batch).dropDuplicates(["source", "page_number"]).write.mode("overwrite").parquet(own)
        everything = spark.read.parquet(f"{state}/pages")
        latest = everything.groupBy("source", "page_number").agg(F.max_by(F.struct(*[c for c in everything.columns if c not in ("source", "page_number", "batch")]), "batch").alias("r"))
        sink(latest.select("source", "page_number", "r.*"), number)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{state}/offsets").trigger(**(trigger or {"availableNow": True})).start()
