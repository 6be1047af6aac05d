"""Queries of progress metrics. Runs are users of the events table; no clock is read."""

from __future__ import annotations


from pyspark.sql import functions as F

from bookflow import rules
from bookflow.operators import checkpoints as C
from bookflow.plans import fixtures as X
from bookflow.plans.fixtures import with_views
from bookflow.plans.registry import query
from bookflow.streaming import progress as P

NUMBER = "lpad(CAST(event_id % 10000 AS STRING), 4, '0')"
FILES = f"""SELECT CASE user_id % 5 WHEN 0 THEN 'run_' WHEN 1 THEN '_tmp/run_' WHEN 2 THEN 'group/run_' WHEN 3 THEN 'a/b/run_' ELSE 'doc_' END || CAST(user_id AS STRING) AS run_dir, 's' || CAST(user_id % 7 AS STRING) AS slug,
 CASE event_id % 4 WHEN 0 THEN '_page_images' WHEN 1 THEN '_checkpoints' WHEN 2 THEN '' ELSE 'other' END AS folder,
 CASE event_id % 4 WHEN 0 THEN CASE WHEN event_id % 8 = 0 THEN 'page_' || {NUMBER} || '.jpg' ELSE 'image_0001.jpg' END WHEN 1 THEN 'page_' || {NUMBER} || '.json' ELSE CASE WHEN user_id % 3 = 0 THEN 'translation.md' WHEN user_id % 4 = 0 THEN 'summary.md' WHEN user_id % 11 = 0 THEN 'summary.docx' ELSE 'x.md' END END AS name, ts AS mtime FROM @events@"""
STATS = """SELECT run_dir, @slug@ count(*) FILTER (folder = '_page_images' AND regexp_matches(name, '^page_.*\\.jpg$')) AS n_images, count(*) FILTER (folder = '_checkpoints') AS n_checkpoints, max(mtime) AS mtime,
 max(CASE WHEN folder = '_page_images' AND regexp_matches(name, '^page_.*\\.jpg$') THEN name END) AS last_image, max(CASE WHEN folder = '_checkpoints' THEN name END) AS last_checkpoint,
 bool_or(folder = '' AND name = 'translation.md') AS has_translation, bool_or(folder = '' AND name = 'summary.md') AS has_summary, bool_or(folder = '' AND name = 'summary.docx') AS has_docx FROM (""" + FILES.replace("@events@", "events") + ") f GROUP BY run_dir"
PLAIN = STATS.replace("@slug@", "")
SLUGGED = STATS.replace("@slug@", "min(slug) AS slug,")


def files(spark, sf_dir):
    return X.bound(spark, FILES, events=X.table(spark, sf_dir, "events"))


def runs(spark, sf_dir):
    slugs = files(spark, sf_dir).groupBy("run_dir").agg(F.min("slug").alias("slug"))
    return P.dir_stats(files(spark, sf_dir)).join(slugs, "run_dir")


@query("dir_stats", PLAIN)
def dir_stats(spark, sf_dir):
    return P.dir_stats(files(spark, sf_dir))


IS_CANDIDATE = "len(string_split(run_dir, '/')) <= 2 AND NOT starts_with(run_dir, '_') AND (n_images > 0 OR n_checkpoints > 0)"


@query("monitor_candidates", f"SELECT run_dir, n_images, n_checkpoints FROM ({PLAIN}) s WHERE {IS_CANDIDATE}")
def monitor_candidates(spark, sf_dir):
    return P.candidates(P.dir_stats(files(spark, sf_dir))).select("run_dir", "n_images", "n_checkpoints")


@query("resume_candidates", f"SELECT run_dir, slug, n_images, n_checkpoints FROM ({SLUGGED}) s WHERE len(string_split(run_dir, '/')) <= 2 AND starts_with(string_split(run_dir, '/')[-1], 'run_')")
def resume_candidates(spark, sf_dir):
    parts = F.split("run_dir", "/")
    return runs(spark, sf_dir).filter((F.size(parts) <= 2) & F.element_at(parts, -1).startswith("run_")).select("run_dir", "slug", "n_images", "n_checkpoints")


def top_sql(order: str) -> str:
    return f"SELECT slug, run_dir FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY {order}) AS nth FROM ({SLUGGED}) s) r WHERE nth = 1"


@query("resume_choice", top_sql("n_checkpoints DESC, n_images DESC, mtime DESC, run_dir DESC"))
def resume_choice(spark, sf_dir):
    return C.resume_choice(runs(spark, sf_dir)).select("slug", "run_dir")


@query("monitor_choice", top_sql("(has_translation AND has_summary), n_images + n_checkpoints DESC, mtime DESC, run_dir DESC"))
def monitor_choice(spark, sf_dir):
    return C.monitor_choice(runs(spark, sf_dir)).select("slug", "run_dir")


PHASE = "CASE WHEN has_docx OR has_summary THEN 'done' WHEN has_translation THEN 'summary' ELSE 'ocr' END"


@query("phase", f"SELECT run_dir, {PHASE} AS phase FROM ({PLAIN}) s")
def phase(spark, sf_dir):
    return P.dir_stats(files(spark, sf_dir)).select("run_dir", P.phase(F.col("has_translation"), F.col("has_summary"), F.col("has_docx")).alias("phase"))


TOTAL = rules.TOTAL_PAGES
DONE, SECONDS, PHASE_OF = f"CAST(event_id % {TOTAL + 1} AS INT)", "CAST(event_id % 7 * 1000 AS DOUBLE)", "CASE event_id % 5 WHEN 0 THEN 'ocr' WHEN 1 THEN 'translate' WHEN 2 THEN 'summary' WHEN 3 THEN 'ocr' ELSE 'done' END"
D = f"(SELECT event_id, {DONE} AS done, {SECONDS} AS seconds, {PHASE_OF} AS phase FROM events) e"
PCT = f"round_even(done / {TOTAL} * 100, 1)"
PPM = "CASE WHEN seconds > 0 AND done > 0 THEN round_even(done / (seconds / 60), 3) ELSE 0.0 END"
SPP = "CASE WHEN done > 0 THEN round_even(seconds / done, 1) ELSE 0.0 END"
LEFT = f"CASE phase WHEN 'ocr' THEN CASE WHEN ppm > 0 THEN round_even(({TOTAL} - done) / ppm, 1) ELSE 0.0 END + round_even({TOTAL} * {rules.TRANSLATE_MINUTES}::DOUBLE, 0) + {rules.SUMMARY_MINUTES} WHEN 'translate' THEN round_even(({TOTAL} - done) * {rules.TRANSLATE_MINUTES}::DOUBLE, 0) + {rules.SUMMARY_MINUTES} WHEN 'summary' THEN {rules.SUMMARY_MINUTES}.0 ELSE 0.0 END"


def states(spark, sf_dir):
    return X.table(spark, sf_dir, "events").selectExpr("event_id", "ts", "user_id", f"{DONE} AS done", f"{SECONDS} AS seconds", f"{PHASE_OF} AS phase")




@query("progress_bar", f"SELECT event_id, CAST({PCT} AS DOUBLE) AS pct, repeat('█', b) || repeat('░', {rules.BAR} - b) AS bar, {TOTAL} - done AS remaining FROM (SELECT *, CAST(trunc({PCT} / 100 * {rules.BAR}) AS INT) AS b FROM {D}) f")
def progress_bar(spark, sf_dir):
    done, total = F.col("done"), F.lit(TOTAL)
    return states(spark, sf_dir).select("event_id", P.percent(done, total).alias("pct"), P.progress_bar(done, total).alias("bar"), (total - done).alias("remaining"))


@query("speed", f"SELECT event_id, CAST({PPM} AS DOUBLE) AS pages_per_minute, CAST(CASE WHEN done > 0 THEN round_even(seconds / 60 / done, 2) ELSE 0.0 END AS DOUBLE) AS minutes_per_page, CAST({SPP} AS DOUBLE) AS seconds_per_page FROM {D}")
def speed(spark, sf_dir):
    done, seconds = F.col("done"), F.col("seconds")
    return states(spark, sf_dir).select("event_id", P.pages_per_minute(done, seconds).alias("pages_per_minute"), P.minutes_per_page(done, seconds).alias("minutes_per_page"), P.seconds_per_page(done, seconds).alias("seconds_per_page"))


@query("eta", f"SELECT event_id, CAST(round_even({LEFT}, 4) AS DOUBLE) AS minutes_left FROM (SELECT *, {PPM} AS ppm FROM {D}) f")
def eta(spark, sf_dir):
    s = states(spark, sf_dir)
    return s.select("event_id", F.bround(P.minutes_left(F.col("phase"), F.col("done"), F.lit(TOTAL), F.col("seconds")), 4).alias("minutes_left"))


@query("dashboard_lines", f"SELECT event_id, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS line_no, unnest(['  当前阶段:        ' || CASE phase WHEN 'ocr' THEN 'OCR 识别' WHEN 'translate' THEN '翻译' WHEN 'summary' THEN '总结' ELSE phase END, '  [' || repeat('█', b) || repeat('░', {rules.BAR} - b) || '] ' || format('{{:.1f}}', {PCT}) || '%', '  已完成: ' || CAST(done AS STRING) || '/{TOTAL} 页  |  剩余: ' || CAST({TOTAL} - done AS STRING) || ' 页', '    平均速度:      ' || format('{{:.3f}}', ppm::DOUBLE) || ' 页/分钟 (' || format('{{:.1f}}', ({SPP})::DOUBLE) || ' 秒/页)', '    总计剩余:      ' || format('{{:.0f}}', round_even({LEFT}, 0)::DOUBLE) || ' 分钟']) AS line FROM (SELECT *, CAST(trunc({PCT} / 100 * {rules.BAR}) AS INT) AS b, {PPM} AS ppm FROM {D}) f")
def dashboard_lines(spark, sf_dir):
    shown = P.dashboard_lines(F.col("done"), F.lit(TOTAL), F.col("phase"), F.col("seconds"))
    return states(spark, sf_dir).select("event_id", F.posexplode(shown).alias("p", "line")).select("event_id", (F.col("p") + 1).alias("line_no"), "line")


@query("recent_speed", f"SELECT event_id, CAST(coalesce(done - lag(done) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS INT) AS delta, CAST(round_even(coalesce(done - lag(done) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) / 2.0, 2) AS DOUBLE) AS recent_speed FROM (SELECT *, {DONE} AS done FROM events) e")
def recent_speed(spark, sf_dir):
    polls = states(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    return P.recent_speed(polls, "user_id", "at").select("event_id", "delta", "recent_speed")


@query("creation_date_parse", "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN date_trunc('second', ts) END AS started FROM events")
def creation_date_parse(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 != 0, F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit(".000000+480"))).otherwise("none")
    return X.table(spark, sf_dir, "events").select("event_id", P.creation_date(raw).alias("started"))


@query("progress_snapshot", with_views("SELECT book_id AS source, count(DISTINCT page_number) AS n_pages, CAST(count(DISTINCT CASE WHEN trim(translation) <> '' THEN page_number END) AS BIGINT) AS n_translated, CAST(max(page_number) AS INT) AS last_page FROM v_ckpt GROUP BY book_id"))
def progress_snapshot(spark, sf_dir):
    return P.snapshot(X.checkpoints(spark, sf_dir).withColumnRenamed("book_id", "source"))
