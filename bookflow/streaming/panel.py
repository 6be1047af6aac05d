"""The live panel of a run: its process, its files, speed and time left, shown again until the run is over."""

from __future__ import annotations

import re
import subprocess
import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.streaming import progress

LISTING = "run_dir string, folder string, name string, mtime timestamp"
#: pid, seconds since its start, command line.
PROCESS = re.compile(r"^\s*(\d+)\s+(\d+)\s+(.*)$")


def process_listing() -> str:
    """Python processes as ps tells them; nothing where there is no ps."""
    try:
        return subprocess.run(["ps", "-eo", "pid=,etimes=,args="], capture_output=True, text=True, timeout=15, check=False).stdout
    except (OSError, subprocess.TimeoutExpired):
        return ""


def find_process(word: str, listing: str, now: datetime) -> dict | None:
    """(pid, command, start) of the first Python process whose command line holds the word; not a monitor's own."""
    for found in filter(None, map(PROCESS.match, listing.splitlines())):
        pid, seconds, command = found.groups()
        if re.search(r"python[\d.]*$", command.split(" ")[0]) and word in command and " monitor " not in f"{command} ":
            return {"pid": int(pid), "command": command, "start": now - timedelta(seconds=int(seconds))}
    return None


def flag(command: str, name: str, default: str) -> str:
    """The value of --name in a command line."""
    found = re.search(rf"--{name}[ =](\S+)", command)
    return found[1] if found else default


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(run_dir, folder, name, mtime) of the files of one run, names only; hidden folders are seen too."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    if fs.exists(at):
        files, root = fs.listFiles(at, True), fs.makeQualified(at).toString().rstrip("/")
        while files.hasNext():
            status = files.next()
            inner = status.getPath().toString()[len(root) + 1 :]
            rows.append((root, inner.rpartition("/")[0], inner.rpartition("/")[2], datetime.fromtimestamp(status.getModificationTime() / 1000)))
    return spark.createDataFrame(rows, LISTING)


def state(spark: SparkSession, folder: str) -> dict:
    """What a run's folder shows: number of images and checkpoints, phase, last image and checkpoint with their times."""
    files = listing(spark, folder)
    stats = progress.dir_stats(files).withColumn("phase", progress.phase(F.col("has_translation"), F.col("has_summary"), F.col("has_docx")))
    last = files.groupBy("run_dir").agg(F.max(F.when(F.col("folder") == "_page_images", F.col("mtime"))).alias("image_at"), F.max(F.when(F.col("folder") == "_checkpoints", F.col("mtime"))).alias("checkpoint_at"))
    row = stats.join(last, "run_dir").first()
    return row.asDict() if row else {"n_images": 0, "n_checkpoints": 0, "phase": "ocr", "last_image": None, "last_checkpoint": None, "image_at": None, "checkpoint_at": None}


def render(spark: SparkSession, seen: dict, process: dict | None, total: int, now: datetime) -> str:
    """The panel's text."""
    done = seen["n_checkpoints"] or seen["n_images"]
    seconds = (now - process["start"]).total_seconds() if process else 0.0
    figures = spark.createDataFrame([(done, total, seen["phase"], seconds)], "done int, total int, phase string, seconds double")
    lines = progress.dashboard_lines(*(F.col(c) for c in figures.columns))
    left = progress.minutes_left(F.col("phase"), F.col("done"), F.col("total"), F.col("seconds"))
    row = figures.select(lines.alias("lines"), left.alias("left")).first()
    head = ["=" * 60]
    if process:
        head += [f"  进程 PID:        {process['pid']}", f"  启动时间:        {process['start']:%Y-%m-%d %H:%M:%S}", f"  已运行:          {timedelta(seconds=int(seconds))}", f"  LLM 核心:        {flag(process['command'], 'core', 'fake')}"]
    else:
        head.append("  进程 PID:        -")
    foot = [f"  OCR 检查点:     {seen['n_checkpoints']}/{total} 页"] if seen["n_checkpoints"] else []
    for label, name, at in (("最新渲染", seen["last_image"], seen["image_at"]), ("最新检查点", seen["last_checkpoint"], seen["checkpoint_at"])):
        foot += [f"    {label}:      {name}  ({(now - at).total_seconds():.0f}秒前)"] if name else []
    foot.append(f"    预计完成:      {now + timedelta(minutes=row.left):%Y-%m-%d %H:%M:%S}")
    return "\n".join([*head, *row.lines, *foot, "=" * 60])


def watch(spark: SparkSession, folder: str, total: int, interval: int = 120, word: str = "bookflow", show: Callable[[str], None] = print, sleep: Callable[[float], None] = time.sleep, processes: Callable[[], str] = process_listing, now: Callable[[], datetime] = datetime.now) -> str:
    """Shows the panel every `interval` seconds; ends as done, or as gone when two looks in a row find no process."""
    before = gone = 0
    while True:
        process, seen = find_process(word, processes(), now()), state(spark, folder)
        show(render(spark, seen, process, total, now()))
        if seen["phase"] == "done":
            return "done"
        gone = 0 if process else gone + 1
        if gone == 2:
            return "gone"
        done = seen["n_checkpoints"] or seen["n_images"]
        if 0 < before < done:
            show(f"  最近 {interval}s 内完成 {done - before} 页 (瞬时速度: {round((done - before) / (interval / 60), 2)} 页/分)")
        before = done
        sleep(interval)
