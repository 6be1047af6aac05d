"""The live panel: finding the process, reading a run's folder, and when watching ends."""

from datetime import datetime, timedelta

from bookflow.streaming import panel

NOW = datetime(2026, 1, 2, 3, 4, 5)
PS = "    1  900 /sbin/init\n   20  600 /usr/bin/python3.13 -m bookflow --core mimo report a.pdf --output o\n   21   5 vim bookflow.py\n   19  700 python -m bookflow monitor o\n"


def test_find_process():
    found = panel.find_process("bookflow", PS, NOW)
    assert found == {"pid": 20, "command": "/usr/bin/python3.13 -m bookflow --core mimo report a.pdf --output o", "start": NOW - timedelta(seconds=600)}
    assert panel.find_process("other", PS, NOW) is None and panel.find_process("bookflow", "", NOW) is None
    assert panel.flag(found["command"], "core", "x") == "mimo" and panel.flag("python x --core=seed", "core", "x") == "seed" and panel.flag("python x", "core", "x") == "x"
    assert isinstance(panel.process_listing(), str)


def run_folder(tmp_path, images, checkpoints):
    for name, n, suffix in (("_page_images", images, "jpg"), ("_checkpoints", checkpoints, "json")):
        (tmp_path / name).mkdir(exist_ok=True)
        for i in range(n):
            (tmp_path / name / f"page_{i + 1:04d}.{suffix}").write_text("{}")


def test_watch(spark, tmp_path):
    run_folder(tmp_path, 4, 2)
    shown, naps = [], []

    def sleep(seconds):
        naps.append(seconds)
        if len(naps) == 1:
            run_folder(tmp_path, 10, 8)
        else:
            for name in ("translation.md", "summary.md"):
                (tmp_path / name).write_text("x")

    how = {"show": shown.append, "sleep": sleep, "now": lambda: NOW}
    assert panel.watch(spark, str(tmp_path), 20, 60, processes=lambda: PS, **how) == "done"
    assert naps == [60, 60] and "已完成: 2/20 页" in shown[0] and "page_0004.jpg" in shown[0] and "进程 PID:        20" in shown[0] and "LLM 核心:        mimo" in shown[0]
    assert "已完成: 8/20 页" in shown[1] and "最近 60s 内完成 6 页 (瞬时速度: 6.0 页/分)" in shown[2] and "done" in shown[3]


def test_watch_ends_when_the_process_is_gone(spark, tmp_path):
    shown, naps = [], []
    assert panel.watch(spark, f"{tmp_path}/none", 20, 60, show=shown.append, sleep=naps.append, processes=lambda: "", now=lambda: NOW) == "gone"
    assert naps == [60] and len(shown) == 2 and "已完成: 0/20 页" in shown[0]
