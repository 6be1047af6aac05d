"""The command line, end to end on small files."""

from bookflow import __main__ as cli
from bookflow import rules
from bookflow.sources import scans


def test_repair_and_typeset(spark, tmp_path):
    title = rules.REPAIR_TITLES[0]
    (tmp_path / "my book.md").write_text(f"front\n{title}\nbro//\nken line\n\n12\nmore\n", encoding="utf-8")
    cli.main(["repair", str(tmp_path / "my book.md"), "--output", f"{tmp_path}/out"], spark)
    rows = [r.value for r in spark.read.text(f"{tmp_path}/out/repaired").collect()]
    assert rows[0] == f"## {title}" and "broken line" in rows
    cli.main(["typeset", str(tmp_path / "my book.md"), "--output", f"{tmp_path}/out"], spark)
    assert any(r.value.startswith("\\chapter*") for r in spark.read.text(f"{tmp_path}/out/latex").collect())
    assert bytes(spark.read.parquet(f"{tmp_path}/out/word").first().content)[:2] == b"PK"


def test_report_resumes(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(scans.DECODERS, ".pdf", lambda content: content.decode().split("\f"))
    (tmp_path / "a.pdf").write_bytes("first pagee\fsecond\fthird".encode())
    (tmp_path / "b.pdf").write_bytes(b"\xff\xfe")
    where = ["report", str(tmp_path / "a.pdf"), str(tmp_path / "b.pdf"), "--output", f"{tmp_path}/out"]
    assert cli.main([*where, "--max-pages", "2", "--skip-ocr"], spark) == 1  # b.pdf isn't readable
    first = spark.read.json(f"{tmp_path}/out/pages").filter("book_id = 'a'").collect()
    assert {r.page_number: r.translation for r in first} == {1: "first pagEE", 2: "sEcond"}
    cli.main([*where, "--resume", "--skip-ocr"], spark)
    again = [r.value for r in spark.read.text(f"{tmp_path}/out/translation").filter("book_id = 'a'").collect()]
    assert "first pagEE" in again and "third" in again and "## 第 3 页" in again


def test_arguments():
    a = cli.parser().parse_args(["--core", "mimo", "report", "x", "y", "--output", "o", "--start-page", "3"])
    assert a.inputs == ["x", "y"] and a.start_page == 3 and a.core == "mimo"


def test_report_reads_images(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(scans.DECODERS, ".pdf", lambda content: content.decode().split("|"))
    monkeypatch.setitem(scans.RENDERERS, ".pdf", lambda content: content.split(b"|"))
    (tmp_path / "a.pdf").write_bytes(b"one|two")
    (tmp_path / "c.png").write_bytes(b"image")
    assert cli.main(["report", str(tmp_path / "a.pdf"), str(tmp_path / "c.png"), "--output", f"{tmp_path}/out", "--skip-summary"], spark) == 0
    got = {(r.book_id, r.page_number): (r.ocr_text, r.translation, r.notes) for r in spark.read.json(f"{tmp_path}/out/pages").collect()}
    assert got == {("a", 1): ("One", "OnE", "3 bytes"), ("a", 2): ("twO", "twO", "3 bytes"), ("c", 1): ("", "", "5 bytes")}
    assert not (tmp_path / "out" / "summary").exists()


def test_reports_images_kept_and_recovered(spark, tmp_path, monkeypatch):
    import json
    import os

    monkeypatch.setitem(scans.DECODERS, ".pdf", lambda content: content.decode().split("|"))
    monkeypatch.setitem(scans.RENDERERS, ".pdf", lambda content: content.split(b"|"))
    (tmp_path / "a.pdf").write_bytes(b"one|two")
    first = f"{tmp_path}/first"
    assert cli.main(["report", str(tmp_path / "a.pdf"), "--output", first, "--keep-page-images", "--skip-translation", "--skip-summary"], spark) == 0
    assert open(f"{first}/page_images/a/page_0002.jpg", "rb").read() == b"two"
    meta = json.load(open(f"{first}/reports/a/metadata.json"))
    assert meta["items"] == 2 and meta["llm_core"] == "fake" and meta["target_language"] == rules.TARGET and "api_key" not in meta
    records = json.load(open(f"{first}/reports/a/extracted_pages.json"))
    assert [(r["page_number"], r["ocr_text"]) for r in records] == [(1, "One"), (2, "twO")]
    assert open(f"{first}/reports/a/summary.pdf", "rb").read(5) == b"%PDF-" and open(f"{first}/reports/a/summary.docx", "rb").read(2) == b"PK"
    with open(f"{first}/page_images/a/page_0007.jpg", "wb") as f:
        f.write(b"seven")  # an image of a page that no checkpoint has
    monkeypatch.setitem(scans.RENDERERS, ".pdf", lambda content: 1 / 0)
    second = f"{tmp_path}/second"
    assert cli.main(["report", str(tmp_path / "a.pdf"), "--output", second, "--resume-from", "first", "--ocr-recover", "--skip-summary"], spark) == 0
    got = {r.page_number: (r.ocr_text, r.translation, r.notes) for r in spark.read.json(f"{second}/pages").collect()}
    assert got == {1: ("One", "OnE", "3 bytes"), 2: ("twO", "twO", "3 bytes"), 7: ("", "", "5 bytes")}
    assert os.path.exists(f"{second}/reports/a/summary.pdf")


def test_provider_of_images_and_budgets():
    a = cli.parser().parse_args(["--core", "deepseek", "report", "x", "--output", "o", "--translate-max-tokens", "9", "--vision-detail", "low"])
    assert cli.ocr_core(a) == "mimo" and cli.run_info(a)["translate_max_tokens"] == 9 and cli.run_info(a)["vision_detail"] == "low"
    a = cli.parser().parse_args(["--core", "seed", "report", "x", "--output", "o"])
    assert cli.ocr_core(a) == "seed"
    assert scans.shrink(220 / 72, 600, 800, 0) == 220 / 72 and scans.shrink(10, 600, 800, 3200) == 4
