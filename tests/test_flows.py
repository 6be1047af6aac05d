"""Model stages, sources, sinks, streaming and the entry point."""

import io
import json
import os
import subprocess
import sys
import xml.dom.minidom
import zipfile

from pyspark.sql import functions as F

from bookflow import flows
from bookflow.operators import checkpoints, model_calls as M, rendering
from bookflow.plans import fixtures as X
from bookflow.sources import scans, sinks
from bookflow.streaming import progress as P

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_errors_stay_with_their_row_and_blank_texts_are_not_sent(spark):
    def client(kind, text):
        if text == "bad":
            raise M.AuthenticationError("401")
        assert text.strip()
        return text.upper()

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, " "), (4, None)], "i int, t string")
    got = {r.i: (r.out, r.error) for r in M.map_texts(df, "translate", "t", "out", lambda: client, parallel=2).collect()}
    assert got[1] == ("A", None) and got[2][0] is None and "401" in got[2][1] and got[3] == (" ", None) and got[4] == (None, None)


def test_translation_keeps_every_page(spark):
    rows = [("b", 1, "", "eee"), ("b", 2, "", ""), ("b", 3, "x\n\ne", "no")]
    df = spark.createDataFrame(rows, "book_id string, page_number int, ocr_text string, embedded_text string")
    assert {r.page_number: r.translation for r in M.translate(df, 1000).collect()} == {1: "EEE", 2: "", 3: "x\n\nE"}


def refusing(word):
    def client(kind, text):
        if word in text:
            raise M.AuthenticationError("401")
        return text.upper()

    return lambda: client


def test_a_failed_chunk_fails_its_page_summary_and_section(spark):
    long = "good one\n\n" + "x" * 1000 + "\n\nbad two\n\n" + "y" * 1000
    pages = spark.createDataFrame([("b", 1, "", long), ("b", 2, "", "fine"), ("c", 1, "", "fine")], "book_id string, page_number int, ocr_text string, embedded_text string")
    done = M.translate(pages, 1000, client=refusing("bad"))
    got = {(r.book_id, r.page_number): (r.translation, r.error) for r in done.collect()}
    assert got["b", 1][0] == "" and "401" in got["b", 1][1] and got["b", 2] == ("FINE", None)
    assert {tuple(r) for r in M.failures(done).collect()} == {("b", 2, 1, 1), ("c", 1, 0, 0)}
    assert {r.page_number for r in done.filter("book_id = 'b'").filter(checkpoints.needs_translation()).collect()} == {1}
    texts = spark.createDataFrame([("b", long), ("c", "fine")], "book_id string, text string")
    assert {r.book_id: (r.summary, r.error is None) for r in M.two_level_summary(texts, 1000, client=refusing("bad")).collect()} == {"b": (None, False), "c": ("## 分块 1\nFINE".upper(), True)}
    sections = spark.createDataFrame([("b", 1, "t", long), ("b", 2, "u", "fine"), ("b", 3, "v", " ")], "book_id string, section_no int, title string, content string")
    assert {r.section_no: (r.content, r.error is None) for r in M.repair(sections, 1000, client=refusing("bad")).collect()} == {1: (long, False), 2: ("FINE", True), 3: (" ", True)}


def test_a_killed_run_goes_on_where_it_was(spark, tmp_path):
    """The stand-in leaves a mark for each call and dies at the fourth page; the next run asks for the others only."""
    calls, journal = tmp_path / "calls", f"{tmp_path}/journal"
    calls.mkdir()

    def factory(deadly):
        def client(kind, text, image=None):
            (calls / f"{text}-{os.urandom(4).hex()}").touch()
            if deadly and text == "t3":
                raise KeyboardInterrupt
            return json.dumps({"text": text + "!", "notes": f"{len(image)}"})

        return lambda: client

    pages = spark.createDataFrame([("b", i, f"t{i}", b"x" * i if i else None) for i in range(7)], "book_id string, page_number int, embedded_text string, image binary").coalesce(1)
    try:
        M.ocr(pages, client=factory(True), journal=journal).collect()
        raise AssertionError("the run should have been killed")
    except Exception as e:
        assert "should have been" not in str(e)
    first = {p.name.split("-")[0] for p in calls.iterdir()}
    assert "t3" in first and "t0" not in first
    for p in calls.iterdir():
        p.unlink()
    got = {r.page_number: (r.ocr_text, r.notes, r.error) for r in M.ocr(pages, client=factory(False), journal=journal).collect()}
    assert got[1] == ("t1!", "1", None) and got[6] == ("t6!", "6", None) and len(got) == 7
    assert {p.name.split("-")[0] for p in calls.iterdir()} == {"t1", "t2", "t3", "t4", "t5", "t6"} - (first - {"t3"})


def test_pages_that_are_read_already(spark, tmp_path):
    pages = spark.createDataFrame([("b", 1, "look", b"abc"), ("b", 2, "look", b"abcd"), ("b", 3, "none", None)], "book_id string, page_number int, embedded_text string, image binary")
    done = spark.createDataFrame([("b", 1, "kept", "n")], "book_id string, page_number int, ocr_text string, notes string")
    got = {r.page_number: (r.ocr_text, r.notes, r.error) for r in flows.ocr_pages(pages, done, str(tmp_path)).collect()}
    assert got == {1: ("kept", "n", None), 2: ("lOOk", "4 bytes", None), 3: ("", "", None)}


def test_page_images(spark, monkeypatch):
    monkeypatch.setitem(scans.RENDERERS, ".pdf", lambda content: content.split(b"|"))
    docs = spark.createDataFrame([("a", "pdf", b"1|22"), ("b", "image", b"png"), ("c", "pdf", None)], "source string, kind string, content binary")
    got = {(r.source, r.page_number): (bytes(r.image or b""), r.error is None) for r in scans.page_images(docs).collect()}
    assert got == {("a", 1): (b"1", True), ("a", 2): (b"22", True), ("b", 1): (b"png", True), ("c", 1): (b"", False)}


def records(folder, bad=True):
    os.makedirs(folder, exist_ok=True)
    for name, content in {
        "page_0001.json": {"source": "s", "kind": "pdf_page", "page_number": 1, "embedded_text": "e", "unknown": 1}, "page_0002.json": {"source": "s", "kind": "pdf_page", "page_number": 2, "translation": "t"},
        "page_0002b.json": {"source": "s", "kind": "pdf_page", "page_number": 2, "translation": "later"}, "page_0003.json": {"kind": "pdf_page", "page_number": 3},
    }.items():
        with open(f"{folder}/{name}", "w") as f:
            json.dump(content, f, indent=2)
    if bad:
        with open(f"{folder}/page_0004.json", "w") as f:
            f.write("{not json")


def test_tolerant_checkpoints(spark, tmp_path):
    records(f"{tmp_path}/run/_checkpoints")
    got = {r.page_number: (r.embedded_text, r.translation, r.notes) for r in scans.read_checkpoints(spark, f"{tmp_path}/*/_checkpoints").collect()}
    assert got == {1: ("e", "", ""), 2: ("", "later", "")}


def test_stream_equals_batch(spark, tmp_path):
    records(f"{tmp_path}/in", bad=False)
    seen = {}

    def sink(latest, number):
        seen[number] = {(r.source, r.n_pages, r.last_page) for r in P.snapshot(latest).collect()}

    P.watch(spark, f"{tmp_path}/in", sink, f"{tmp_path}/state").awaitTermination(60)
    batch = {(r.source, r.n_pages, r.last_page) for r in P.snapshot(scans.read_checkpoints(spark, f"{tmp_path}/in")).collect()}
    assert seen[max(seen)] == batch == {("s", 2, 2)}
    with open(f"{tmp_path}/in/page_0009.json", "w") as f:
        json.dump({"source": "s", "kind": "pdf_page", "page_number": 9}, f)
    P.watch(spark, f"{tmp_path}/in", sink, f"{tmp_path}/state").awaitTermination(60)
    assert seen[max(seen)] == {("s", 3, 9)}


def test_word_files_open(spark):
    books = spark.createDataFrame([("b", "# T\n- item\n\nplain <&> \x01\n1. one\n")], "book_id string, text string")
    row = sinks.docx_files(rendering.report_blocks(books, "docx")).first()
    with zipfile.ZipFile(io.BytesIO(bytes(row.content))) as z:
        assert z.testzip() is None
        text = z.read("word/document.xml").decode()
    xml.dom.minidom.parseString(text)
    assert "plain &lt;&amp;&gt; " in text and 'w:val="Heading1"' in text and "ListBullet" in text and text.count('w:type="page"') == 1


def test_documents_and_images(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4, "big") + (480).to_bytes(4, "big")
    for name, content in {"a.PDF": b"%PDF-broken", "b.png": png, "c.txt": b"x"}.items():
        (tmp_path / name).write_bytes(content)
    docs = scans.read_documents(spark, str(tmp_path))
    assert {(r.source[-5:], r.kind) for r in docs.collect()} == {("a.PDF", "pdf"), ("b.png", "image")}
    pages = scans.scan_pages(docs.filter("kind = 'pdf'")).collect()
    assert len(pages) == 1 and pages[0].error and pages[0].page_number == 1
    late = scans.scan_pages(docs.filter("kind = 'pdf'"), start=2).collect()
    assert len(late) == 1 and late[0].error
    assert scans.image_size(png) == (640, 480) and scans.scan_images(docs).count() == 1


def test_writers(spark, tmp_path):
    pages = spark.createDataFrame([("b", 1, "x"), ("c", 2, "y")], "book_id string, page_number int, ocr_text string")
    sinks.write_checkpoints(pages, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    books = spark.createDataFrame([("b", "one\ntwo")], "book_id string, text string")
    sinks.write_texts(books, f"{tmp_path}/text", a_folder_each=True)
    assert spark.read.text(f"{tmp_path}/text").count() == 2
    sinks.write_texts(books, f"{tmp_path}/lines")
    assert [(r.book_id, r.text) for r in spark.read.json(f"{tmp_path}/lines").collect()] == [("b", "one\ntwo")] and os.listdir(f"{tmp_path}/lines")[0].startswith(("bucket=", "_", "."))


def test_noise_is_one_regex_and_scans_are_pruned(spark, sf):
    plan = X.pages(spark, sf).select("book_id", "page_number")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_entry_point_without_the_optional_parts(tmp_path):
    subprocess.run(["cp", "-r", f"{ROOT}/bookflow", f"{ROOT}/__spark_entry__.py", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", f"{tmp_path}/bookflow/llm"], check=True)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 90 and set(o) <= set(q) and not any(n.startswith('op') for n in q); print(len(q), len(o))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr


def test_entry_point_without_a_library_of_the_optional_parts(tmp_path):
    parts = [x for x in ("bookflow", "__spark_entry__.py", "corpus_pipeline.py") if os.path.exists(f"{ROOT}/{x}")]
    subprocess.run(["cp", "-r", *(f"{ROOT}/{x}" for x in parts), str(tmp_path)], check=True)
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and 'pipeline' not in q"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0 and ("left out" in out.stderr) == os.path.exists(f"{ROOT}/bookflow/llm"), out.stderr


def test_offsets_add_up(spark, sf):
    from bookflow.operators.lines import with_offsets

    last = with_offsets(X.lines(spark, sf)).groupBy("book_id").agg(F.max(F.col("line_offset") + F.length("line")).alias("n"))
    assert last.join(X.books(spark, sf), "book_id").filter("n <> length(text)").count() == 0
