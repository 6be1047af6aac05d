"""Word and PDF files: what they hold, and that they are well formed."""

import io
import re
import xml.dom.minidom
import zipfile
import zlib

from pyspark.sql import functions as F

from bookflow import rules
from bookflow.operators import rendering
from bookflow.sources import writers


def document(content):
    with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
        assert z.testzip() is None
        texts = {n: z.read(n).decode() for n in z.namelist()}
    for x in texts.values():
        xml.dom.minidom.parseString(x)
    return texts


def shown(content):
    """The texts of each page of a PDF made by writers.pdf, and a check of its table of places."""
    content = bytes(content)
    start = int(re.search(rb"startxref\n(\d+)\n%%EOF\n$", content)[1])
    places = [int(x) for x in re.findall(rb"(\d{10}) 00000 n", content[start:])]
    for n, at in enumerate(places, 1):
        assert content[at:].startswith(b"%d 0 obj\n" % n)
    assert b"/Count %d " % content.count(b"/Type /Page ") in content
    pages = []
    for n in re.finditer(rb"/Length (\d+) /Filter /FlateDecode >>\nstream\n", content):
        raw = zlib.decompress(content[n.end() : n.end() + int(n[1])]).decode()
        pages.append(["" if not h else bytes.fromhex(h).decode("utf-16-be") for h in re.findall(r"<([0-9a-f]*)> Tj", raw)])
    return pages


def test_final_file(spark):
    rows = [("b", 0, rules.PREAMBLE, "not here"), ("b", 1, "序 文", "one\nline\n\n① note"), ("b", 2, "Ⅰ", ""), ("b", 3, "梦的世界——岛尾敏雄", "<text> & more\x01")]
    blocks = rendering.final_blocks(spark.createDataFrame(rows, "book_id string, section_no int, title string, content string"))
    row = writers.final_files(blocks).first()
    files = document(row.content)
    text = files["word/document.xml"]
    assert "not here" not in text and "&lt;text&gt; &amp; more<" in text and "one line" in text
    assert text.index(rules.COVER[0][0]) < text.index(rules.CONTENTS_HEAD) < text.index("one line")
    assert text.count("<w:pageBreakBefore/>") == 2 and '<w:sz w:val="18"/></w:rPr><w:t xml:space="preserve">① note' in text
    assert f'w:eastAsia="{rules.WORD_FONT}"' in files["word/styles.xml"]


def test_formatted_file(spark):
    merged = spark.createDataFrame([("b", 1, 1, "序文"), ("b", 2, 0, "a\nb"), ("b", 3, 2, "x")], "book_id string, para_no int, level int, content string")
    text = document(writers.final_files(rendering.formatted_parts(merged)).first().content)["word/document.xml"]
    assert rules.COVER_LINE in text and "<w:br/>" in text and text.count("<w:pageBreakBefore/>") == 1
    assert 'w:val="Heading1"' in text and 'w:val="Heading2"' in text and 'w:val="Title"' in text


def test_report_parts(spark):
    texts = spark.createDataFrame([("b", "core: fake", " ", "# 标题\n" + "字" * 2500 + "\n\n<&> 😀\n", None)], "book_id string, info string, summary string, text string, extracted string")
    pages = shown(writers.pdf_files(rendering.report_blocks(texts, "pdf")).first().content)
    assert [p[0] for p in pages if p[0] in ("b", *rules.REPORT_PARTS)] == ["b", *rules.REPORT_PARTS[1:]] and pages[0][1:3] == [rules.REPORT_PARTS[0], "core: fake"]
    everything = [x for p in pages for x in p]
    assert sum(x.count("字") for x in everything) == 2500 and "<&> 😀" in everything
    assert rules.NO_SUMMARY in everything and rules.NO_EXTRACT in everything and rules.NO_TRANSLATION not in everything
    word = document(writers.report_files(rendering.report_blocks(texts, "docx")).first().content)["word/document.xml"]
    assert word.count('w:type="page"') == 3 and all(x in word for x in rules.REPORT_PARTS)


def test_lines_of_a_pdf_fit(spark):
    text = "a" * 30 + "字" * 30
    lines = list(writers.wrapped(text, 10))
    assert "".join(lines) == text and all(sum(map(writers.width_of, x)) <= 10 for x in lines) and list(writers.wrapped("", 10)) == [""]
    long = [{"part_no": 0, "head": "h", "kind": "body", "text": str(n)} for n in range(500)]
    pages = writers.drawn(long, "t")
    assert len(pages) > 5 and all(y >= rules.PDF_MARGINS[1] * writers.MM for p in pages for _, y, _ in p)
    assert [x for p in pages for s, _, x in p if s == "body"] == [str(n) for n in range(500)]


def test_page_images_are_kept(spark, tmp_path):
    pages = spark.createDataFrame([("b", 1, bytearray(b"x")), ("b", 12, bytearray(b"y")), ("c", 1, None)], "book_id string, page_number int, image binary")
    assert writers.write_page_images(pages, str(tmp_path)) == 2 and writers.write_page_images(pages, str(tmp_path)) == 2
    assert sorted(x.name for x in (tmp_path / "b").iterdir() if not x.name.startswith(".")) == ["page_0001.jpg", "page_0012.jpg"]
    assert writers.write_each(pages.filter(F.lit(False)).select(F.lit("n").alias("name"), F.col("image").alias("content")), str(tmp_path)) == 0
