"""Word and PDF files of block tables, made with the standard library; page images and files written by the executors."""

from __future__ import annotations

import html
import io
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.sources.sinks import WORD, docx

#: Word styles of the kinds of blocks; the others are plain paragraphs.
STYLES = {"title": "Title", "heading1": "Heading1", "heading2": "Heading2", "heading3": "Heading3"}
NAMES = {"Normal": "Normal", "Title": "Title", "Heading1": "heading 1", "Heading2": "heading 2", "Heading3": "heading 3"}
TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/><Override PartName="/word/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.styles+xml"/></Types>'
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
#: Twentieths of a point in a centimetre.
CM = 567


def word_styles(font: str = rules.WORD_FONT) -> str:
    """styles.xml: the styles in use, all in one font, for East Asian text too."""
    face = f'<w:rPr><w:rFonts w:ascii="{font}" w:hAnsi="{font}" w:eastAsia="{font}"/></w:rPr>'
    each = "".join(f'<w:style w:type="paragraph" w:styleId="{i}"{" w:default=" + chr(34) + "1" + chr(34) if i == "Normal" else ""}><w:name w:val="{name}"/>{face}</w:style>' for i, name in NAMES.items())
    return f'<?xml version="1.0" encoding="UTF-8"?><w:styles xmlns:w="{WORD}">{each}</w:styles>'


def paragraph(b: dict) -> str:
    """XML of a block (style, page_before, centred, points, text); line ends are soft breaks."""
    style = STYLES.get(b["style"])
    how = f'<w:pStyle w:val="{style}"/>' if style else ""
    how += "<w:pageBreakBefore/>" if b["page_before"] else ""
    how += {"child": f'<w:ind w:left="{CM}"/>', "indented": f'<w:ind w:firstLine="{round(0.74 * CM)}"/>'}.get(b["style"], "")
    how += '<w:jc w:val="center"/>' if b["centred"] else ""
    bold = "<w:b/>" if style or b["style"] in ("top", "part") or (b["style"] == "cover" and b["points"] > 20) else ""
    clean = "".join(c for c in b["text"] if c >= " " or c in "\t\n")
    runs = "<w:br/>".join(f'<w:t xml:space="preserve">{html.escape(x, quote=False)}</w:t>' for x in clean.split("\n"))
    return f'<w:p><w:pPr>{how}</w:pPr><w:r><w:rPr>{bold}<w:sz w:val="{2 * b["points"]}"/></w:rPr>{runs}</w:r></w:p>'


def word_file(blocks: Iterable[dict], right: float = 2.5) -> bytes:
    """A Word file with margins of 2.5 cm (3 cm on the left)."""
    margins = f'<w:sectPr><w:pgMar w:top="{round(2.5 * CM)}" w:bottom="{round(2.5 * CM)}" w:left="{3 * CM}" w:right="{round(right * CM)}"/></w:sectPr>'
    document = f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{WORD}"><w:body>{"".join(map(paragraph, blocks))}{margins}</w:body></w:document>'
    files = {
        "[Content_Types].xml": TYPES, "word/document.xml": document, "word/styles.xml": word_styles(),
        "_rels/.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{PACKAGE}"><Relationship Id="r1" Type="{OFFICE}/officeDocument" Target="word/document.xml"/></Relationships>',
        "word/_rels/document.xml.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{PACKAGE}"><Relationship Id="r1" Type="{OFFICE}/styles" Target="styles.xml"/></Relationships>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in files.items():
            z.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), content)
    return out.getvalue()


def report_file(blocks: Iterable[dict], title: str) -> bytes:
    """A Word report: the title, then parts under their heads, each but the first on a new page."""
    out, part = [("heading", 1, title)], None
    for b in blocks:
        if b["part_no"] != part:
            out += [("page", 0, "")] * (part is not None) + [("heading", 1, b["head"])]
            part = b["part_no"]
        out.append((b["kind"], b["level"], b["text"]))
    return docx(out)


MM = 72 / 25.4
PAGE = (210 * MM, 297 * MM)


def width_of(c: str) -> float:
    """Width in ems as the file declares it: half for ASCII, else whole."""
    return 0.5 if " " <= c <= "~" else 1.0


def wrapped(text: str, ems: float) -> Iterator[str]:
    """Lines of at most so many ems, broken between any two characters."""
    start, used = 0, 0.0
    for i, c in enumerate(text):
        w = width_of(c)
        if used + w > ems and i > start:
            yield text[start:i]
            start, used = i, 0.0
        used += w
    yield text[start:]


def drawn(blocks: Iterable[dict], title: str) -> list[list[tuple[str, float, str]]]:
    """Lines (style, distance of the base line from the bottom, text) of each page of a report; texts hold HTML escapes."""
    side, top = (x * MM for x in rules.PDF_MARGINS)
    pages, at, part = [[]], PAGE[1] - top, None

    def put(style: str, text: str) -> None:
        nonlocal at
        points, leading, before, after, _ = rules.PDF_STYLES[style]
        at -= before if pages[-1] else 0
        for line in wrapped("".join(c for c in html.unescape(text).replace("\t", " ") if c >= " "), (PAGE[0] - 2 * side) / points):
            if at - leading < top:
                pages.append([])
                at = PAGE[1] - top
            at -= leading
            pages[-1].append((style, at + leading - points, line))
        at -= after

    put("title", html.escape(title))
    for b in blocks:
        if b["part_no"] != part:
            if part is not None:
                pages.append([])
                at = PAGE[1] - top
            part = b["part_no"]
            put("h1", b["head"])
        if b["kind"] == "space":
            at -= rules.PDF_SPACE
        else:
            put(b["kind"], b["text"])
    return pages


def pdf(blocks: Iterable[dict], title: str, font: str = "STSong-Light") -> bytes:
    """A PDF report. The font isn't embedded: it is one of the CJK fonts that readers bring along."""
    side = rules.PDF_MARGINS[0] * MM
    pages = drawn(blocks, title)
    kids = " ".join(f"{6 + 2 * i} 0 R" for i in range(len(pages)))
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>", f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} >>".encode(),
        f"<< /Type /Font /Subtype /Type0 /BaseFont /{font} /Encoding /UniGB-UTF16-H /DescendantFonts [4 0 R] >>".encode(),
        f"<< /Type /Font /Subtype /CIDFontType0 /BaseFont /{font} /CIDSystemInfo << /Registry (Adobe) /Ordering (GB1) /Supplement 4 >> /FontDescriptor 5 0 R /DW 1000 /W [1 95 500] >>".encode(),
        f"<< /Type /FontDescriptor /FontName /{font} /Flags 6 /FontBBox [-25 -254 1000 880] /ItalicAngle 0 /Ascent 752 /Descent -271 /CapHeight 737 /StemV 58 >>".encode(),
    ]
    for i, lines in enumerate(pages):
        text = "\n".join(f"BT /F1 {rules.PDF_STYLES[style][0]} Tf {rules.PDF_STYLES[style][4]} g {side:.2f} {y:.2f} Td <{line.encode('utf-16-be', 'replace').hex()}> Tj ET" for style, y, line in lines)
        packed = zlib.compress(text.encode())
        objects.append(f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {PAGE[0]:.2f} {PAGE[1]:.2f}] /Resources << /Font << /F1 3 0 R >> >> /Contents {7 + 2 * i} 0 R >>".encode())
        objects.append(f"<< /Length {len(packed)} /Filter /FlateDecode >>\nstream\n".encode() + packed + b"\nendstream")
    out, places = io.BytesIO(), []
    out.write(b"%PDF-1.5\n%\xe2\xe3\xcf\xd3\n")
    for n, content in enumerate(objects, 1):
        places.append(out.tell())
        out.write(b"%d 0 obj\n%s\nendobj\n" % (n, content))
    start = out.tell()
    out.write(b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % x for x in places))
    out.write(b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, start))
    return out.getvalue()


def files(blocks: DataFrame, order: list[str], make: Callable[[list[dict], str], bytes]) -> DataFrame:
    """(book_id, content): `make` gets a book's blocks in order, and its id. A book's blocks meet in one row, and a book is bounded."""
    rest = [c for c in blocks.columns if c not in ("book_id", *order)]
    books = blocks.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias("bs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for book, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array([book], pa.string()), pa.array([make(rows.as_py(), book)], pa.binary())], ["book_id", "content"])

    return books.mapInArrow(run, "book_id string, content binary")


def final_files(blocks: DataFrame) -> DataFrame:
    """(book_id, content): Word files of rendering.final_blocks or rendering.formatted_parts."""
    return files(blocks, ["part_no", "section_no", "para_no"], lambda rows, _: word_file(rows))


def report_files(blocks: DataFrame) -> DataFrame:
    """(book_id, content): Word files of rendering.report_blocks(..., 'docx')."""
    return files(blocks, ["part_no", "line_no"], report_file)


def pdf_files(blocks: DataFrame) -> DataFrame:
    """(book_id, content): PDF files of rendering.report_blocks(..., 'pdf')."""
    return files(blocks, ["part_no", "line_no", "block_no"], pdf)


def put_file(folder: str, name: str, content: bytes) -> None:
    """One file, written under another name first, so that none is ever there by half; another attempt replaces it."""
    fs, at = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    own = f"{at}/{name}"
    fs.create_dir(own.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(own + ".part") as f:
        f.write(content)
    fs.move(own + ".part", own)


def write_each(rows: DataFrame, folder: str) -> int:
    """Writes (name, content) as files below a folder from the executors, for few of them; how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                put_file(folder, name, content.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return rows.select("name", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_page_images(pages: DataFrame, folder: str) -> int:
    """Keeps the images of pages (book_id, page_number, image) as folder/book_id/page_0001.jpg; how many."""
    name = F.concat("book_id", F.format_string("/page_%04d.jpg", F.col("page_number")))
    return write_each(pages.filter("image IS NOT NULL").select(name.alias("name"), F.col("image").alias("content")), folder)
