"""Sinks: JSON records, run metadata, text outputs and Word files made with the standard library."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_FIELDS = ["source", "kind", "page_number", "embedded_text", "ocr_text", "translation", "notes", "image_path"]


def checkpoint_name(page: Column) -> Column:
    return F.format_string("page_%04d.json", page)


def page_json(*fields: str) -> Column:
    return F.to_json(F.struct(*(fields or PAGE_FIELDS)), {"ignoreNullFields": "false"})


def pages_array(pages: DataFrame, fields: list[str]) -> DataFrame:
    """(book_id, pages): one JSON array of a book's records in page order."""
    own = F.array_sort(F.collect_list(F.struct("page_number", *[f for f in fields if f != "page_number"])))
    return pages.groupBy("book_id").agg(F.to_json(own).alias("pages"))


#: Folders into which books are dealt by a hash of their id.
BUCKETS = 256


def in_buckets(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("book_id"), F.lit(BUCKETS)).cast("int"))


def write_checkpoints(pages: DataFrame, folder: str) -> None:
    """Appends page records as JSON lines, dealt into BUCKETS folders by book; scans take the latest of each page."""
    in_buckets(pages).write.mode("append").partitionBy("bucket").json(folder)


def write_texts(books: DataFrame, folder: str, a_folder_each: bool = False) -> None:
    """JSON lines (book_id, text) in BUCKETS folders by book, or text files in a folder for each book, for few books."""
    if a_folder_each:
        books.select("book_id", F.col("text").alias("value")).write.mode("overwrite").partitionBy("book_id").text(folder)
    else:
        in_buckets(books.select("book_id", "text")).write.mode("overwrite").partitionBy("bucket").json(folder)


STYLE = {("heading", 1): "Heading1", ("heading", 2): "Heading2", ("heading", 3): "Heading3", ("bullet", 0): "ListBullet", ("number", 0): "ListNumber"}
TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>'
RELS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'
WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx(blocks: list[tuple[str, int, str]]) -> bytes:
    """A Word file of blocks (kind, level, text); a line end within a text is a soft break, kind page is a page break."""
    body = []
    for kind, level, text in blocks:
        style = STYLE.get((kind, level))
        clean = "".join(c for c in text if c >= " " or c in "\t\n")
        runs = "<w:br/>".join(f'<w:t xml:space="preserve">{escape(x, quote=False)}</w:t>' for x in clean.split("\n"))
        runs = '<w:br w:type="page"/>' if kind == "page" else runs
        body.append(f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>' if style else ''}<w:r>{runs}</w:r></w:p>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in (("[Content_Types].xml", TYPES), ("_rels/.rels", RELS), ("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{WORD}"><w:body>{"".join(body)}</w:body></w:document>')):
            z.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), content)
    return out.getvalue()


def docx_files(blocks: DataFrame) -> DataFrame:
    """(book_id, content) of block tables (book_id, part_no, head, line_no, kind, level, text): a part's head, then its blocks, a page break between parts."""
    entry = F.struct("part_no", "line_no", "head", "kind", "level", "text")
    books = blocks.groupBy("book_id").agg(F.array_sort(F.collect_list(entry)).alias("bs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for book, rows in zip(batch.column(0), batch.column(1)):
                out, part = [], None
                for b in rows.as_py():
                    if b["part_no"] != part:
                        out += [("page", 0, "")] * (part is not None) + [("heading", 1, b["head"])]
                        part = b["part_no"]
                    out.append((b["kind"], b["level"], b["text"]))
                yield pa.RecordBatch.from_arrays([pa.array([book.as_py()]), pa.array([docx(out)], pa.binary())], ["book_id", "content"])

    return books.mapInArrow(run, "book_id string, content binary")
