"""Scans: page records, Markdown, images, PDF pages and run folders; with tolerant reads.

PDF decoding and image scaling need libraries that may be absent: they are adapters, imported where they run.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators.checkpoints import PAGE, tolerant

Decoder = Callable[[bytes], list[str]]
DECODERS: dict[str, Decoder] = {}


def register_decoder(suffix: str, decoder: Decoder) -> None:
    """A decoder gives the texts of the pages of a document."""
    DECODERS[suffix] = decoder


def decode_pdf(content: bytes) -> list[str]:
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading PDF pages needs PyMuPDF, or a decoder registered for .pdf") from e
    with fitz.open(stream=content, filetype="pdf") as doc:
        return [page.get_text("text").strip() for page in doc]


register_decoder(".pdf", decode_pdf)


def read_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Page records of all page_*.json in the checkpoint folders named (a glob such as out/*/_checkpoints; Spark hides such folders below a parent).

    Files that are no JSON or lack a required field are skipped; the last file of a page wins.
    """
    rows = spark.read.schema(f"{PAGE.simpleString()[7:-1].replace(':', ' ')}, bad string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad").option("pathGlobFilter", "page_*.json").json(folder)
    whole = tolerant(rows.withColumn("file_name", F.col("_metadata.file_name")).filter("bad is null").drop("bad"))
    return whole.groupBy("source", "page_number").agg(F.max_by(F.struct("kind", "embedded_text", "ocr_text", "translation", "notes", "image_path", "file_name"), "file_name").alias("r")).select("source", "page_number", "r.*")


def read_markdown(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(book_id, text): whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("book_id"), F.col("value").alias("text"))


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source, kind, content) of all supported files below a path; kind is pdf or image."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("source"), T.source_kind(F.col("path")).alias("kind"), "content").filter("kind is not null")


def scan_pages(documents: DataFrame, suffix: str = ".pdf", start: int = 1, most: int | None = None) -> DataFrame:
    """(source, kind, page_number, embedded_text, error): one row a page, pages from 1; a document that can't be read gives one row with its error."""
    decoder = DECODERS[suffix]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, content in zip(batch.column(0), batch.column(1)):
                try:
                    texts, error = decoder(content.as_py()), None
                except Exception as e:  # errors stay with their document
                    texts, error = [], str(e) or type(e).__name__
                last = len(texts) if most is None else min(len(texts), max(1, start) + most - 1)
                rows = [(max(1, start), "")] if error else [(n, texts[n - 1]) for n in range(max(1, start), last + 1)]
                yield pa.RecordBatch.from_pydict({"source": [source.as_py()] * len(rows), "kind": ["pdf_page"] * len(rows), "page_number": pa.array([n for n, _ in rows], pa.int32()), "embedded_text": [t for _, t in rows], "error": pa.array([error] * len(rows), pa.string())})

    return documents.select("source", "content").mapInArrow(run, "source string, kind string, page_number int, embedded_text string, error string")


Renderer = Callable[[bytes], list[bytes]]


def pdf_renderer(dpi: int = rules.DPI, most: int = rules.MAX_SIDE, quality: int = rules.JPEG_QUALITY) -> Renderer:
    """A renderer of PDF pages at so many dots an inch, shrunk until the longer side is at most `most` (0: as they are)."""

    def render(content: bytes) -> list[bytes]:
        try:
            import fitz
        except ImportError as e:
            raise RuntimeError("rendering PDF pages needs PyMuPDF, or a renderer registered for .pdf") from e
        out = []
        with fitz.open(stream=content, filetype="pdf") as doc:
            for page in doc:
                zoom = shrink(dpi / 72, page.rect.width, page.rect.height, most)
                out.append(page.get_pixmap(matrix=fitz.Matrix(zoom, zoom), alpha=False).tobytes("jpeg", quality))
        return out

    return render


def shrink(zoom: float, width: float, height: float, most: int) -> float:
    """The zoom at which a page of that size in points has no side of more than `most` pixels."""
    return min(zoom, most / max(width, height, 1)) if most > 0 else zoom


RENDERERS: dict[str, Renderer] = {".pdf": pdf_renderer()}


def register_renderer(suffix: str, renderer: Renderer) -> None:
    """A renderer gives the images of the pages of a document."""
    RENDERERS[suffix] = renderer


def page_images(documents: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """(source, page_number, image, error): an image for each page of documents, and images as they are (page 1)."""
    renderer = RENDERERS[suffix]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, kind, content in zip(*batch.columns):
                try:
                    images, error = [content.as_py()] if kind.as_py() == "image" else renderer(content.as_py()), None
                except Exception as e:  # errors stay with their document
                    images, error = [None], str(e) or type(e).__name__
                for n, image in enumerate(images, 1):  # a page at a time
                    yield pa.RecordBatch.from_pydict({"source": pa.array([source.as_py()]), "page_number": pa.array([n], pa.int32()), "image": pa.array([image], pa.binary()), "error": pa.array([error], pa.string())})

    return documents.select("source", "kind", "content").mapInArrow(run, "source string, page_number int, image binary, error string")


def cached_images(spark: SparkSession, folder: str) -> DataFrame:
    """(book_id, page_number, image) of the images that a run kept as folder/book_id/page_0001.jpg; other files are left out, and a folder that isn't there has none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "book_id string, page_number int, image binary")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "page_*.jpg").load(folder)
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -2).alias("book_id"), page_of_image(F.element_at(parts, -1)).alias("page_number"), F.col("content").alias("image")).filter("page_number IS NOT NULL")


def scan_images(documents: DataFrame) -> DataFrame:
    """One page record for each image; its page is 1."""
    return documents.filter("kind = 'image'").select("source", F.lit("image").alias("kind"), F.lit(1).alias("page_number"), F.lit("image_0001.jpg").alias("image_path"))


def image_size(content: bytes) -> tuple[int, int] | None:
    """Width and height of a PNG or JPEG, from its header."""
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", content[16:24])
    at = 2
    while content[:2] == b"\xff\xd8" and at + 9 < len(content):
        marker, size = content[at + 1], struct.unpack(">H", content[at + 2 : at + 4])[0]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            return struct.unpack(">HH", content[at + 5 : at + 9])[::-1]
        at += 2 + size
    return None


def scaled(width: Column, height: Column, most: int = rules.MAX_SIDE) -> tuple[Column, Column]:
    """Size after shrinking the longer side to `most`; 0 keeps it."""
    s = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height)) if most > 0 else F.lit(1.0)
    return tuple(F.when(s < 1, F.greatest(F.lit(1), (x * s).cast("int"))).otherwise(x.cast("int")) for x in (width, height))


def page_of_image(name: Column) -> Column:
    return F.regexp_extract(name, r"^page_([0-9]+)\.jpg", 1).try_cast("int")


