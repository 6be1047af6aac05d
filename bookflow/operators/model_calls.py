"""Model stages: a client behind a small protocol, retries, a limiter, and the dataflow around the calls.

A client is a callable (kind, text) -> text, or (kind, text, image) -> text for kind ocr; the other kinds are translate,
summarize, reduce and repair. Each partition builds its own client from a factory. With a journal, replies are saved as
they come and a run that starts again doesn't pay for them twice; without one, results of paid calls should be written
before they are used twice. A failed call makes its whole page, summary or section fail: its error is carried along,
nothing partial counts as done, and a section that can't be repaired stays as it is.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators import chunking
from bookflow.operators.lines import joined

Client = Callable[..., str]
CLIENTS: dict[str, Callable[[], Client]] = {}


class AuthenticationError(RuntimeError):
    """The provider refused the key (401 or 403); another attempt makes no sense."""


def register_model_client(name: str, factory: Callable[[], Client]) -> None:
    CLIENTS[name] = factory


def fake(kind: str, text: str, image: bytes | None = None) -> str:
    """A deterministic stand-in: translations in upper case of e, summaries of 80 characters, repairs without // at line
    ends, and page texts in JSON that are the reference text with O for o, noting the image's size."""
    if kind == "ocr":
        return json.dumps({"text": text.replace("o", "O"), "notes": f"{len(image or b'')} bytes"}, ensure_ascii=False)
    if kind == "translate":
        return text.replace("e", "E")
    if kind in ("summarize", "reduce"):
        return text[:80]
    return text.replace("//\n", "") if kind == "repair" else text


register_model_client("fake", lambda: fake)


def retry(call: Callable[[], str], attempts: int = 3, base: float = 2.0, sleep: Callable[[float], None] = time.sleep, stop_on_auth: bool = True) -> str:
    """Waits base, 2 base, ... between attempts; an authentication error ends it at once."""
    error: Exception = RuntimeError("no attempt")
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except AuthenticationError as e:
            error = e
            if stop_on_auth:
                break
        except Exception as e:  # any error of a provider
            error = e
        if attempt < attempts:
            sleep(base * attempt)
    raise RuntimeError(f"the call failed: {error}") from error


def with_json_fallback(call: Callable[[bool], str], json_mode: bool = True, **how) -> str:
    """All attempts in JSON mode, then all of them without."""
    try:
        return retry(lambda: call(json_mode), **how)
    except RuntimeError:
        if not json_mode:
            raise
        return retry(lambda: call(False), **how)


def retry_waits(attempts: Column, failures: Column, base: float) -> Column:
    """Waits of a call whose first `failures` attempts fail."""
    n = F.least(failures, attempts - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: i * F.lit(base))).otherwise(F.array().cast("array<double>"))


def saved(spark: SparkSession, journal: str) -> DataFrame:
    """(key, reply) of a journal; the folder may not be there yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(journal)
    schema = "key string, reply string"
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(journal).filter("key IS NOT NULL").groupBy("key").agg(F.max("reply").alias("reply"))


def save(journal: str, replies: list[tuple[str, str]]) -> None:
    """One more file of the journal, written under another name first."""
    fs, at = pyarrow.fs.FileSystem.from_uri(journal if "://" in journal else f"file://{journal}")
    fs.create_dir(at, recursive=True)
    name = uuid.uuid4().hex
    with fs.open_output_stream(f"{at}/_{name}") as f:
        f.write("".join(json.dumps({"key": k, "reply": r}, ensure_ascii=False) + "\n" for k, r in replies).encode())
    fs.move(f"{at}/_{name}", f"{at}/{name}.json")


def map_texts(df: DataFrame, kind: str, text_col: str, out_col: str, client: str | Callable[[], Client] = "fake", parallel: int | None = None, pause: float = 0.0, image_col: str | None = None, journal: str | None = None, every: int = 1) -> DataFrame:
    """Adds out_col, the client's reply to text_col (and image_col), and error (null if it went well). Blank texts (or, with image_col, rows without an image) aren't sent and stay as they are.

    parallel bounds how many calls run at once; pause is the wait after each call. Replies go to the folder `journal`,
    `every` of them in a file, and those that are there aren't asked for again.
    """
    factory = CLIENTS[client] if isinstance(client, str) else client
    columns = df.columns
    if journal:
        key = F.sha2(F.concat_ws("\x1f", F.lit(kind), F.coalesce(text_col, F.lit("")), F.sha2(F.coalesce(image_col, F.lit(b"")), 256) if image_col else F.lit("")), 256)
        df = df.withColumn("call_key", key).join(saved(df.sparkSession, journal).select(F.col("key").alias("call_key"), F.col("reply").alias("call_reply")), "call_key", "left")
    keep = [c for c in df.columns if c not in ("call_key", "call_reply")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, done = factory(), []
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: B023, E731
            replies, errors, none = [], [], [None] * batch.num_rows
            for text, image, k, known in zip(column(text_col), column(image_col) if image_col else none, column("call_key") if journal else none, column("call_reply") if journal else none, strict=True):
                reply, error = text, None
                if known is not None:
                    reply = known
                elif image if image_col else (text or "").strip():
                    try:
                        reply = retry(lambda t=text, i=image: own(kind, t or "", i) if image_col else own(kind, t))
                    except RuntimeError as e:
                        reply, error = None, str(e)
                    if journal and error is None:
                        done.append((k, reply))
                        if len(done) >= every:
                            save(journal, done)
                            done.clear()
                    if pause:
                        time.sleep(pause)
                replies.append(reply)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(replies, pa.string()), pa.array(errors, pa.string())], [*keep, out_col, "error"])
        if done:
            save(journal, done)

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema if f.name in keep)}, `{out_col}` string, error string"
    return (df.repartition(parallel) if parallel else df).mapInArrow(run, schema).select(*columns, out_col, "error")


def whole(text: Column) -> Column:
    """The joined text, or null where a part of it failed."""
    return F.when(F.max("error").isNull(), text)


def ocr(pages: DataFrame, image_col: str = "image", **how) -> DataFrame:
    """pages (book_id, page_number, image, embedded_text, ...) with ocr_text, notes and error: each image is read with the embedded text as reference."""
    done = map_texts(pages, "ocr", "embedded_text", "reply", image_col=image_col, **how)
    r = T.lenient_json(F.col("reply"))
    read = done.withColumn("r", F.when(F.col(image_col).isNotNull() & F.col("reply").isNotNull(), r))
    return read.select(*(c for c in pages.columns if c not in ("ocr_text", "notes")), F.coalesce("r.text", F.lit("")).alias("ocr_text"), F.coalesce("r.notes", F.lit("")).alias("notes"), "error")


def translate(pages: DataFrame, most: int, **how) -> DataFrame:
    """(book_id, page_number, translation, error): chunks of each page's text, translated, joined in order; empty where a chunk failed."""
    source = T.source_text(F.col("ocr_text"), F.col("embedded_text"))
    chunks = pages.select("book_id", "page_number", F.posexplode_outer(chunking.split_text(source, max(1000, most))).alias("chunk_no", "chunk"))
    done = map_texts(chunks, "translate", "chunk", "reply", **how)
    part = F.when(F.col("reply") != "", F.col("reply"))
    parts = done.select("book_id", "page_number", "chunk_no", part.alias("part"), "error").groupBy("book_id", "page_number")
    return parts.agg(F.coalesce(whole(T.strip(joined("chunk_no", "part", "\n\n"))), F.lit("")).alias("translation"), F.max("error").alias("error"))


def chunk_summaries(texts: DataFrame, most: int, **how) -> DataFrame:
    """(book_id, summaries, error): chunk summaries under numbered headers; null where one failed."""
    chunks = texts.select("book_id", F.posexplode(chunking.split_text(F.col("text"), most)).alias("p", "chunk"))
    done = map_texts(chunks, "summarize", "chunk", "reply", **how)
    part = F.concat(F.format_string("## 分块 %d\n", F.col("p") + 1), F.col("reply"))
    return done.select("book_id", "p", part.alias("part"), "error").groupBy("book_id").agg(whole(joined("p", "part", "\n\n")).alias("summaries"), F.max("error").alias("error"))


def two_level_summary(texts: DataFrame, most: int, **how) -> DataFrame:
    """(book_id, summary, error): one more call over the joined chunk summaries; blank texts have none, and books of which a chunk failed aren't sent."""
    chunks = chunk_summaries(texts, most, **how).withColumnRenamed("error", "chunk_error")
    return map_texts(chunks, "reduce", "summaries", "summary", **how).select("book_id", "summary", F.coalesce("chunk_error", "error").alias("error"))


def repair(sections: DataFrame, most: int = 8000, **how) -> DataFrame:
    """(book_id, section_no, title, content, error): chunks of each section repaired and joined; blank sections stay, and so do those of which a chunk failed."""
    blank = T.is_blank(F.col("content"))
    chunks = sections.filter(~blank).select("book_id", "section_no", "title", F.posexplode(chunking.chunk_text(F.col("content"), most)).alias("chunk_no", "chunk"))
    done = map_texts(chunks, "repair", "chunk", "reply", **how)
    kept = joined("chunk_no", "kept", "\n\n")  # what the section was
    fixed = done.withColumn("kept", F.col("chunk")).groupBy("book_id", "section_no", "title").agg(F.coalesce(whole(joined("chunk_no", "reply", "\n\n")), kept).alias("content"), F.max("error").alias("error"))
    return fixed.union(sections.filter(blank).select("book_id", "section_no", "title", "content", F.lit(None).cast("string")))


def failures(done: DataFrame) -> DataFrame:
    """(book_id, n_pages, n_failed, exit_code) of rows (book_id, error, ...)."""
    counts = done.groupBy("book_id").agg(F.count("*").alias("n_pages"), F.count_if(F.col("error").isNotNull()).alias("n_failed"))
    return counts.withColumn("exit_code", F.when(F.col("n_failed") > 0, 1).otherwise(0))


def no_reply(x: Column) -> Column:
    return F.coalesce(F.nullif(x, F.lit("")), F.lit(rules.NO_TRANSLATION))
