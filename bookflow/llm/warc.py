"""WARC archives with a two-level capture index (operator 7).

write(): captures are dealt by ranges of their sort-friendly key (host reversed, then path and query) and sorted; a key
with very many captures is divided by page id. Each part
becomes one archive of gzip members, a file of index blocks (BLOCK sorted entries each, compressed) and a sparse
directory with the first key and the place of each block. Of captures with equal payloads one is the response; the
others are revisits that carry its id and the length and digest of the full payload, but not the payload.
lookup(): a url's key finds its parts among the parts' key ranges, its blocks by binary search in the directory, its
entries by binary search in the block, and then only those ranges are read; of the records those of that very url count.
read(): all records, without keys: every part's directory is walked and its blocks opened in turn.

Files are written under new names and listed in a manifest, which only has those of tasks that ended; a task that runs
again writes new files. pyarrow opens the files, so that any shared store that it knows can hold them.

Defined results: a null html has an empty payload; a null url has the key ''; of equal rows all with the largest id are
responses; a null id is written and never chosen as a response unless all ids of its payload are null; very long pages
are held whole, one at a time; an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, table, written

BLOCK, LEVEL, READ = 256, 1, 1 << 20
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "part int, first_key string, last_key string, n long, archive string, blocks string, directory string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def sort_key(url: Column) -> Column:
    """Reversed host, then port, path and query: com,example,www)/path?query; urls without a host are their own keys."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*://"
    rest = F.regexp_replace(url, rf"{scheme}(?:[^/?#@]*@)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?#:]*", 0)), r"\.$", "")
    port = F.regexp_extract(rest, "^[^/?#:]*(:[0-9]+)", 1)
    tail = F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.when(port.isin(":80", ":443"), "").otherwise(port), F.lit(")"), F.when(tail == "", "/").otherwise(tail))
    return F.when(url.rlike(scheme) & (host != ""), key).otherwise(url)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value: str) -> int | None:
    """The page id in a record id."""
    inner = value.strip().removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def one_line(text: str) -> str:
    return "".join(c if c.isprintable() else "%" + c.encode().hex() for c in text)


def pack(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member. Revisits have the HTTP head alone, with the full payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = head if revisit else head + payload
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Target-URI: {one_line(url or '')}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if revisit:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    maker = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return maker.compress("\r\n".join(fields).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + maker.flush()


def unpack(member: bytes) -> tuple:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of a gzip member; responses are verified."""
    raw = zlib.decompress(member, 31)
    top, rest = raw.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:] if ": " in line)
    body = rest[: int(fields["Content-Length"])]
    head, payload = body.split(b"\r\n\r\n", 1)
    size = next(int(line.split(b":")[1]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold its payload")
    refers = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI", ""), size, digest, kind, refers, payload if kind == "response" else None


def store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


class Part:
    """Writes one part's archive, index blocks and directory."""

    def __init__(self, base: str, part: int):
        self.part, self.names = part, {k: f"{base}/part-{part:05d}-{uuid.uuid4().hex}.{k}" for k in ("warc.gz", "blocks", "directory")}
        fs, at = store(base)
        fs.create_dir(at, recursive=True)
        self.archive, self.blocks = (fs.open_output_stream(store(self.names[k])[1], compression=None) for k in ("warc.gz", "blocks"))
        self.at, self.block_at, self.n, self.first, self.last, self.held, self.sparse = 0, 0, 0, None, None, [], []

    def add(self, key: str, page_id: int | None, member: bytes) -> None:
        self.archive.write(member)
        self.held.append((key, page_id, self.at, len(member)))
        self.first, self.last = key if self.first is None else self.first, key
        self.at, self.n = self.at + len(member), self.n + 1
        if len(self.held) == BLOCK:
            self.flush()

    def flush(self) -> None:
        if self.held:
            packed = zlib.compress(json.dumps(self.held).encode(), 6)
            self.blocks.write(packed)
            self.sparse.append((self.held[0][0], self.block_at, len(packed)))
            self.block_at, self.held = self.block_at + len(packed), []

    def close(self) -> tuple:
        self.flush()
        self.archive.close()
        self.blocks.close()
        fs, at = store(self.names["directory"])
        with fs.open_output_stream(at, compression=None) as f:
            f.write(json.dumps(self.sparse).encode())
        return self.part, self.first, self.last, self.n, self.names["warc.gz"], self.names["blocks"], self.names["directory"]


def captures(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, key, payload, size, digest, refers_to, revisit); revisits without payload."""

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    same = rows.select("page_id", "sha")
    # only payloads that occur more than once have revisits; the rest needs no partner in the join
    several = same.groupBy("sha").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).filter("n > 1").select("sha", "largest")
    revisits = written(written(same, "digests").join(written(several, "several"), "sha").filter("not page_id <=> largest").distinct(), "revisits")
    chosen = revisits.select(F.col("page_id").alias("of"), F.col("sha").alias("of_sha"), F.col("largest").alias("refers_to"), F.lit(True).alias("met"))
    joined = rows.join(chosen, rows["page_id"].eqNullSafe(chosen["of"]) & (rows["sha"] == chosen["of_sha"]), "left")
    revisit = F.coalesce("met", F.lit(False))
    return joined.select("page_id", "url", sort_key(F.col("url")).alias("key"), F.length("payload").cast("long").alias("size"), "sha", "refers_to", revisit.alias("revisit"), F.when(~revisit, F.col("payload")).alias("payload"))


def write(pages: DataFrame, base: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes archives and index of pages below base; the manifest has a row for each part."""
    spark = pages.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = None
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                for i, url, key, size, sha, refers, revisit, payload in zip(*(c.to_pylist() for c in whole.slice(at, 64).columns), strict=True):
                    part = part or Part(base, TaskContext.get().partitionId())
                    part.add(key, i, pack(i, url, payload, size, base64.b32encode(bytes.fromhex(sha)).decode(), refers, revisit))
        if part:
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "first_key", "last_key", "n", "archive", "blocks", "directory"), part.close()))], pa.schema([("part", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()), ("n", pa.int64()), ("archive", pa.string()), ("blocks", pa.string()), ("directory", pa.string())]))

    ordered = captures(pages, id_col, url_col, html_col).repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")
    return written(ordered.mapInArrow(run, MANIFEST), "manifest")


def ranges(entries: list[tuple]) -> Iterator[list[tuple]]:
    """Entries grouped so that each group lies together in the archive and is at most READ bytes (or one entry)."""
    held: list[tuple] = []
    for e in sorted(entries, key=lambda e: e[2]):
        if held and (e[2] != held[-1][2] + held[-1][3] or e[2] + e[3] - held[0][2] > READ):
            yield held
            held = []
        held.append(e)
    if held:
        yield held


def fetch(archive: str, entries: list[tuple]) -> Iterator[tuple]:
    fs, at = store(archive)
    with fs.open_input_file(at) as f:
        for group in ranges(entries):
            data = f.read_at(group[-1][2] + group[-1][3] - group[0][2], group[0][2])
            for _, _, offset, size in group:
                yield unpack(data[offset - group[0][2] : offset - group[0][2] + size])


def whole_file(path: str) -> bytes:
    fs, at = store(path)
    with fs.open_input_stream(at, compression=None) as f:
        return f.read()


def block(path: str, place: int, size: int) -> list[tuple]:
    fs, at = store(path)
    with fs.open_input_file(at) as f:
        return [tuple(e) for e in json.loads(zlib.decompress(f.read_at(size, place)))]


RECORD_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
RECORD_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records, through the index: each block of each directory, then the ranges of its entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for _, place, size in json.loads(whole_file(row["directory"])):
                    found = [r if payloads else (*r[:-1], None) for r in fetch(row["archive"], block(row["blocks"], place, size))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), RECORD_TYPES)], RECORD_NAMES)

    spread = manifest.select("part", "archive", "blocks", "directory").repartition(max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), "part")
    return spread.mapInArrow(run, RECORD)


class Index:
    """The directory of a part, with the block that was opened last."""

    def __init__(self, blocks: str, directory: str):
        self.blocks, self.directory = blocks, json.loads(whole_file(directory))
        self.keys, self.at, self.entries, self.own = [d[0] for d in self.directory], None, [], []

    def open(self, k: int) -> None:
        if self.at != k:
            self.at, self.entries = k, block(self.blocks, *self.directory[k][1:])
            self.own = [e[0] for e in self.entries]

    def matching(self, key: str) -> list[tuple]:
        """Entries of a key: the blocks that can hold it by binary search in the directory, then binary search in each."""
        out = []
        for k in range(max(bisect.bisect_left(self.keys, key) - 1, 0), bisect.bisect_right(self.keys, key)):
            self.open(k)
            out += self.entries[bisect.bisect_left(self.own, key) : bisect.bisect_right(self.own, key)]
        return out


def lookup(manifest: DataFrame, urls: DataFrame, url_col: str = "url", payloads: bool = True) -> DataFrame:
    """All captures of the wanted urls; a null url stands for pages without one.

    The wanted keys are joined to the parts whose key range holds them, and each part's keys are looked up in order by
    one task. The key ranges of the parts (a row for each part) are sent to all tasks.
    """
    spark = manifest.sparkSession
    parts = sorted((tuple(r) for r in manifest.select("first_key", "last_key", "part", "archive", "blocks", "directory").collect()))
    shared = spark.sparkContext.broadcast(parts)

    @F.pandas_udf("array<int>")
    def parts_of(wanted: pd.Series) -> pd.Series:
        firsts = [p[0] for p in shared.value]
        return wanted.map(lambda key: [i for i in range(max(bisect.bisect_left(firsts, key) - 1, 0), bisect.bisect_right(firsts, key)) if shared.value[i][1] >= key])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[int | None, Index | None] = (None, None)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                held: dict[int, tuple[list, set]] = {}
                for at, key, wanted in zip(*(c.to_pylist() for c in batch.slice(start, BLOCK).columns), strict=True):
                    if opened[0] != at:
                        opened = (at, Index(*shared.value[at][4:6]))
                    entries, exact = held.setdefault(at, ([], set()))
                    entries += opened[1].matching(key)
                    exact.update(map(one_line, wanted))
                for at, (entries, exact) in held.items():
                    found = (r if payloads else (*r[:-1], None) for r in fetch(shared.value[at][3], entries) if r[1] in exact)
                    while some := [*itertools.islice(found, 64)]:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), RECORD_TYPES)], RECORD_NAMES)

    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    wanted = urls.select(sort_key(url).alias("key"), url.alias("url")).distinct().groupBy("key").agg(F.collect_list("url").alias("wanted"))  # spellings of one key
    placed = wanted.select(F.explode(parts_of("key")).alias("at"), "key", "wanted")
    return placed.repartitionById(max(len(parts), 1), "at").sortWithinPartitions("at", "key").mapInArrow(run, RECORD)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = write(pages, f"{shared_dir(spark)}/bookflow/warc-{uuid.uuid4().hex}")
    return lookup(manifest, pages, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
