"""Document fingerprints (operator 10), by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is zero under a mask, a strict mask before the
normal size and a lax one after it (normalised chunking), and at the largest size at the latest. An insertion only
moves the boundaries near it, so the set of chunk digests is shift-resistant. The hash looks back WINDOW bytes and
chunks are small, so that texts of a line or two have several. A fingerprint is the set of distinct chunks, each a
40-bit digest with its bytes; as a string it holds them all, six bytes a chunk in base64, so that likeness can be
computed from the strings (parse()). Containment is the weight of the shared digests over the weight of one set.

Defined results: null and empty texts have an empty fingerprint; two empty fingerprints have likeness 1, an empty and a
non-empty one 0; equal texts have equal fingerprints; rows of equal doc_id follow each other in the order of a hash of
their texts; a null doc_id sorts after all others; the only row of a table is its own next document; very long texts are
chunked whole, in slices; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, table

#: Bytes of the smallest, normal and largest chunk, and bits of the strict and the lax mask.
SMALLEST, NORMAL, LARGEST, STRICT, LAX = 8, 20, 64, 5, 3
#: Bytes that the rolling hash looks back, and bytes of text hashed at once.
WINDOW, SLICE = 16, 1 << 20


def random_words(n: int, size: int, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(f"{name}{i}".encode(), digest_size=size).digest() for i in range(n)), f"<u{size}")


#: Random words for bytes: of the rolling hash, and of the digests with an odd factor for each place in a chunk.
GEAR, OF_BYTE, OF_PLACE = random_words(256, 2, "gear"), random_words(256, 8, "byte"), random_words(LARGEST, 8, "place") | np.uint64(1)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i-k]] << k over the last WINDOW bytes, by doubling the window four times."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width] << np.uint16(width)  # the right side is evaluated before the sum
    return h


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    n, strict, lax = len(data), [], []
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, n, SLICE):
        lead = min(at, WINDOW - 1)
        h = gear_hashes(raw[at - lead : at + SLICE])[lead:]
        zero = np.flatnonzero(h >> np.uint16(WINDOW - LAX) == 0)
        lax.append(zero + at + 1)
        strict.append(zero[h[zero] >> np.uint16(WINDOW - STRICT) == 0] + at + 1)
    strict, lax = (np.concatenate(x).tolist() if x else [] for x in (strict, lax))
    out, start, i, j = [], 0, 0, 0
    while n - start > SMALLEST:
        least, middle, most = start + SMALLEST, start + NORMAL, min(start + LARGEST, n)
        while i < len(strict) and strict[i] < least:
            i += 1
        if i < len(strict) and strict[i] < min(middle, most):
            start = strict[i]
        else:
            while j < len(lax) and lax[j] < middle:
                j += 1
            start = lax[j] if j < len(lax) and lax[j] < most else most
        out.append(start)
    if n > start:
        out.append(n)
    return out


def fingerprint(data: bytes) -> np.ndarray:
    """Sorted distinct chunks: digest (40 bits) and bytes (8 bits) of each."""
    ends = np.array(boundaries(data), np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    raw, out = np.frombuffer(data, np.uint8), []
    first = 0
    while first < len(ends):
        last = max(int(np.searchsorted(ends, starts[first] + SLICE, "right")), first + 1)
        a, sizes = starts[first:last], ends[first:last] - starts[first:last]
        place = np.arange(sizes.sum()) - np.repeat(a - a[0], sizes)
        h = np.add.reduceat(OF_BYTE[raw[a[0] : ends[last - 1]]] * OF_PLACE[place], a - a[0])
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        out.append((h >> np.uint64(24) << np.uint64(8)) | sizes.astype(np.uint64))
        first = last
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def weight(found: np.ndarray) -> int:
    return int((found & np.uint64(0xFF)).sum())


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the weight of a that b has too."""
    if not len(a):
        return float(not len(b))
    return weight(np.intersect1d(a, b, assume_unique=True)) / weight(a)


def digest(found: np.ndarray) -> str:
    """The text form of a fingerprint."""
    return base64.b64encode(found.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def parse(text: str) -> np.ndarray:
    """The fingerprint of a text form."""
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (2, 0))).reshape(-1).view(">u8").astype(np.uint64)


def chunk_sets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digests array<long>, sizes array<int>): the fingerprint of every row, for joins on digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            found = [fingerprint(t.encode()) for t in texts]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32())
            flat = np.concatenate(found)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((flat >> np.uint64(8)).astype(np.int64), (flat & np.uint64(0xFF)).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["id", "digests", "sizes"])

    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "id long, digests array<long>, sizes array<int>").withColumnRenamed("id", id_col)


def bounds(chosen: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of the ids into about n ranges, and the number of parts of each range.

    An id that holds more than the rows of half a part (at most 2 n ids can, the null id among them) is a range by
    itself, divided by the hash of its texts.
    """
    got = chosen.agg(F.count("*").alias("rows"), F.count("id").alias("known"), F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n).alias("cuts")).first()
    share = max(got["rows"] / n, 1.0)
    hot = chosen.groupBy("id").count().filter((F.col("count") > share / 2) & (F.col("count") > 1) & F.col("id").isNotNull()).collect()
    cuts = sorted({*(got["cuts"] or []), *(r["id"] for r in hot), *(r["id"] - 1 for r in hot if r["id"] > -(1 << 63))})
    ways = np.ones(len(cuts) + 2, np.int64)  # the first range is that of null ids
    ways[0] = -(-(got["rows"] - got["known"]) // share) or 1
    for r in hot:
        ways[1 + int(np.searchsorted(cuts, r["id"]))] = -(-r["count"] // share)
    return np.array(cuts, np.int64), ways


def neighbours(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, halo, id, h, text) dealt by ranges of id, for one pass over each part in descending order.

    The bounds of the ranges are quantiles of all ids, so a row's part is a function of its id (and text hash) alone. The
    row that follows a part's last one, which is the first of the next part, is sent along as its halo.
    """
    spark = df.sparkSession
    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    cuts, ways = bounds(chosen, n)
    begin = np.cumsum(ways) - ways

    @F.pandas_udf("int")
    def part_of(ids: pd.Series, h: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        at = np.where(known, np.searchsorted(cuts, ids.fillna(0).astype("int64")) + 1, 0)
        # of equal ids the smallest hash comes first, in the last part of their range
        turn = ((h.to_numpy() >> 31) * ways[at]) >> 32
        return pd.Series(begin[at] + ways[at] - 1 - turn, dtype="int32")

    placed = chosen.withColumn("part", part_of("id", "h"))
    first = F.max(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("order"), (-F.col("h")).alias("h"), "id")).alias("first")
    firsts = placed.groupBy("part").agg(first).select("part", "first.id", (-F.col("first.h")).alias("h")).orderBy(F.desc("part")).collect()  # a row for each part
    number = {r["part"]: len(firsts) - 1 - k for k, r in enumerate(firsts)}
    sent = spark.createDataFrame([(r["part"], r["id"], r["h"], firsts[k - 1]["part"]) for k, r in enumerate(firsts)], "of int, first long, first_h long, to int")
    met = (F.col("part") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")) & (F.col("h") == F.col("first_h"))
    placed = placed.join(F.broadcast(sent), met, "left")
    copies = F.array_compact(F.array(F.struct(F.col("part"), F.lit(0).alias("halo")), F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("part"), F.lit(1).alias("halo")))))
    dealt = placed.select("id", "text", "h", F.explode(copies).alias("c")).select("c.part", "c.halo", "id", "h", "text")
    # parts have numbers without gaps, so every part is a task of its own
    task = F.element_at(F.create_map(*(F.lit(x) for kv in number.items() for x in kv)), F.col("part")) if number else F.lit(0)
    return dealt.repartitionById(max(len(number), 1), task).sortWithinPartitions("part", "halo", F.desc_nulls_last("id"), "h", "text")


def compare_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row and of its text with the last half taken from the next row (descending id)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int | None, int, str]]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                yield from zip(*(c.to_pylist() for c in whole.slice(at, 64).columns), strict=True)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
        """(id, text, next text); only the first halo row of a part counts."""
        last, ended = None, None
        for part, halo, i, _, text in rows(batches):
            if last and last[0] == part:
                yield last[1], last[2], text
            if halo:
                last, ended = None, part
            elif ended != part:
                last = (part, i, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held, ahead = [], (None, None)
        for i, text, after in pairs(batches):
            half = len(text) // 2
            edited = (text[: len(text) - half] + after[:half]).encode()
            own = ahead[1] if ahead[0] == text else fingerprint(text.encode())
            other, new = fingerprint(after.encode()), fingerprint(edited)
            ahead = (after, other)
            held.append((i, len(text), hashlib.sha256(edited).hexdigest(), digest(own), digest(new), containment(own, new), containment(own, other)))
            if len(held) == 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    found = neighbours(df, id_col, text_col).mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return found.withColumnRenamed("id", id_col)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_next(table(spark, sf_dir, "documents"))
