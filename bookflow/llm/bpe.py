"""Byte-level BPE encoding and decoding (operator 1).

encode(): every text becomes token ids and the byte offset of each token. Boundaries come from pretoken.tokens(); each
distinct pre-token is merged once and kept in a bounded cache. decode(): ids become bytes again, placed by the offsets.
digests(): both in one pass over the texts, giving digests of the ids and of what they decode to.

Defined results: null and empty texts have no tokens and decode to empty bytes; null ids stay null; repeated rows give
repeated rows; an empty table gives no rows; other columns of the input are ignored. Very long texts are handled in
segments that end where a pre-token ends, so the arrays in work are bounded unless a single pre-token is longer.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pretoken
from .common import blocks, pieces, table

#: Pre-tokens kept by each Python worker, and the longest one kept.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 48
#: Bytes of the longest pre-token whose pairs are searched through at each merge; a heap serves longer ones.
FEW = 64
#: Tokens placed at once in decoding.
SLICE = 1 << 17


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    return os.environ.get("BOOKFLOW_BPE_RANKS") or public_tokenizers.path(name)


@lru_cache(2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_few(piece: bytes, by: dict[bytes, int]) -> list[int]:
    """As merge(), by a search for the lowest rank at each step."""
    none = 1 << 60  # above all ranks
    cuts = [*range(len(piece) + 1)]
    waiting = [by.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while waiting and (low := min(waiting)) < none:
        i = waiting.index(low)
        del cuts[i + 1], waiting[i]
        if i < len(waiting):
            waiting[i] = by.get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            waiting[i - 1] = by.get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [by[piece[a:b]] for a, b in zip(cuts[:-1], cuts[1:])]


def merge(piece: bytes, by: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest rank merges first, the leftmost of equals; a heap keeps long ones fast."""
    if piece in by:
        return [by[piece]]
    n = len(piece)
    if n <= FEW:
        return merge_few(piece, by)
    start, after, before = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
    stop = list(range(1, n + 1))
    alive = [True] * n
    heap = [(by[pair], i, i + 2) for i in range(n - 1) if (pair := piece[i : i + 2]) in by]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or stop[j] != end:
            continue
        stop[i], alive[j], after[i] = end, False, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := by.get(piece[start[i] : stop[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop[after[i]]))
        if (p := before[i]) >= 0 and (r := by.get(piece[start[p] : end])) is not None:
            heapq.heappush(heap, (r, p, end))
    return [by[piece[i : stop[i]]] for i in range(n) if alive[i]]


class Merged(dict):
    """Pre-token to its ids as packed int32."""

    def __init__(self, path: str):
        super().__init__()
        self.by = ranks(path)

    def __missing__(self, token: str) -> bytes:
        packed = np.array(merge(token.encode(), self.by), np.int32).tobytes()
        if len(token) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[token] = packed
        return packed


@lru_cache(2)
def merged(path: str) -> Merged:
    return Merged(path)


@lru_cache(2)
def symbols(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes end to end, where each starts and how long it is."""
    by = ranks(path)
    listed = [b""] * (max(by.values()) + 1)
    for token, rank in by.items():
        listed[rank] = token
    sizes = np.fromiter(map(len, listed), np.int64, len(listed))
    return np.frombuffer(b"".join(listed), np.uint8), np.cumsum(sizes) - sizes, sizes


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def encode_parts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and byte offsets of all tokens of the texts, end to end; the number of tokens and of bytes of each text."""
    cache = merged(path)
    sizes = symbols(path)[2]
    found, per_text = pretoken.tokens(texts)
    at, packed = 0, []
    for n in per_text.tolist():
        packed.append(b"".join(map(cache.__getitem__, found[at : at + n])))
        at += n
    counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    ids = np.frombuffer(b"".join(packed), np.int32)
    ends = np.concatenate([[0], np.cumsum(sizes[ids])])
    last = np.cumsum(counts)
    base = ends[last - counts]
    return ids, (ends[:-1] - np.repeat(base, counts)).astype(np.int32), counts, ends[last] - base


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and byte offsets of all tokens of the texts, end to end, and the number of tokens of each text."""
    ids, offsets, counts, done = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for owners, parts in blocks(texts):
        own, places, n, size = encode_parts(parts, path)
        ids.append(own)
        offsets.append(places + np.repeat(done[owners], n).astype(np.int32))
        counts[owners] += n
        done[owners] += size
    return np.concatenate(ids), np.concatenate(offsets), counts


def decode_ids(ids: np.ndarray, offsets: np.ndarray, counts: np.ndarray, path: str) -> list[bytes]:
    """Bytes of each text; every token's bytes go to its offset."""
    data, starts, sizes = symbols(path)
    last = np.cumsum(counts) - 1
    totals = np.where(counts > 0, offsets[last] + sizes[ids[last]], 0) if len(ids) else np.zeros(len(counts), np.int64)
    bases = np.cumsum(totals) - totals
    out = np.empty(int(totals.sum()), np.uint8)
    text_of = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    for at in range(0, len(ids), SLICE):
        own, lengths = ids[at : at + SLICE], sizes[ids[at : at + SLICE]]
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(bases[text_of[at : at + SLICE]] + offsets[at : at + SLICE], lengths) + within] = data[np.repeat(starts[own], lengths) + within]
    return [out[a : a + n].tobytes() for a, n in zip(bases.tolist(), totals.tolist())]


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, verify: bool = False) -> DataFrame:
    """(id, ids array<int>, offsets array<int>) of every row; no shuffle.

    With verify also decoded_sha256 string, the digest of the bytes that the ids decode to, made in the same pass.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            ids, offsets, counts = encode_texts(texts, path)
            columns = {"id": part.column(0), "ids": list_array(ids, counts), "offsets": list_array(offsets, counts)}
            if verify:
                columns["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decode_ids(ids, offsets, counts, path)])
            yield pa.RecordBatch.from_pydict(columns)

    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"id long, ids array<int>, offsets array<int>{', decoded_sha256 string' if verify else ''}").withColumnRenamed("id", id_col)


def decode(df: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """Adds `decoded` (binary) to rows with ids and offsets; keeps the columns named."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.asarray(whole.column(whole.schema.get_field_index("ids")).value_lengths().fill_null(0))
            # rows are cut so that each part has about SLICE tokens
            cuts = np.unique(np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()) + SLICE, SLICE), "right")).tolist() if len(sizes) else []
            for a, b in zip([0, *cuts], [*cuts, whole.num_rows]):
                if a == b:
                    continue
                batch = whole.slice(a, b - a)
                ids, offsets = (batch.column(batch.schema.get_field_index(x)) for x in ("ids", "offsets"))
                texts = decode_ids(np.asarray(ids.flatten()), np.asarray(offsets.flatten()), np.asarray(ids.value_lengths().fill_null(0)), path)
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in keep), pa.array(texts, pa.binary())], [*keep, "decoded"])

    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return df.select(*dict.fromkeys([*keep, "ids", "offsets"])).mapInArrow(run, f"{fields}, decoded binary")


def digests_of(texts: list[str], path: str) -> tuple[list[int], list[str], list[str]]:
    """Number of tokens, digest of the ids in decimal and digest of the decoded bytes of each text."""
    n = [0] * len(texts)
    of_ids, of_bytes = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
    for owners, parts in blocks(texts):
        ids, offsets, counts, _ = encode_parts(parts, path)
        at = 0
        for k, size, raw in zip(owners.tolist(), counts.tolist(), decode_ids(ids, offsets, counts, path), strict=True):
            of_ids[k].update((" " if n[k] and size else "").encode() + " ".join(map(str, ids[at : at + size].tolist())).encode())
            of_bytes[k].update(raw)
            n[k], at = n[k] + size, at + size
    return n, [h.hexdigest() for h in of_ids], [h.hexdigest() for h in of_bytes]


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded again in one pass; no shuffle."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            n, of_ids, of_bytes = digests_of(texts, path)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
