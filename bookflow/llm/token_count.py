"""Token counts (operator 8), by rank-synchronous array merging.

The pre-tokens of a batch that are new are held as one ragged array of symbols. In each round the lowest-rank pair of
every sequence is found and all its places in that sequence are merged at the same time; a sequence without a known
pair is finished. The count is the number of symbols that survive. Counts of pre-tokens are kept in a bounded cache.
A sequence of more than LONG symbols keeps its places by rank, so that a round touches only the places that it merges
and their neighbours: all rounds together take about linear time.

Defined results: null and empty texts have 0 bytes and 0 tokens; a special string inside a text is one token, as the
library's default has it; repeated rows give repeated rows; an empty table gives no rows; other columns are ignored.
Very long texts are handled in segments that end where a pre-token ends.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pretoken
from .common import blocks, pieces, table

CACHE_ENTRIES, CACHE_CHARS = 300_000, 48
#: Code points counted at once: the rounds of many sequences cost little more than those of few.
CHARS = 1 << 19
#: Symbols of the longest sequence that is merged together with others.
LONG = 512


@lru_cache(1)
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Counter(dict):
    """Pre-token to its number of tokens, with the tables for merging."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pairs, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"] if not t["normalized"]]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of the pairs in the sorted table of pairs, or the table's length where a pair isn't known."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, at, len(self.pairs))

    def count_long(self, raw: bytes) -> int:
        """Number of tokens of one long pre-token."""
        symbol = self.of_byte[np.frombuffer(raw, np.uint8)]
        n, none = len(symbol), len(self.pairs)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        pair = np.append(self.ranks(symbol[:-1], symbol[1:]), none)  # the pair that starts at each place; none at dead ones
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[tuple[int, int]] = []

        def put(places: np.ndarray) -> None:
            places = places[pair[places] < none]
            places = places[np.argsort(pair[places], kind="stable")]
            for part in np.split(places, np.flatnonzero(np.diff(pair[places])) + 1) if len(places) else []:
                k = int(pair[part[0]])
                if k not in waiting:
                    heapq.heappush(heap, (int(self.rank[k]), k))
                waiting.setdefault(k, []).append(part)

        put(np.arange(n))
        gone = 0
        while heap:
            _, k = heapq.heappop(heap)
            hit = np.unique(np.concatenate(waiting.pop(k)))
            hit = hit[pair[hit] == k]
            if not len(hit):
                continue
            run = np.flatnonzero(np.append(True, after[hit[:-1]] != hit[1:]))  # in a run of overlapping places each second one merges
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
            right = after[hit]
            symbol[hit], pair[right], after[hit] = self.made[k], none, after[right]
            follows = after[hit] < n
            before[after[hit][follows]] = hit[follows]
            gone += len(hit)
            near = before[hit]
            changed = np.unique(np.concatenate([hit, near[near >= 0]]))
            ends = after[changed] >= n
            pair[changed] = np.where(ends, none, self.ranks(symbol[changed], symbol[np.where(ends, 0, after[changed])]))
            put(changed)
        return n - gone

    def count_new(self, found: list[str]) -> np.ndarray:
        """Numbers of tokens of distinct pre-tokens, by rounds of simultaneous merges."""
        raw = [t.encode() for t in found]
        long = [i for i, r in enumerate(raw) if len(r) > LONG]
        apart = [self.count_long(raw[i]) for i in long]
        for i in long:
            raw[i] = b""
        counts = self.count_together(raw) if any(raw) else np.zeros(len(raw), np.int64)
        counts[long] = apart
        return counts

    def count_together(self, raw: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbol = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(raw)), sizes)
        counts = sizes.copy()
        none = len(self.pairs)
        while len(symbol) > 1:
            key = symbol[:-1] * self.width + symbol[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), none - 1)
            rank = np.where((self.pairs[at] == key) & (owner[:-1] == owner[1:]), self.rank[at], none)
            firsts = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.minimum.reduceat(np.append(rank, none), firsts)
            open_ = lowest < none
            if not open_.any():
                break
            group = np.cumsum(np.diff(owner, prepend=owner[0]) != 0)
            hit = np.flatnonzero((rank == lowest[group[:-1]]) & (rank < none))
            run = np.flatnonzero(np.diff(hit, prepend=-2) != 1)  # in a run of overlapping places each second one merges
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))) % 2 == 0]
            symbol[hit] = self.made[at[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            counts -= np.bincount(owner[hit], minlength=len(counts))
            keep &= open_[group]  # finished sequences leave the array
            symbol, owner = symbol[keep], owner[keep]
        return counts

    def counts(self, found: list[str]) -> np.ndarray:
        new = [*(set(found) - self.keys())]
        if new:
            if len(self) + len(new) > CACHE_ENTRIES:
                self.clear()
                new = [*set(found)]
            self.update(zip(new, self.count_new(new).tolist()))
        out = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        for t in new:
            if len(t) > CACHE_CHARS:
                del self[t]
        return out


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def split_special(text: str, special: list[str]) -> tuple[list[str], int]:
    """Parts between special strings, and how many of these there are; the leftmost, then the longest, wins."""
    parts = re.split("|".join(map(re.escape, sorted(special, key=len, reverse=True))), text)
    return parts, len(parts) - 1


def count_texts(texts: list[str], path: str) -> np.ndarray:
    c = counter(path)
    total = np.zeros(len(texts), np.int64)
    flat, owner = texts, np.arange(len(texts))
    if c.special and any(s in t for s in c.special for t in texts):
        cut = [split_special(t, c.special) for t in texts]
        total += np.array([n for _, n in cut], np.int64)
        flat, owner = [p for x, _ in cut for p in x], np.repeat(owner, [len(x) for x, _ in cut])
    for owners, parts in blocks(flat, CHARS):
        found, per_part = pretoken.tokens(parts)
        if found:
            total += np.bincount(np.repeat(owner[owners], per_part), c.counts(found), minlength=len(texts)).astype(np.int64)
    return total


def count(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row; no shuffle."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text", CHARS):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(count_texts(texts, path))], ["id", "n_bytes", "n_tokens"])

    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "id long, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


def op8(spark: SparkSession, sf_dir: str, limit: int = 1024) -> DataFrame:
    return count(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > limit)
