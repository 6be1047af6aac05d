"""SimHash near-duplicates (operator 2), by meet-in-the-middle ball hashing.

Two fingerprints within distance 2r meet in a common variant within r of each, so every distinct fingerprint emits all
variants within r = 2 bits (2,081 of 64-bit words) and equal variants meet. The shuffle on variants is by their first
`route` bits: a fingerprint goes once to each prefix that one of its variants has (79 for 12 bits), and the variants
themselves are made, met and deduplicated where they are needed, in blocks of at most VARIANTS_AT_ONCE. (Sending each of
the 2,081 variants by itself would be some 15 times the input.) All fingerprints of a variant are within 4 bits of each
other; each group gives the links from its smallest member, which are verified and joined in a union-find array of the
prefix, so links inside a component that is known already are never kept, and a block whose fingerprints are one
component already isn't made at all. A task sends on a forest only.

Defined results: null, empty and blank texts have fingerprint 0 and link like any other; a null doc_id takes part but
never names a component unless it is alone; repeated rows are repeated; ties of rows for the one that stays are broken
by id, then by text hash; very long texts are hashed whole, in blocks; an empty table gives no rows; other columns are
carried along or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, pieces, table, unused, written
from .components import components, with_least

#: Words of a shingle, seed of the hash, bits that may differ in a link.
SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Variants made at once in a task; a prefix with more is divided by further bits.
VARIANTS_AT_ONCE = 1 << 18
#: Fingerprints that a prefix should have on average; it sets the number of routing bits.
PER_PREFIX = 1 << 19
LEAST_ROUTE = 12
#: Shingles hashed at once.
BLOCK = 1 << 16

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BITS = np.arange(63, -1, -1, dtype=np.uint64)


def shingle_hashes(text: str, shingle: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of words, repeats included, in blocks; nothing for a text without words."""
    words = text.encode().translate(LOWER).split()  # at the six ASCII white-space bytes
    if not words:
        return
    joined = b" ".join(words)
    if len(words) <= shingle:
        yield np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n, ends = len(words) - shingle + 1, ends[shingle - 1 :]
    for at in range(0, n, BLOCK):
        cuts = zip(starts[at : min(at + BLOCK, n)].tolist(), ends[at : at + BLOCK].tolist())
        yield np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in cuts), np.uint64, min(BLOCK, n - at))


def majority(hashes: Iterable[np.ndarray]) -> int:
    """The word whose bits are set in over half the hashes."""
    n, set_bits = 0, np.zeros(64, np.int64)
    for h in hashes:
        n += len(h)
        set_bits += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.sum((2 * set_bits > n).astype(np.uint64) << BITS, dtype=np.uint64))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long, text_key long); fp holds the 64 bits, text_key tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            found = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64)), part.column(2)], ["id", "fp", "text_key"])

    text = F.col(text_col).cast("string")
    chosen = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return chosen.mapInArrow(run, "id long, fp long, text_key long").withColumnRenamed("id", id_col)


@lru_cache(256)
def masks(bits: int, flips: int) -> np.ndarray:
    """All words of `bits` bits with at most `flips` (0 to 2) set."""
    one = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    parts = [np.zeros(1, np.uint64)]
    if flips >= 1:
        parts.append(one)
    if flips >= 2:
        i, j = np.triu_indices(bits, 1)
        parts.append(one[i] | one[j])
    return np.concatenate(parts)


class Forest:
    """Union-find over n nodes as an array: every node's label is the smallest node known to be linked with it."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the components of a[i] and b[i]; links within a component are left out at once."""
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that aren't their component's smallest, with it."""
        rest = np.flatnonzero(self.label != np.arange(len(self.label)))
        return self.label[rest], rest


def meet(fps: np.ndarray, own: np.ndarray, forest: Forest, prefix: int, bits: int) -> None:
    """Joins those of the fingerprints `own` (places in fps) that share a variant with the given prefix of so many bits."""
    rest = 64 - bits
    flips = np.bitwise_count((fps[own] >> np.uint64(rest) if rest < 64 else np.zeros(len(own), np.uint64)) ^ np.uint64(prefix)) if bits else np.zeros(len(own), np.uint8)
    own, flips = own[flips <= 2], flips[flips <= 2]
    if len(own) < 2 or (forest.label[own] == forest.label[own[0]]).all():
        return
    sizes = [len(masks(rest, 2 - k)) for k in range(3)] if rest else [1, 1, 1]
    if rest and int((np.bincount(flips, minlength=3) * sizes).sum()) > VARIANTS_AT_ONCE:
        for bit in (0, 1):
            meet(fps, own, forest, prefix << 1 | bit, bits + 1)
        return
    made, owners = [], []
    low = np.uint64((1 << rest) - 1)
    for k in range(3):
        some = own[flips == k]
        m = masks(rest, 2 - k) if rest else np.zeros(1, np.uint64)
        made.append(((fps[some] & low)[:, None] ^ m).ravel())
        owners.append(np.repeat(some, len(m)))
    variant, owner = np.concatenate(made), np.concatenate(owners)
    order = np.argsort(variant, kind="stable")
    variant, owner = variant[order], owner[order]
    same = np.flatnonzero(variant[1:] == variant[:-1])
    a, b = owner[same], owner[same + 1]  # neighbours of a group: a path, so the group is joined whole
    near = np.bitwise_count(fps[a] ^ fps[b]) <= DISTANCE
    forest.join(a[near], b[near])


def routes(fp: str, bits: int) -> F.Column:
    """Prefixes of so many bits that variants of a fingerprint have."""
    own = F.shiftrightunsigned(F.col(fp), 64 - bits)
    return F.transform(F.array(*(F.lit(int(m)) for m in masks(bits, 2))), lambda m: own.bitwiseXOR(m))


def links(distinct: DataFrame) -> DataFrame:
    """(u, v) long: links that have the components of all links of distinct fingerprints (column fp); a forest for each prefix."""
    n, bits = distinct.count(), LEAST_ROUTE
    while bits < 40 and n * len(masks(bits, 2)) / 2**bits > PER_PREFIX:
        bits += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prefix, fps in by_prefix(batches):
            fps = np.sort(fps)
            forest = Forest(len(fps))
            meet(fps, np.arange(len(fps)), forest, prefix, bits)
            low, high = (fps[x].view(np.int64) for x in forest.links())
            for at in range(0, len(low), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(low[at : at + (1 << 16)]), pa.array(high[at : at + (1 << 16)])], ["u", "v"])

    routed = distinct.select("fp", F.explode(routes("fp", bits)).alias("prefix"))
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return routed.repartition(tasks, "prefix").sortWithinPartitions("prefix").mapInArrow(run, "u long, v long")


def by_prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """The fingerprints of each prefix, from batches sorted by prefix."""
    now, held = None, []
    for batch in batches:
        fps, prefix = (np.asarray(batch.column(batch.schema.get_field_index(x))) for x in ("fp", "prefix"))
        cuts = [0, *(np.flatnonzero(np.diff(prefix)) + 1).tolist(), len(prefix)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if prefix[a] != now:
                if held:
                    yield int(now), np.concatenate(held)
                now, held = prefix[a], []
            held.append(fps[a:b].view(np.uint64))
    if held:
        yield int(now), np.concatenate(held)


def cluster(prints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds component_id, the smallest id reachable over links, and group, a name of the component, to rows (id, fp, ...).

    The rows should be a written table.
    """
    distinct = written(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    members = components(links(distinct.select("fp")))
    placed = members.join(distinct, members["node"] == distinct["fp"]).select(F.col("root").alias("u"), F.col("node").alias("v"), "least")
    low = placed.groupBy("u").agg(F.min("least").alias("low"))
    best = written(low.join(distinct, low["u"] == distinct["fp"]).select("u", F.least("low", "least").alias("m")), "best")
    moved = with_least(placed.select("u", "v"), best).select(F.col("v").alias("fp"), "m", "u").union(best.select(F.col("u").alias("fp"), "m", "u"))
    found = written(distinct.join(moved, "fp", "left").select("fp", F.coalesce("m", "least").alias("component_id"), F.coalesce("u", "fp").alias("group")), "places")
    for done in (distinct, members, best):
        discard(done)
    return prints.join(found, "fp")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, text_key, component_id, group) of every row."""
    return cluster(written(fingerprints(df, id_col, text_col), "prints"), id_col)


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that with the smallest id (and text hash); of equal rows one. All columns are kept."""
    first = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("near_id"), F.col("text_key").alias("near_key"))).alias("s")
    best = written(near_duplicates(df, id_col, text_col).groupBy("group").agg(first).select("s.near_id", "s.near_key"), "kept")
    return keep_firsts(df, best, id_col, text_col)


def keep_firsts(df: DataFrame, best: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of df named by (near_id, near_key), id and text hash; of equal rows one."""
    of_id, of_key, own = unused(df, "near_id", "near_key", "near_text")
    best = best.select(F.col("near_id").alias(of_id), F.col("near_key").alias(of_key))
    # rows to the same place by id and text hash; equal rows then meet without another shuffle
    joined = df.withColumn(own, F.xxhash64(F.col(text_col).cast("string"))).join(best, (F.col(id_col).cast("long").eqNullSafe(F.col(of_id))) & (F.col(own) == F.col(of_key)))
    return joined.dropDuplicates([of_id, of_key]).select(*df.columns)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
