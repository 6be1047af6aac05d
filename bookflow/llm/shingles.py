"""SimHash near-duplicates at a stated similarity (operator 2 in the pipeline): texts that share at least SIMILAR of
their five-word shingles, by the exact Jaccard likeness of the whole sets.

Texts become sets of hashed shingles; equal sets are one node. Candidates come from ball hashing of the sets' SimHash
fingerprints (simhash.links) and, since two sets of likeness 0.8 differ in 9.7 of 64 bits on average and seldom in 4 or
fewer, from MinHash bands too: BANDS bands of ROWS minima, of which a pair of likeness 0.8 shares none with probability
(1 - 0.8^4)^20 = 0.00003, one of 0.9 with 10^-9.

No group is spread into all its pairs. The members of a bucket are first compared with its PIVOTS pivots only, members
from the middle of the group. Buckets that still hold several components (texts that share a common
passage, say) are finished exactly by prefix filtering: shingles are ordered from rare to frequent, sets of likeness 0.8
share one of their first fifth, and so only texts that share a rare shingle are compared.

Defined results: texts without words are one node; texts of fewer than six words are one shingle; ties, nulls, repeated
rows, long texts and other columns as in simhash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, written
from .components import components
from .simhash import keep_firsts, links, majority, shingle_hashes

#: Words of a shingle, and the least likeness of a link as a fraction.
SHINGLE, SIMILAR = 5, (4, 5)
BANDS, ROWS, SEED = 20, 4, 42
#: Members of a bucket with which all its members are compared, and ways into which a bucket's rows are dealt.
PIVOTS, SALTS = 12, 8
#: Shingles hashed at once.
BLOCK = 2048

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
MIX = _random.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, SHINGLE, SEED)]))


def set_key(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes(), SEED)


def bands(found: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        made = found[None, at : at + BLOCK] * FACTORS[:, None]
        made += TERMS[:, None]
        np.minimum(least, made.min(axis=1), out=least)
    return (least.reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, set_key, n, fp, bands) of every row; fp is the SimHash fingerprint of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            sets = [shingles(t) for t in texts]
            keys = np.fromiter(map(set_key, sets), np.uint64, len(sets)).view(np.int64)
            each = [bands(s).view(np.int64) for s in sets]
            prints = np.fromiter((majority([s]) for s in sets), np.uint64, len(sets)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(np.concatenate(each)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(keys), pa.array([len(s) for s in sets], pa.int32()), pa.array(prints), lists], ["id", "text_key", "set_key", "n", "fp", "bands"])

    return chosen(df, id_col, text_col).mapInArrow(run, "id long, text_key long, set_key long, n int, fp long, bands array<long>")


def chosen(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def sets_of(rows: DataFrame) -> DataFrame:
    """(node, items): the shingles of rows (id, text, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "text"):
            sets = [shingles(t) for t in texts]
            keys = np.fromiter(map(set_key, sets), np.uint64, len(sets)).view(np.int64)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), lists], ["node", "items"])

    return rows.select("id", "text").mapInArrow(run, "node long, items array<long>").dropDuplicates(["node"])


def alike(shared: Column, a: Column, b: Column) -> Column:
    """Jaccard likeness of at least SIMILAR, in whole numbers."""
    return SIMILAR[1] * shared >= SIMILAR[0] * (a + b - shared)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are alike."""
    a, b = (sets.select(F.col("node").alias(x), F.col("items").alias(f"of_{x}")) for x in "uv")
    return pairs.join(a, "u").join(b, "v").filter(alike(F.size(F.array_intersect("of_u", "of_v")), F.size("of_u"), F.size("of_v"))).select("u", "v")


def ball_pairs(distinct: DataFrame) -> DataFrame:
    """Candidate pairs (u, v) of sets whose fingerprints ball hashing links."""
    prints = written(distinct.filter("n > 0").groupBy("fp").agg(F.min("node").alias("least")), "fingerprints")
    ends = links(prints.select("fp")).distinct()
    for x in "uv":
        ends = ends.join(prints.select(F.col("fp").alias(x), F.col("least").alias(f"of_{x}")), x)
    equal = distinct.filter("n > 0").join(prints, "fp").filter("node <> least").select(F.col("least").alias("u"), F.col("node").alias("v"))
    return ends.select(F.col("of_u").alias("u"), F.col("of_v").alias("v")).union(equal)


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").distinct()


def sized(n: str, m: str) -> Column:
    """Whether sets of these sizes can be alike: they share at most the smaller one."""
    return alike(F.least(n, m), F.col(n), F.col(m))


def divided(placed: DataFrame, pivots: bool = False) -> DataFrame:
    """Rows (band, value, node, n, central, root) of the buckets that hold several components, with the size of the bucket
    and, if wanted, its pivots: the most central member of each of PIVOTS classes of nodes."""
    member, own = F.struct("central", "node", "n"), F.pmod(F.xxhash64("node"), F.lit(PIVOTS))
    chosen_ = [F.array_compact(F.array(*(F.max(F.when(own == k, member)) for k in range(PIVOTS)))).alias("pivots")] if pivots else []
    # an aggregate first, so that a hot bucket is summed up before the shuffle; the rows then meet it in SALTS places
    buckets = placed.groupBy("band", "value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"), *chosen_).filter("lo <> hi").drop("lo", "hi")
    spread = buckets.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    dealt = placed.withColumn("salt", F.pmod(F.xxhash64("node", F.lit("salt")), F.lit(SALTS)).cast("int"))
    return dealt.join(spread, ["band", "value", "salt"]).drop("salt")


def prefixes(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(item, node, n, k, at, root, early): for each of the nodes (node, n, root) the shared ones of its rarest shingles.

    Sets that are alike share one of the first n - ceil(0.8 n) + 1 items in any order that is the same for all sets;
    here rare items come first. The smaller set of the two has it among its first n - ceil(8/9 n) + 1 (early), since two
    sets that are alike share at least 4/9 of their sizes together. Items of one set only are counted and left out;
    k items of a node are in other sets too, and `at` of them come before this one.
    """
    items = sets.join(nodes, "node").select("node", "n", "root", F.explode("items").alias("item"))
    shared = items.groupBy("item").agg(F.count("*").alias("uses")).filter("uses > 1")
    ranked = items.join(shared, "item").groupBy("node", "n", "root").agg(F.array_sort(F.collect_list(F.struct("uses", "item"))).alias("ranked"))

    def first(top: int, below: int) -> Column:
        length = F.col("n") - F.floor((F.col("n") * top + below - 1) / below) + 1
        return F.greatest(length - (F.col("n") - F.col("k")), F.lit(0)).cast("int")

    a, b = SIMILAR
    sizes = ranked.withColumn("k", F.size("ranked"))
    spread = sizes.select("node", "n", "k", "root", first(2 * a, a + b).alias("few"), F.posexplode(F.slice("ranked", F.lit(1), first(a, b))).alias("at", "x"))
    return spread.select("x.item", "node", "n", "k", "at", "root", (F.col("at") < F.col("few")).alias("early"))


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, root, s): each distinct shingle set with its component and the first row (by id, then text hash) that has it."""
    first = F.min(F.struct(F.col("id").isNull(), F.col("id").alias("near_id"), F.col("text_key").alias("near_key"))).alias("s")
    made = signatures(df, id_col, text_col).groupBy(F.col("set_key").alias("node")).agg(first, *(F.first(c).alias(c) for c in ("n", "fp", "bands")))
    distinct = written(made, "sets")

    close = written(ordered(ball_pairs(distinct)), "ball")
    spread = distinct.filter("n > 0").select("node", "n", F.posexplode("bands").alias("band", "value"))
    buckets = written(divided(spread.withColumn("root", F.col("node"))), "buckets")
    # a text in the middle of a group is in its largest buckets
    crowded = written(buckets.drop("size").join(buckets.groupBy("node").agg(F.sum("size").alias("central")), "node"), "crowded")
    met = crowded.select("node").union(close.select("u")).union(close.select("v")).distinct()
    needed = distinct.join(met, "node", "left_semi").select("s.near_id", "s.near_key")
    texts = chosen(df, id_col, text_col)
    sets = written(sets_of(texts.join(needed, texts["id"].eqNullSafe(needed["near_id"]) & (texts["text_key"] == needed["near_key"]))), "shingles")

    stars = divided(crowded, True).withColumn("pivot", F.explode("pivots")).select("node", "n", F.col("pivot.node").alias("other"), F.col("pivot.n").alias("m")).filter(sized("n", "m"))
    tried = written(ordered(close.union(stars.select("node", "other"))), "pairs")
    found = written(verified(tried, sets), "links")
    left = written(divided(rooted(crowded.drop("root"), components(found))).select("node", "n", "root").distinct(), "left")
    posts = written(prefixes(sets, left), "prefixes")
    mixed = posts.groupBy("item").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("item")
    posts = posts.join(mixed, "item")
    other = posts.filter("early").select("item", F.col("node").alias("v"), F.col("n").alias("m"), F.col("k").alias("j"), F.col("at").alias("v_at"), F.col("root").alias("other"))
    most = F.least("at", "v_at") + F.least(F.col("k") - F.col("at"), F.col("j") - F.col("v_at"))  # shared before, at and after this item
    pairs = posts.join(other, "item").filter("(n > m OR n = m AND node < v) AND root <> other").filter(alike(most, F.col("n"), F.col("m")))
    rest = written(ordered(pairs.select(F.col("node").alias("u"), "v")).join(tried, ["u", "v"], "left_anti"), "pairs")
    found = written(found.union(verified(rest, sets)), "links")
    return rooted(distinct.select("node", "s"), components(found))


def rooted(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that with the smallest id (and text hash); of equal rows one. All columns are kept."""
    best = groups(df, id_col, text_col).groupBy("root").agg(F.min("s").alias("s")).select("s.near_id", "s.near_key")
    return keep_firsts(df, written(best, "kept"), id_col, text_col)
