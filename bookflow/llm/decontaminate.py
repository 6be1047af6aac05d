"""Benchmark decontamination (operator 4), by spaced-seed hashing; DataFrame functions only.

A mask keeps some of the words of a window and ignores the others, so a window still matches when ignored words were
substituted. All windows of the items and of the texts are hashed under each mask and joined. A hit fixes how an item
lies along a text; on that diagonal the words are compared one by one, and the best stretch (+1 for each equal word,
-1 for each other) must reach LEAST. The two masks were chosen together: of stretches with random substitutions that
reach LEAST they find 99.9 % and at least 99 % at every length and rate tried (tests/llm/test_decontaminate.py), among
them every text with each third, fourth or fifth word replaced.

Items of fewer than LEAST words must stand there whole: those of SHORT words or more anywhere in a text (found by a
third mask of SHORT adjacent words, which is used only if there are such items), shorter ones as the whole text.

The join's item side is broadcast only where a count shows at most BROADCAST_SEEDS of its rows. Beyond, a bitmap of at
most BITS bits (128 MB) of the items' seeds is broadcast instead, and only windows whose bit is set are shuffled; both
ways give the same rows. Texts take part in one later join, with the texts that have hits.

Defined results: null and empty texts and items match nothing; rows of equal id and text count once; a null doc_id is
reported as null; equal items are each reported; of equally good stretches the earliest, then the longest counts;
repeated words are compared on every diagonal they hit; very long texts are hashed whole; an empty table gives no
rows; other columns are ignored by overlaps() and kept by clean(), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, unused, written

#: Places within a window that each mask keeps.
MASKS = ((0, 2, 3, 6, 8), (0, 1, 2, 3, 5))
LEAST, SHORT = 10, 5
BROADCAST_SEEDS = 2_000_000
#: Bits of the bitmap of seeds, and of one of its rows (fixed by Spark's bitmap functions).
BITS, ROW_BITS = 1 << 30, 1 << 15


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def seed_of(k: int, mask: tuple[int, ...]):
    return lambda i: F.xxhash64(F.lit(k), *(F.get("codes", i + o) for o in mask))


def seeds(df: DataFrame, keep: list[str], masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """A row (keep..., n_words, place, seed) for each window and mask of column `words`, and one for a text of fewer than SHORT words."""
    hashed = df.select(*keep, F.size("words").alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("codes"))
    none = F.array().cast("array<bigint>")
    arrays, before, place = [], F.lit(0), F.lit(0)
    for k, mask in enumerate(masks):
        count = F.greatest(F.col("n_words") - mask[-1], F.lit(0))
        arrays.append(F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), seed_of(k, mask))).otherwise(none))
        place = F.when(F.col("at") >= before, F.col("at") - before).otherwise(place)
        before = before + count
    whole = F.when(F.col("n_words").between(1, SHORT - 1), F.array(F.xxhash64(F.lit(-1), "codes"))).otherwise(none)
    place = F.when(F.col("at") >= before, F.lit(0)).otherwise(place)
    spread = hashed.select(*keep, "n_words", F.posexplode(F.concat(*arrays, whole)).alias("at", "seed"))
    return spread.select(*keep, "n_words", place.cast("int").alias("place"), "seed")


def likely(text_seeds: DataFrame, item_seeds: DataFrame) -> DataFrame:
    """The rows whose seed may be one of the items', by a bitmap that is broadcast: at most BITS / ROW_BITS rows of 4 KB."""
    bit = F.pmod("seed", F.lit(BITS))
    row, at = F.floor(bit / ROW_BITS).cast("int"), (bit % ROW_BITS).cast("int")
    bitmap = item_seeds.select(row.alias("bit_row"), at.cast("long").alias("bit_at")).distinct().groupBy("bit_row").agg(F.bitmap_construct_agg("bit_at").alias("bits"))
    byte = F.conv(F.hex(F.substr("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    joined = text_seeds.join(F.broadcast(bitmap), row == F.col("bit_row"))
    return joined.filter(byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), at % 8 + 1)) != 0).drop("bit_row", "bits")


def best_stretch(equal: Column) -> Column:
    """The maximal-scoring segment of an array of booleans."""
    zero = F.lit(0)
    start = F.struct(zero.alias("best"), zero.alias("run"), zero.alias("begin"), zero.alias("at"), zero.alias("first"), zero.alias("last"))

    def step(a: Column, same: Column) -> Column:
        run = F.greatest(a["run"] + F.when(same, 1).otherwise(-1), zero)
        begin = F.when(a["run"] > 0, a["begin"]).otherwise(a["at"])
        better = run > a["best"]
        return F.struct(
            F.greatest(a["best"], run).alias("best"), run.alias("run"), begin.alias("begin"), (a["at"] + 1).alias("at"),
            F.when(better, begin).otherwise(a["first"]).alias("first"), F.when(better, a["at"]).otherwise(a["last"]).alias("last"),
        )

    return F.aggregate(equal, start, step)


def stretches(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str) -> DataFrame:
    """(doc, text_key, item, s): the best stretch of each diagonal that has one; s orders stretches."""
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    known = items.select(F.col(item_col).alias("item"), words_of(F.col(text_col).cast("string")).alias("item_words")).withColumn("item_key", F.xxhash64("item", "item_words")).dropDuplicates(["item", "item_key"])
    known = written(known.filter(F.size("item_words") > 0), "items")
    brief = not known.filter(F.size("item_words").between(SHORT, LEAST - 1)).isEmpty()
    masks = (*MASKS, tuple(range(SHORT))) if brief else MASKS
    item_seeds = seeds(known.withColumnRenamed("item_words", "words"), ["item_key"], masks).select("item_key", F.col("n_words").alias("item_n"), F.col("place").alias("item_place"), "seed").distinct()
    small = item_seeds.count() <= BROADCAST_SEEDS
    bounded = (lambda x: F.broadcast(x)) if small else (lambda x: x)

    text_seeds = seeds(texts.select("doc", "text_key", words_of(F.col("text")).alias("words")), ["doc", "text_key"], masks)
    text_seeds = text_seeds if small else likely(text_seeds, item_seeds)
    met = text_seeds.join(bounded(item_seeds), "seed").select("doc", "text_key", "item_key", "item_n", (F.col("place") - F.col("item_place")).alias("diagonal")).distinct()
    by_text = written(met.groupBy("doc", "text_key").agg(F.collect_list(F.struct("item_key", "item_n", "diagonal")).alias("met")), "hits")

    same = texts["doc"].eqNullSafe(by_text["doc"]) & (texts["text_key"] == by_text["text_key"])
    rows = texts.join(by_text, same).select(texts["doc"], texts["text_key"], words_of(texts["text"]).alias("words"), F.explode("met").alias("met"))
    begin = F.greatest(F.col("met.diagonal"), F.lit(0))
    aligned = rows.select("doc", "text_key", "met.item_key", "met.diagonal", F.size("words").alias("n_words"), F.slice("words", begin + 1, F.least(F.size("words"), F.col("met.diagonal") + F.col("met.item_n")) - begin).alias("part"))
    compared = aligned.join(bounded(known), "item_key").select(
        "doc", "text_key", "item", "diagonal", "n_words", F.size("item_words").alias("item_n"), F.zip_with("part", F.slice("item_words", F.greatest(-F.col("diagonal"), F.lit(0)) + 1, F.size("part")), lambda a, b: a == b).alias("equal")
    )
    enough = (F.col("s.best") >= F.least(F.lit(LEAST), F.col("item_n"))) & ((F.col("item_n") >= SHORT) | (F.col("item_n") == F.col("n_words")))
    scored = compared.withColumn("s", best_stretch(F.col("equal"))).filter(enough)
    matched = F.size(F.filter(F.slice("equal", F.col("s.first") + 1, F.col("s.last") - F.col("s.first") + 1), lambda same: same))
    shift = F.greatest(F.col("diagonal"), F.lit(0))
    return scored.select("doc", "text_key", "item", F.struct(F.col("s.best").alias("score"), (-(F.col("s.first") + shift)).alias("early"), (F.col("s.last") + shift).alias("last"), matched.alias("matched")).alias("s"))


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(id, item, score, matched, first_word, last_word): the best stretch of each item in each text that has one."""
    best = stretches(docs, items, id_col, text_col, item_col).groupBy("doc", "item").agg(F.max("s").alias("s"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), F.col("s.score").alias("score"), F.col("s.matched").alias("matched"), (-F.col("s.early")).alias("first_word"), F.col("s.last").alias("last_word"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no stretch of an item; rows of one id (or of none) are told apart by their texts."""
    found = stretches(docs, items, id_col, text_col, "item_id")
    of_id, of_key = unused(docs, "bad_id", "bad_key")
    bad = written(found.select(F.col("doc").alias(of_id), F.col("text_key").alias(of_key)).distinct(), "contaminated")
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(bad, docs[id_col].eqNullSafe(bad[of_id]) & (key == bad[of_key]), "left_anti")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
