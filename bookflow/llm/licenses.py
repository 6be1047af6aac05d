"""License scans (operator 6), by a positional index of rare words; DataFrame functions only.

Templates are licence notices with a mandatory key phrase. The document frequency of every key word is counted over the
whole table. In each file the places of its licence words are looked up; the rarest (highest-IDF) word of a key phrase
and, in phrases of several words, the second rarest give postings (template, start of the phrase = place - offset).
Starts that both give are intersected, and the key phrase is then verified word by word. The aligned words of the whole
notice, weighted by IDF, give the score. All of it happens within the row: one pass for the frequencies, one for the
scan, no shuffle of texts.

Defined results: null and empty texts have no words and no labels, first_word and last_word null, score 0; repeated rows
are repeated; null ids stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key_words)


BASE = [
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
]
#: Labels of the method's own: versions, relatives and texts that do not name their licence.
OWN = [
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("bsd", "released under the bsd license", "bsd license"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("isc", "released under the isc license", "isc license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]
TEMPLATES = [*BASE, *OWN]
#: Added to a start so that packed candidates are never negative; more than the words of any text.
SHIFT = 1 << 33


def lowered(text: Column) -> Column:
    """Lower case of A-Z only. lower() may be used unless the Kelvin sign is there, the only other character it maps to a-z alone."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(text.contains("K"), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    """Words of a text; the places before and after the outermost separators aren't words."""
    parts = F.split(F.regexp_replace(lowered(F.coalesce(text, F.lit(""))), f"^{NOT_WORD}|{NOT_WORD}$", ""), NOT_WORD)
    return F.when(F.element_at(parts, 1) == "", F.array().cast("array<string>")).otherwise(parts)


def key_vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.key_words})


def document_frequencies(df: DataFrame, text_col: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of rows, and rows with each word of the (fixed, short) vocabulary; over the whole table."""
    words = df.select(words_of(F.col(text_col).cast("string")).alias("words"))
    held = words.select(F.explode_outer(F.array_distinct(F.concat(F.array(F.lit("")), F.filter("words", lambda w: w.isin(vocabulary))))).alias("word"))
    found = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # a row for each word at most
    return found.pop("", 0), found


def idf(n: int, found: dict[str, int], word: str) -> float:
    return math.log((n + 1) / (found.get(word, 0) + 1)) + 1


def anchors(t: Template, n: int, found: dict[str, int]) -> list[int]:
    """Offsets within the key phrase of its rarest words: the rarest, and the next unless there is none."""
    order = sorted(range(len(t.key_words)), key=lambda i: (-idf(n, found, t.key_words[i]), i))
    return order[:2]


def postings(templates: list[Template], chosen: list[list[int]], rank: int) -> Column:
    """word -> packed (template, shift - offset of the word in the key phrase) for the anchors of one rank."""
    by: dict[str, list[int]] = {}
    for k, (t, own) in enumerate(zip(templates, chosen)):
        offset = own[min(rank, len(own) - 1)]
        by.setdefault(t.key_words[offset], []).append(k * 2 * SHIFT + SHIFT - offset)
    return F.create_map(*(x for w, entries in by.items() for x in (F.lit(w), F.array(*map(F.lit, entries)).cast("array<bigint>"))))


def literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[Template] = TEMPLATES) -> DataFrame:
    """(id, n_words, hits array<struct<template, start, coverage>>) of every row; start counts words from 0."""
    n, found = document_frequencies(df, text_col, key_vocabulary(templates))
    chosen = [anchors(t, n, found) for t in templates]
    rare = sorted({t.key_words[o] for t, own in zip(templates, chosen) for o in own})
    keys = F.array(*(literal(t.key_words) for t in templates))
    notices = F.array(*(literal(t.words) for t in templates))
    weights = F.array(*(F.array(*(F.lit(idf(n, found, w)) for w in t.words)) for t in templates))
    leads = F.array(*(F.lit(t.key_at) for t in templates))

    base = df.select(F.col(id_col).alias("id"), words_of(F.col(text_col).cast("string")).alias("words"))
    placed = base.withColumn("n_words", F.size("words").cast("long")).withColumn(
        "places", F.when(F.col("n_words") > 0, F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: F.element_at("words", i).isin(rare))).otherwise(F.array().cast("array<int>"))
    )

    def candidates(rank: int) -> Column:
        table_ = postings(templates, chosen, rank)
        none = F.array().cast("array<bigint>")
        return F.flatten(F.transform("places", lambda i: F.transform(F.coalesce(F.try_element_at(table_, F.element_at("words", i)), none), lambda p: p + i - 1)))

    def read(c: Column) -> Column:
        return F.struct(F.floor(c / F.lit(2 * SHIFT)).cast("int").alias("template"), (F.pmod(c, F.lit(2 * SHIFT)) - SHIFT).cast("int").alias("start"))

    def verified(h: Column) -> Column:
        key = F.element_at(keys, h["template"] + 1)
        return (h["start"] >= 0) & (F.slice("words", F.greatest(h["start"], F.lit(0)) + 1, F.size(key)) == key)

    def coverage(h: Column) -> Column:
        words, weight = F.element_at(notices, h["template"] + 1), F.element_at(weights, h["template"] + 1)
        first = h["start"] - F.element_at(leads, h["template"] + 1)
        met = F.zip_with(F.transform(words, lambda w, j: F.coalesce(F.when(first + j >= 0, F.get(F.col("words"), first + j) == w), F.lit(False))), weight, lambda same, x: F.when(same, x).otherwise(0.0))
        return F.aggregate(met, F.lit(0.0), lambda a, x: a + x) / F.aggregate(weight, F.lit(0.0), lambda a, x: a + x)

    both = F.array_intersect(candidates(0), candidates(1))
    hits = F.transform(F.filter(F.transform(both, read), verified), lambda h: F.struct(h["template"].alias("template"), h["start"].alias("start"), coverage(h).alias("coverage")))
    kind = "array<struct<template:int,start:int,coverage:double>>"
    return placed.select(F.col("id").alias(id_col), "n_words", F.when(F.size("places") > 0, hits).otherwise(F.array().cast(kind)).alias("hits"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    names = literal([t.label for t in TEMPLATES])
    joined = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: F.element_at(names, h["template"] + 1)))), ",")
    found = found.withColumn("base_hits", F.filter("hits", lambda h: h["template"] < len(BASE)))
    starts = F.transform("base_hits", lambda h: h["start"])
    return found.select(
        "doc_id", "n_words", F.size("base_hits").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined("base_hits").alias("base_labels"), joined("hits").alias("labels"), F.round(F.coalesce(F.array_max(F.transform("hits", lambda h: h["coverage"])), F.lit(0.0)), 6).alias("score"),
    )
