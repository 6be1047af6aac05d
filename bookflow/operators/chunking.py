"""Greedy packing of paragraphs into chunks, as folds within the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow.functions import text as T

STATE = "struct<done:array<string>,open:array<string>,used:int>"


def fold(units: Column, full: callable, used: callable) -> Column:
    """Packs units struct(text, solo) in order; `full` says when the open chunk must close before a unit."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("used")).cast(STATE)
    closed = lambda a: F.when(F.size(a["open"]) > 0, F.array_append(a["done"], F.array_join(a["open"], "\n\n"))).otherwise(a["done"])

    def step(a: Column, u: Column) -> Column:
        flush = (F.size(a["open"]) > 0) & full(a, u)
        return F.struct(
            F.when(flush, closed(a)).otherwise(a["done"]).alias("done"),
            F.when(flush, F.array(u["text"])).otherwise(F.array_append(a["open"], u["text"])).alias("open"),
            F.when(flush, used(u)).otherwise(a["used"] + used(u)).alias("used"),
        ).cast(STATE)

    return F.aggregate(units, start, step, closed)


def split_text(x: Column, most: int) -> Column:
    """Chunks of stripped, non-blank paragraphs; a separator of two counts for each; longer paragraphs are cut and stand alone."""
    paras = F.filter(F.transform(F.split(T.strip(x), "\n{2,}"), lambda p: T.strip(p)), lambda p: p != "")

    def units(p: Column) -> Column:
        solo = F.length(p) > most
        return F.when(solo, F.transform(T.hard_slices(p, most), lambda s: F.struct(s.alias("text"), F.lit(True).alias("solo")))).otherwise(F.array(F.struct(p.alias("text"), F.lit(False).alias("solo"))))

    # an over-long piece closes the chunk before it, and fills its own (used = most), so that the next one closes it
    each = F.flatten(F.transform(paras, units))
    return fold(each, lambda a, u: u["solo"] | (a["used"] + F.length(u["text"]) + 2 > most), lambda u: F.when(u["solo"], F.lit(most)).otherwise(F.length(u["text"]) + 2))


def chunk_text(x: Column, most: int = 8000) -> Column:
    """Chunks of paragraphs as they are, blank ones too; separators don't count; longer paragraphs are kept whole."""
    units = F.transform(F.split(x, "\n\n"), lambda p: F.struct(p.alias("text"), F.lit(False).alias("solo")))
    return fold(units, lambda a, u: a["used"] + F.length(u["text"]) > most, lambda u: F.length(u["text"]))
