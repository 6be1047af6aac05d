"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_class(df: DataFrame, key: list[Column], kind: str, rows: int, most: int, least: int = 20) -> tuple[DataFrame, dict]:
    """About `rows` rows of each value of `kind`, chosen by a hash of the key columns; of rows with equal keys one.

    With many values it is fewer of each, so that the sample has about `most` rows, but at least `least` of each value.
    Also the number of rows that each value has in df. All rows are counted; the sample's size doesn't grow with df.
    """
    counts = {r[kind]: r["n"] for r in df.groupBy(kind).agg(F.count("*").alias("n")).collect()}  # a row for each value, as the model has
    if not counts:
        return df.limit(0), {}
    rows = min(rows, max(most // len(counts), least))
    share = F.create_map(*(x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, rows / n)))))
    draw = F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    return df.filter(draw < F.element_at(share, F.col(kind))).dropDuplicates(), counts
