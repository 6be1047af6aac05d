"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a join and a partial aggregation, so no component is gathered in one task; joins on hubs are salted.
Each round is written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

#: Ways into which the rows of a hub are dealt in the joins.
SALTS = 8


def with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges (u, v) with m of u. The side that has a row for each u is repeated SALTS times."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    return salted.join(spread, ["u", "salt"]).drop("salt")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return with_least(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return with_least(down, least).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not its component's smallest. edges: u, v long, undirected, any order.

    Rounds go on until the table of edges stays the same, which takes a logarithmic number of them. The result is a
    table that discard() can remove.
    """
    now = written(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    n = now.count()
    while n:
        new = written(small_star(large_star(now).distinct()).distinct(), "edges")
        after = new.count()
        same = after == n and new.join(now, ["u", "v"], "left_anti").isEmpty()
        discard(now)
        now, n = new, after
        if same:
            break
    out = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out.written_to = now.written_to
    return out
