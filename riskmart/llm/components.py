"""Connected components of a link table, as Spark joins (large star / small star).

A node ends with the smallest node of its component.  Each round rewrites the
links through grouped minima, so a node with very many links costs a partial
aggregate and a join that adaptive execution may split, not one task.  The
table of a round is written to the shared folder; it is never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stored


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    around = _both(links)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them (links have u > v)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v of one ordered type); root is its component's
    smallest node, and is itself a row.  Links to oneself and nulls are left out; no links give no rows."""
    now = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                 "links")
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == state or not mark[0]:
            break
        state = tuple(mark)
        now = stored(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
