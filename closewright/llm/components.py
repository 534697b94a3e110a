"""Connected components of a graph given as a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.shared import written

MOST_ROUNDS = 60


def _to_least(links: DataFrame, own: bool) -> DataFrame:
    """Each neighbour v of u linked to the least of u's neighbours; with `own`, only v > u, and u itself counts."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    if own:
        least = least.withColumn("m", F.least("m", "u"))
    # A key derived on both sides: the aggregate gets a shuffle of its own, so a hub's links can be split over tasks.
    left = links.withColumn("k", F.concat(F.col("u").cast("string"), F.lit("|")))
    met = left.join(least.select(F.concat(F.col("u").cast("string"), F.lit("|")).alias("k"), "m"), "k")
    return met.filter("v > u" if own else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """u and component (its least node) of every node of the links (u, v: long). No link, no row.

    Self-links count as a node. Rounds end when no link changes; their number grows with the logarithm of the
    longest chain. Each round is a table in the shared folder.
    """
    now = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = now.filter("u <> v")
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, own=True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        large = written(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("v"))
        small = _to_least(large, own=False).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).union(least).filter("u <> v").distinct()
        now = written(small, "links")
        told = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if told == before:
            break
        before = told
    else:
        raise RuntimeError("components did not settle")
    nodes = links.select("u").union(links.select("v")).distinct()
    return nodes.join(now.select("u", F.col("v").alias("component")), "u", "left").select("u", F.coalesce("component", "u").alias("component"))
