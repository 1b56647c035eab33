"""Connected components of a graph of links, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliq.llm.text import stored


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's neighbours (larger ones, or itself and smaller ones) to its smallest neighbour.

    The smallest neighbour is found by an aggregation that combines before its shuffle, and is
    joined back, so no list of neighbours is ever held.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        chosen = F.col("v") > F.col("u")
    else:
        # Small star: edges run from the larger to the smaller end.
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        chosen = F.lit(True)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u").filter(chosen).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not larger:
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node that has a link.

    ``edges`` has columns ``a`` and ``b`` of one ordered type. Each round is written to the
    shared folder, so lineage stays short; the rounds end when the edges no longer change.
    """
    known = stored(edges.filter("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        known = stored(_stars(_stars(known, larger=True), larger=False), "stars")
        state = known.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if mark == tuple(state):
            break
        mark = tuple(state)
    roots = known.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return known.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
