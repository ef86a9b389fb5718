"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.text import stored


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its least neighbour instead."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = F.least("u", "low")
    return (
        both.join(_lowest(both), "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), low.alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _lowest(down)
    return (
        down.join(least, "u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .union(least.select("u", F.col("low").alias("v")))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node of its component) of all nodes with a link.

    ``links`` has longs u and v; loops and repeats don't matter. Alternates the
    two star steps until nothing changes: about log2 of the longest path rounds,
    each of which moves every link a fixed number of times. A node of many
    links is spread by the adaptive split of skewed joins, and its minimum is
    taken before the shuffle. An empty table gives an empty result.
    """
    now = stored(links.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "links")
    before = None
    while True:
        # A forest of stars comes out as it went in; equal sums of a mixing hash
        # and equal counts tell that it did.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        now = stored(_small_star(_large_star(now)), "links")
