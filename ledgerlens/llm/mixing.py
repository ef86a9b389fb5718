"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.text import SPACE, set_aside, stored

# The weights, given to the sources in order, again and again.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2.0
SEED = "mix-1"

# A place in a source's order is told by digits, each of a small range, so that
# no window of the prefix sums holds more than a few hundred rows.
_DIGITS = ("m_d1", "m_d2", "m_d3", "m_d4")
_KEY = ("m_null", "m_source")


def word_size(text: Column) -> Column:
    """Number of words; 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.size(F.filter(parts, lambda w: w != "")).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Words to take from each source; ``sizes`` has m_null, m_source, source_size.

    The targets are min(2 * size, level * weight). Resharing the excess until no
    target is above its limit ends at the one level at which they add up to
    SHARE of all words. For any j, filling the j sources that reach their limit
    first and sharing the rest by weight asks for a level not above it, so it is
    the largest of those. One row per source in one task.
    """
    order = Window.orderBy(*_KEY)
    everything = Window.partitionBy()
    i = F.row_number().over(order) - 1
    weight = reduce(
        lambda other, k: F.when(i % len(WEIGHTS) == k, float(WEIGHTS[k])).otherwise(other),
        range(len(WEIGHTS)),
        F.lit(None).cast("double"),
    )
    limit = F.col("m_limit")
    weighted = sizes.withColumn("m_weight", weight).withColumn(
        "m_limit", F.col("source_size") * F.lit(MOST_COPIES)
    )
    by_limit = Window.orderBy(limit / F.col("m_weight"), *_KEY)
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * F.lit(SHARE) - filled) / F.sum("m_weight").over(after)
    return (
        weighted.withColumn("m_level", level)
        .withColumn("m_level", F.max("m_level").over(everything))
        .withColumn("target", F.least(limit, F.col("m_level") * F.col("m_weight")))
        .select(*_KEY, "source_size", "target")
    )


def _offset(source: Column) -> Column:
    """The source's random offset in [0, 1): the same in each run, another for each seed."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(source, F.lit("")))), 1, 8)
    return F.conv(digest, 16, 10).cast("long") / F.lit(2.0**32)


def _prefix(counts: DataFrame) -> DataFrame:
    """``counts`` (keys, digits, m_n) with m_before: rows of the source at smaller digits."""
    keys = [*_KEY, *_DIGITS]
    level = counts
    levels = []
    for depth in range(len(_DIGITS), 0, -1):
        own = keys[: len(_KEY) + depth]
        if depth < len(_DIGITS):
            level = level.groupBy(*own).agg(F.sum("m_n").alias("m_n"))
        window = Window.partitionBy(*own[:-1]).orderBy(own[-1])
        before = F.sum("m_n").over(window) - F.col("m_n")
        levels.append(level.select(*own, before.alias(f"m_before{depth}")))
    joined = levels[-1]
    for depth, finer in enumerate(reversed(levels[:-1]), start=1):
        joined = joined.join(finer, keys[: len(_KEY) + depth])
    sums = reduce(lambda a, b: a + b, [F.col(f"m_before{d}") for d in range(1, len(_DIGITS) + 1)])
    return joined.select(*keys, sums.alias("m_before"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with source_size, target, copies and taken; needs doc_id, source, size.

    Within a source the documents stand in order of size, then of a hash of
    their id, then of the id. Each is expected target / source_size times, at
    most twice; the running sum of that plus the source's offset is taken over
    the order, and a document gets a copy for each integer that its step
    crosses. The order by size spreads the copies evenly over short and long
    documents, so the words taken miss the target by a few documents' words.

    A null source is a source of its own, last in the order of weights; null
    ids come first and null sizes are 0. Rows that are alike in size and id get
    their copies in any order, so a rerun returns the same rows. Empty tables
    give an empty result, and sources without words take none. Columns of
    ``docs`` that begin with ``m_`` or are named as the results are replaced.
    """
    own = [c for c in docs.columns if c not in ("source_size", "target", "copies", "taken") and not c.startswith("m_")]
    salt = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 3), 16, 10)
    placed = (
        docs.select(*own)
        .withColumn("size", F.coalesce("size", F.lit(0).cast("long")))
        .withColumns(
            {
                "m_null": F.col("source").isNull(),
                "m_source": F.coalesce("source", F.lit("")),
                "m_d1": F.floor(F.col("size") / 64),
                "m_d2": F.col("size") % 64,
                "m_salt": salt.cast("long"),
            }
        )
        .withColumns({"m_d3": F.floor(F.col("m_salt") / 64), "m_d4": F.col("m_salt") % 64})
    )
    keys = [*_KEY, *_DIGITS]
    counts = placed.groupBy(*keys).agg(F.count("*").alias("m_n"))
    sizes = (
        counts.groupBy(*_KEY)
        .agg(F.sum(F.col("m_n") * (F.col("m_d1") * 64 + F.col("m_d2"))).alias("source_size"))
    )
    ranked = placed.withColumn(
        "m_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id")) - 1
    )
    step = (
        ranked.join(_prefix(counts), keys)
        .join(targets(sizes), list(_KEY))
        .withColumn(
            "m_ratio",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
        )
        .withColumn("m_place", (F.col("m_before") + F.col("m_rank")).cast("double"))
        .withColumn("m_offset", _offset(F.col("source")))
    )
    crossed = F.floor((F.col("m_place") + 1) * F.col("m_ratio") + F.col("m_offset")) - F.floor(
        F.col("m_place") * F.col("m_ratio") + F.col("m_offset")
    )
    return step.withColumn("copies", crossed.cast("long")).select(
        *own,
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: what the mix takes of it.

    The texts are read once, for their sizes; ids, sources and sizes are stored.
    """
    sized = stored(docs.select("doc_id", "source", word_size(F.col("text")).alias("size")), "sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it was taken, with their own columns."""
    renamed, back = set_aside(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=word_size(F.col("text")))
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mix(renamed).withColumn("m_copy", copies).select(*back)
