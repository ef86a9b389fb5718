"""The default RFM code lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The nine segment names.
BEST = "Melhores clientes"
LOYAL = "Leais"
POTENTIAL_LOYAL = "Potenciais leais"
NEW = "Novos"
PROMISING = "Promissores"
NEEDS_ATTENTION = "Precisa de atenção!"
ABOUT_TO_HIBERNATE = "Prestes a hibernar"
HIBERNATING = "Hibernando"
LOST = "Perdidos"


def segment_rule(r: Column, f: Column, m: Column) -> Column:
    """Segment of three scores. R 1 is most recent; F and M 4 are best."""
    recent = r <= 2
    return (
        F.when(recent & (f == 1), NEW)
        .when(recent & (m <= 2), PROMISING)
        .when(recent & (f == 2), POTENTIAL_LOYAL)
        .when((r == 1) & (f == 4) & (m == 4), BEST)
        .when(recent, LOYAL)
        .when((f >= 3) & (m >= 3), NEEDS_ATTENTION)
        .when(r == 3, ABOUT_TO_HIBERNATE)
        .when(f + m <= 3, LOST)
        .otherwise(HIBERNATING)
    )


def default_segments(spark: SparkSession) -> DataFrame:
    """One row for each of the 64 codes."""
    n = F.col("id")
    digits = spark.range(64).select(
        F.floor(n / 16 + 1).alias("r"), (F.floor(n / 4) % 4 + 1).alias("f"), (n % 4 + 1).alias("m")
    )
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    return digits.select(
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm"),
        segment_rule(r, f, m).alias("category"),
    )
