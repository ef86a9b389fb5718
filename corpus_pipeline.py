"""The corpus pipeline: documents to a filtered, deduplicated, mixed and encoded corpus.

Each stage reads all that the one before kept, from parquet, and its decisions
take effect. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import lines, mixing, neardup, quality, sentencepiece
from ledgerlens.llm.text import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.accepted(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand elsewhere too are cut out; a document of which nothing is left goes."""
    return lines.without_repeats(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8 or more) one document stays."""
    return neardup.deduplicated(docs, size=5, similarity=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, with checksums of the ids and of their decoded text."""
    model = sentencepiece.Model.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepiece.report(docs, model)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("line_dedup", cut_repeats),
    ("minhash_near_dedup", one_of_each),
    ("mix_sources", mix),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Cut lines and pieces have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None
