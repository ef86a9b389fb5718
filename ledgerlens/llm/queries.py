"""Queries of this package; each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import (
    conversations, html, licenses, lines, mixing, neardup, ngram_lm, packing, phrases, quality, sentencepiece, tokens_file, topk,
)
from ledgerlens.llm.text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op7_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@query
def op8_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.report(table(spark, sf_dir, "documents"))


@query
def op9_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@query
def op1_top_k_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.report(table(spark, sf_dir, "embeddings"))


@query
def op2_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2, similarity=0.8)


@query
def op3_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


@query
def op4_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece.Model.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepiece.report(table(spark, sf_dir, "documents"), model)


@query
def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


@query
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokens_file.model_text(public_tokenizers.path("word_bpe_49k.json"))
    return tokens_file.report(table(spark, sf_dir, "documents"), model)


@query
def op10_mix_systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


@query
def op11_phrase_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_differencing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokens_file.model_text(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.report(table(spark, sf_dir, "documents"), model)


@query
def op13_splitter_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))
