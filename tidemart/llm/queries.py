"""Registered queries of the training-data operators, and SQL that must agree where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.batches import table
from tidemart.llm.conversations import TRIE_SQL, prefix_trie
from tidemart.llm.decontamination import leaks
from tidemart.llm.fingerprints import fingerprint_documents
from tidemart.llm.language import identify
from tidemart.llm.lines import LINE_SQL, line_report
from tidemart.llm.negatives import NEGATIVES_SQL, mine
from tidemart.llm.pieces import encode_documents
from tidemart.llm.quality import score_quality
from tidemart.llm.recompression import dedup_windows
from tidemart.llm.secrets import scan
from tidemart.llm.simhash import near_duplicates
from tidemart.llm.suffixes import dedup_suffixes
from tidemart.llm.toxicity import score_toxicity


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), path="source")


def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_windows(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_suffixes(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


_QUERIES = (
    op1_decontamination,
    op2_sentencepiece,
    op3_line_dedup,
    op4_secrets,
    op5_recompression,
    op6_language_id,
    op7_simhash,
    op8_quality,
    op9_suffix_dedup,
    op10_fingerprints,
    op11_prefix_trie,
    op12_toxicity,
    op13_hard_negatives,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": LINE_SQL, "op11_prefix_trie": TRIE_SQL, "op13_hard_negatives": NEGATIVES_SQL}
