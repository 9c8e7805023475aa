"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

1. language: documents whose language cannot be told go.
2. lines: repeated runs of three or more lines go from all but the first place they stand in.
3. near duplicates: of each group of near-duplicates the document with the smallest id stays.
4. decontamination: documents that have leaked a benchmark item go.
5. tokens: what is left is encoded; decoding the ids again gives the digest of the text they stand for.

All stages but the last return the columns of documents. No SQL can express stages 1, 3, 4 and 5.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.batches import table
from tidemart.llm.columns import set_apart
from tidemart.llm.decontamination import without_leaks
from tidemart.llm.language import keep_identified
from tidemart.llm.lines import dedup_lines
from tidemart.llm.pieces import encode_documents
from tidemart.llm.simhash import keep_one
from tidemart.session import scratch_dir

TOKENIZER = "piece_bpe_32k.model"
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = [
        F.length("text").cast("long").alias(name) if name == "n_chars" else F.col(name) for name in docs.columns
    ]
    return set_apart(docs, ("doc_id", "text"), dedup_lines).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path(TOKENIZER), keep_ids=True)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
