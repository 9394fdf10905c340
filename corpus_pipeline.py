"""Corpus pipeline: toxic documents go, then copies, then near copies; secrets are masked; the rest is packed.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and returns a DataFrame, which
is written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of documents.

Defined results: a null text is empty: it is not toxic by its words, equals other empty texts (one of which stays), has no near copies and
no secrets, and is packed as the end mark alone. Without labels nothing is toxic. Rows that repeat an id are documents of their own until their
texts are equal; of equal texts the longest original stays, then the smallest id, then the least by the other columns. Rows without an
id come last. Columns beside those of documents stay with their rows up to the last stage, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custodia.llm import exact_dedup, jaccard_join, packing, secrets, toxicity
from custodia.llm.common import materialise, table
from custodia.llm.registry import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Classifier, tokenizer and similarity classes have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
