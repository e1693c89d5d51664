"""The corpus pipeline: documents pass stage after stage, each written as Parquet and read again by the next.

All stages but the last return the columns of their documents. Stages drop rows only for the reason they name, and each
works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandem.llm import decontaminate, pieces, secrets, simhash, toxicity
from tandem.llm.workload import read, tokenizer
from tandem.session import store


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the score calls toxic go."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"), threshold=0.7)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.one_of_each(docs, words=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"), window=13, share=20)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark and its length counted again."""
    return secrets.redacted(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_ids, ids`` of every document."""
    ids = pieces.encode_documents(docs.select("doc_id", "text"), tokenizer("piece_bpe_32k.model"), ids="ids")
    return ids.selectExpr("doc_id", "cast(size(ids) AS bigint) AS n_ids", "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("sentencepiece", tokens_stage),
]

#: A learned score, a fingerprint of hashed shingles and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns for the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
