"""A training-data pipeline of five stages, each written to Parquet and read by the next.

Every stage but the last returns the columns of ``documents``, whatever else they are called. Null
and empty texts are clean, are copies of each other, hold no benchmark words and no secrets, and
encode to no ids. Of rows that repeat an id and a text one stays; rows that share an id but not a
text are judged each. Ties: a text that is as likely toxic as not goes, the smallest id of a group
of copies stays, a document with just a twentieth of benchmark words goes, and a candidate with
half of the votes is a secret. Texts are read whole, however long. An empty table stays empty
through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontaminate, secrets, simhash, toxicity
from millrace.llm.common import table
from millrace.llm.queries import RANK_FILE
from millrace.workspace import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    return simhash.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark windows."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    scanner, findings = secrets.fit(docs)
    return secrets.redact(docs, scanner, findings=findings)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids, and hashes of ids and decoded bytes, of each document."""
    return bpe.digests(docs, bpe.read_ranks(public_tokenizers.path(RANK_FILE)))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

#: SQL cannot express the trained models of two stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
