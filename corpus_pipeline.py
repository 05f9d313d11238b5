"""The corpus pipeline: documents through language ID, exact and near de-duplication, mixing and tokenisation.

Each stage gets the documents its predecessor kept (as a stored table) and returns documents; the last returns tokens'
digests. No SQL twin: SimHash and BPE have no SQL form, so tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from risewatch.llm import bpe, exact, langid, mixing, simhash
from risewatch.llm.queries import vocabulary
from risewatch.llm.shared import settle, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a recognised language; the text model learns from the labelled documents of the input."""
    model = langid.train(docs)
    return langid.identify_documents(docs, model).where("accepted").select("document.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.exact_deduplicated(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every copy that the mix takes."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_digests(docs, vocabulary())


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("bpe", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs)
    return docs
