"""A training corpus from ``documents`` in stages; each is written as parquet and read back as the next one's input.

Toxic documents go, one document of each group of near copies stays, documents that hold a benchmark item go, the rest is
mixed by source weights (a document may then come twice), and what is left is encoded and read back from a token store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railgrain.llm import decontaminate, jaccard, mixing, token_store, toxicity
from railgrain.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go; rows without a key stay."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", "toxic")
    votes = written(toxicity.classify(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("key_")).distinct(), "toxic")
    return docs.join(votes, docs["doc_id"] == votes["key_"], "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least key of each component of near copies stays."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited ones too, go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix wants it."""
    return mixing.mixed(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in a store; what is read back is a row per document with its place and the checksum of its ids."""
    return token_store.digest(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", store_tokens),
]

#: Scores of trained models, random rounding and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
