"""A training corpus from ``documents``: quality, copies, near copies, mixture, tokens.

STAGES are run in order; each works on the rows the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayload.llm.byte_bpe import encode_documents, production_model
from quayload.llm.common import Files
from quayload.llm.exact_dedup import drop_copies
from quayload.llm.minhash import drop_near_copies
from quayload.llm.mixing import Mix, domain, take_mix
from quayload.llm.quality import drop_rejected

#: All domains, languages and sources weigh the same, so that what there is too much of makes room.
MIX = Mix(levels=("domain", "lang", "source"), budget_parts=950, epochs=1, seed=41)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject; learned from all of ``labels``."""
    return drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), Files(spark, "pipeline_quality"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return drop_copies(docs, Files(spark, "pipeline_exact"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by a similarity of 0.8 of their five-word shingles."""
    return drop_near_copies(docs, Files(spark, "pipeline_near"), shingle=5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the budgets of MIX; at most once each."""
    return take_mix(docs, MIX, Files(spark, "pipeline_mix"), {"domain": domain()})


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the hash of what they decode to."""
    return encode_documents(docs, production_model(spark))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The classifier, the near copies and the tokens can't be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = Files(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = files.write(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
