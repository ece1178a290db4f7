"""A corpus pipeline of five operators: what toxicity, exact copies, near copies, the mix and packing leave of ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns a DataFrame with the
columns of ``documents``; the last returns the pieces of the packed sequences. ``run`` writes and rereads the result of
each stage in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathlight.llm import exact_dedup, mixing, packing, simhash, toxicity
from pathlight.llm.common import materialize


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", keep_civil),
    ("exact_dedup", keep_one_copy),
    ("simhash_near_dedup", keep_one_near_copy),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SimHash components, the drawn mix and token ids are beyond SQL; ``tests/llm/test_pipeline.py`` checks the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
