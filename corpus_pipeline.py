"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

A stage works on all rows its predecessor kept and returns the columns of documents; the last returns token ids as
digests. Rows are removed for toxicity, exact copies and near copies; the mix repeats rows of sources that get more than
they have.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import bpe, exact, minhash, mixing, toxicity
from tallycast.session import cut_lineage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score as toxic go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return exact.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by 80 % of their five-word shingles, the document with the smallest id stays."""
    return minhash.drop_near_copies(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document that several epochs take comes several times."""
    return mixing.mixed_rows(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, decoded again to confirm them: one row for each row of the mix."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, keep=["doc_id", "source"], checked="round_trip")
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

#: Near duplicates, a trained classifier and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
