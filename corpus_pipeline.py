"""Documents to packed training sequences in five stages.

Each stage is a function (spark, docs, sf_dir) whose result is written as Parquet and read again
as the next one's documents. All but the last give back the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm import language_id, markov, mixing, packing, simhash
from homelake.llm.queries import vocabulary
from homelake.llm.shared import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go."""
    return language_id.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.keep_one_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return markov.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources up to twice."""
    return mixing.mix(docs, max_repeats=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 2048 tokens."""
    pieces = packing.pack(docs, vocabulary())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length"
    )


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", near_dedup),
    ("secret_masking", mask_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Compression, fingerprints and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
