"""Corpus pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. ``run`` writes each stage's rows to the
shared checkpoint folder as Parquet and reads them back as the next one's docs,
so a stage is computed once and survives lost executors.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import packing, rule_cascade, simhash_dedup, source_mix, suffix_dedup
from quarry.session import staging_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return rule_cascade.quality_rules(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return simhash_dedup.keep_one_per_component(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeat earlier ones. Bytes of a character
    that was cut through go too, n_chars follows, and a document of which no word
    is left goes."""
    out = suffix_dedup.drop_repeats(docs, cut_text=True)
    out = out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it."""
    return source_mix.take_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", source_weights),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot express hashing by XXH64 bits and the packing search; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = staging_path(spark, f"corpus-pipeline-{i + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
