"""Documents to packed training sequences, stage by stage.

Each stage works on the rows that its predecessor kept, is written as Parquet in the shared
folder, and is read again by the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.llm import mixing, outliers, packing, similar, toxicity
from larder.sources.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model scores below its threshold."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return outliers.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose sets of five-word shingles are similar by about 0.8 or more, as wide prints estimate it."""
    return similar.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, smaller sources read up to twice as often."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences that all have the sources' proportions."""
    pieces = packing.pack(docs, packing.word_bpe_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fitted models, components and token ids are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
