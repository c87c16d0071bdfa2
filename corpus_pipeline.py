"""From raw documents to token ids: the training-data operators one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import decontaminate, quality, secrets, simhash
from reviewloom.llm.queries import tokenizer
from reviewloom.session import land, prepare_workers


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    prepare_workers(spark)
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links, the one with the smallest id."""
    prepare_workers(spark)
    return simhash.keep_one_per_group(docs, words_per_shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    prepare_workers(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked and ``n_chars`` counted anew."""
    prepare_workers(spark)
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    counted = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.withColumn("n_chars", counted)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document."""
    prepare_workers(spark)
    return docs.select("doc_id", "lang", "source", tokenizer(spark).encode("text").alias("encoded")) \
        .select("doc_id", "lang", "source", "encoded.n_tokens", "encoded.ids")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("encode", encode),
]

# SQL can express neither the merges of the encoder nor the groups of near duplicates.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is landed and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
