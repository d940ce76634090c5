"""Queries op6 and op7."""
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.mix import taken_words
from lectern.llm.training_order import read_sequences, write_shards
from lectern.session import fresh_path


def op6_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return taken_words(spark.read.parquet(f"{sf}/documents.parquet"))


def op7_training_order(spark: SparkSession, sf: str) -> DataFrame:
    """Where each document lies in the shards, and the SHA-256 of its tokens as read back from there."""
    folder = fresh_path(spark, "training-order")
    index = write_shards(spark.read.parquet(f"{sf}/documents.parquet"), folder)
    return read_sequences(index, folder).select("doc_id", "slot", "shard", "start", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"))


SQL: dict[str, str] = {}
Q = {f.__name__: f for f in (op6_mix_sources, op7_training_order)}
