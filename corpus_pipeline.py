"""A training-data pipeline over `documents`: toxic documents go, similar ones are reduced to one each, benchmark passages go,
sources are mixed to their weights, and the mix is written as token shards in training order.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of documents.
Stages decide about rows: each row has a staged number of its own, so null and repeated doc_ids are judged like all others.
"""
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.bits import key_bits, maybe_in
from lectern.llm.decontaminate import contamination
from lectern.llm.frames import field, keyed, packed, unpacked
from lectern.llm.jaccard_trie import similar_components
from lectern.llm.mix import mixed_documents
from lectern.llm.toxicity import fit, scorer
from lectern.llm.training_order import read_sequences, write_shards
from lectern.session import fresh_path, scratch


def without(rows: DataFrame, gone: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs for rows (_row, _key) without those in gone (_key). Only rows that a filter of fixed size can't clear are shuffled."""
    rows = maybe_in(rows, "_key", key_bits(gone, "_key"))
    clear = rows.filter(~F.col("_maybe")).select("_row")
    unsure = rows.filter("_maybe").join(gone.select("_key"), "_key", "leftanti").select("_row")
    return unpacked(clear.union(unsure), docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 and above are rejected; labels of held-out documents are not learnt from."""
    score = scorer(fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    kept = packed(docs, "text").withColumn("_score", score("text")).filter("_score < 0.5")
    return unpacked(kept, docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar rows one stays: the first one of its smallest doc_id, null last."""
    rows, path = keyed(docs), fresh_path(spark, "similar")
    with scratch(spark):
        members_path = fresh_path(spark, "members")
        (similar_components(rows.select(F.col("_key").alias("doc_id"), field(docs, "text"))).filter("doc_id <> component_id")
         .select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).write.parquet(members_path))
        others = spark.read.parquet(members_path)
        members = others.union(others.select(F.col("_group").alias("_key"), "_group").distinct()).join(rows.select("_key", field(docs, "doc_id")), "_key")
        stays = members.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))["_key"].alias("_one"))
        members.join(stays, "_group").filter("_key <> _one").select("_key").write.parquet(path)
    return without(rows, spark.read.parquet(path), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule (hit words are 5 % of all, or more) holds for are rejected."""
    rows, path = keyed(docs), fresh_path(spark, "contaminated")
    with scratch(spark):
        (contamination(rows.select(F.col("_key").alias("doc_id"), field(docs, "text")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
         .filter("contaminated").select(F.col("doc_id").alias("_key")).write.parquet(path))
    return without(rows, spark.read.parquet(path), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as it is drawn, and with its drawn words where it is drawn in part."""
    return mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in the shared folder; returns where each row's tokens lie and their digest as read back."""
    folder = fresh_path(spark, "pipeline-tokens")
    index = write_shards(docs, folder)
    return read_sequences(index, folder).select("doc_id", "slot", "shard", "start", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_similar), ("decontamination", drop_contaminated), ("mix_sources", mix_sources),
          ("token_output", write_tokens)]
ORACLE_SQL = None  # character models and keyed permutations are beyond SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


Q = {"pipeline": run}
SQL: dict[str, str] = {}
