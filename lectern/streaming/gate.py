"""The draft gate as a stream: new drafts in, their flags appended. No state and no event time is needed."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.blocklist import PhraseIndex
from lectern.plans.checks import draft_flags


def stream_draft_flags(spark: SparkSession, source: str, schema, phrases: DataFrame, flags_path: str,
                       checkpoint: str) -> StreamingQuery:
    """Each micro-batch of drafts(course_id, stem, md) below `source` writes one batch folder, so a batch
    that is run again after a failure replaces its own flags and nothing else. The phrase list is indexed once, before the first batch."""
    index = PhraseIndex(phrases)

    def judge(batch: DataFrame, batch_id: int) -> None:
        draft_flags(batch, index).write.mode("overwrite").parquet(f"{flags_path}/batch={batch_id}")

    return (spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(judge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
