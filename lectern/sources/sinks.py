"""Writers. Each is one distributed write; order inside a file set is carried by a column, not by files."""
from pyspark.sql import DataFrame, functions as F

from lectern.functions.text import JSON_OPTIONS
from lectern.operators.documents import LESSON_DOCUMENT, course_documents
from lectern.operators.gate import gate


BUCKETS = 64  # folders by default; a large catalog asks for more
# Documents of one course repeat one another, so plain JSON would take many times the manifests' own files. Spark reads these files as it reads plain ones.
JSON_FILES, TABLE_FILES = {"compression": "gzip"}, {"compression": "zstd"}


def _placed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("course_id"), F.lit(buckets)))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Rows of a folder meet before they are written, so a task opens a few files only. Adaptive execution splits what is large."""
    return _placed(df, buckets).hint("rebalance", *(["kind"] if "kind" in df.columns else []), "bucket")


def write_course_tree(manifests: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """All files of every course tree (documents.course_documents), one row each.

    Paths are partitioned by kind and by a hash bucket of the course, so a catalog of any size makes a
    bounded number of folders; course_id and the file's own path are in every row.
    """
    _bucketed(course_documents(manifests), buckets).write.mode("overwrite").options(**JSON_FILES).partitionBy("kind", "bucket").json(path)


def read_course_tree(spark, path: str) -> DataFrame:
    return spark.read.schema("course_id STRING, subject STRING, path STRING, doc STRING, kind STRING, bucket INT").json(path).drop("bucket")


def write_publish_tree(courses: DataFrame, lessons: DataFrame, copies: DataFrame, prose: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Course and lesson documents as one JSON text each, challenge sources to copy or to write as placeholders, prose texts.

    The texts of lessons and prose are most of the tree: they are written where they are made, at most a file per
    task and bucket, and not dealt for it."""
    for name, df, deal in (("courses", courses.select("course_id", "text"), _bucketed), ("lessons", lessons.select("course_id", "lesson_id", "lesson_pos", "path", "text"), _placed),
                           ("sources", copies, _bucketed), ("prose", prose, _placed)):
        deal(df, buckets).write.mode("overwrite").options(**TABLE_FILES).partitionBy("bucket").parquet(f"{path}/{name}")


def read_lesson_documents(spark, path: str) -> DataFrame:
    """The lesson documents of a publish tree, parsed from their texts again."""
    return spark.read.parquet(f"{path}/lessons").drop("bucket").withColumn("doc", F.from_json("text", LESSON_DOCUMENT, JSON_OPTIONS))


def write_flags(flags: DataFrame, courses: DataFrame, path: str) -> DataFrame:
    """Write the flags, then judge what was written: a verdict row per course."""
    flags.write.mode("overwrite").partitionBy("severity").parquet(f"{path}/flags")
    spark = flags.sparkSession
    verdict = gate(spark.read.schema(flags.schema).parquet(f"{path}/flags"), courses)
    verdict.write.mode("overwrite").parquet(f"{path}/verdict")
    return spark.read.parquet(f"{path}/verdict")


def write_quiz_split(quiz: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """quiz(course_id, stem, lesson_id, quiz_blocks): one row per lesson file, lessons without a quiz left out."""
    (_bucketed(quiz.filter(F.coalesce(F.size("quiz_blocks"), F.lit(0)) > 0), buckets)
     .write.mode("overwrite").options(**JSON_FILES).partitionBy("bucket").json(path))


def read_quiz_split(spark, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"course_id STRING, stem STRING, lesson_id STRING, quiz_blocks {schema}").json(path)


def write_facts(facts: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """facts(course_id, stem, pos, fact): one line per fact, as JSON, so that a fact may hold any character; `pos` restores the order."""
    _bucketed(facts.select("course_id", "stem", "pos", "fact"), buckets).write.mode("overwrite").options(**JSON_FILES).partitionBy("bucket").json(path)


def read_facts(spark, path: str) -> DataFrame:
    return spark.read.schema("course_id STRING, stem STRING, pos INT, fact STRING").json(path).drop("bucket")
