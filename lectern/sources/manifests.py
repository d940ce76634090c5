"""Course manifests: one JSON document per course."""
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern import schemas
from lectern.functions.text import is_json, whole_struct
from lectern.operators.flags import HARD, flag


def read_manifests(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame]:
    """manifests and rejects. A folder stands for the manifest.json files below it."""
    files = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
             .text(glob, wholetext=True)
             .select(F.col("_metadata.file_path").alias("path"), "value"))
    named = F.regexp_extract("path", r"([^/]+)\z", 1) == "manifest.json"
    return parse_manifests(files if glob.endswith(".json") else files.filter(named))


def parse_manifests(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """texts(path, value) -> manifests(course_id, path, m, raw), rejects(path, reason)."""
    valid = is_json(F.col("value"))
    is_object = F.col("value").rlike(r"\A\s*\{")
    # An explode, as a filter on the parsed column would parse the text a second time.
    parsed = F.filter(F.array(whole_struct(F.col("value"), schemas.MANIFEST)), lambda m: m.isNotNull())
    manifests = (texts.select("path", F.col("value").alias("raw"), F.explode(parsed).alias("m"))
                 .select(F.coalesce("m.course.id", "path").alias("course_id"), "path", "m", "raw"))
    rejects = texts.filter(~(valid & is_object)).select(
        "path", F.when(~valid, "not JSON").otherwise("not an object").alias("reason"))
    return manifests, rejects


def repeated_courses(manifests: DataFrame) -> DataFrame:
    """(course_id, first): ids that more than one manifest claims, with the smallest of their paths."""
    return (manifests.groupBy("course_id").agg(F.min("path").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))


def one_per_course(manifests: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The manifest of the smallest path for every course_id, and a flag for each other one. repeated: a written table of repeated_courses,
    so that its size is known and the manifests need no shuffle."""
    marked = manifests.join(repeated, "course_id", "left")
    kept = marked.filter(F.col("first").isNull() | (F.col("path") == F.col("first"))).drop("first")
    return kept, flag(marked.filter(F.col("path") != F.col("first")), "manifest", "repeated_course", HARD, F.col("path"), F.col("first"))
