"""Base tables written once to the shared folder, so that forty rules do not parse the same JSON forty times.

Parquet then gives each rule only the nested columns it names, and a lost executor costs a re-read.
"""
from pyspark.sql import Column, DataFrame, functions as F

from lectern import schemas
from lectern.operators.flatten import LESSON_COLUMNS, catalog_tables, lesson_columns, ordered_lessons
from lectern.operators.publish import course_prefix, mapped_skills
from lectern.sources.manifests import one_per_course, repeated_courses


def stage(df: DataFrame, path: str) -> DataFrame:
    # The columns of a manifest repeat one another; zstd writes them at two thirds of snappy's size.
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def catalog_rows(manifests: DataFrame) -> DataFrame:
    """One row per lesson with its parsed columns, or one of a course without lessons. The first row of a course (`first`) holds the rest of the
    manifest, `m`, whose lessons keep their number but not their texts. What publishing takes from the rest, a lesson's `skills` and its course's
    `prefix`, is in every row, so lesson documents need no join."""
    rest = F.col("m").withField("lessons", F.transform("m.lessons", lambda l: F.lit(None).cast("string")))
    rows = manifests.select("course_id", "path", rest.alias("rest"), ordered_lessons(schemas.LESSON).alias("ordered"), F.col("m.modules.id").alias("module_ids"))

    def skills(p: Column) -> Column:
        at = F.array_position("module_ids", p["module"]).cast("int") - 1
        teaches = F.when(at >= 0, F.get("rest.modules", at)["teaches_skills"])
        return mapped_skills(teaches, p["l"]["brief"]["prerequisites"], F.col("rest.academy.skills_map"), F.col("rest.academy.default_skills"))

    # The rest goes into the first element, so it is not copied to every lesson's row.
    each = F.transform("ordered", lambda p, i: F.struct(i.alias("pos"), p.alias("p"), F.when(i == 0, F.col("rest")).alias("m"), skills(p).alias("skills")))
    bare = F.transform(F.array("rest"), lambda m: F.struct(F.lit(None).cast("int").alias("pos"), F.get("ordered", F.lit(0)).alias("p"), m.alias("m"),
                                                           F.lit(None).cast("array<string>").alias("skills")))
    return (rows.select("course_id", "path", course_prefix(F.col("course_id"), F.col("rest.academy.prefix")).alias("prefix"),
                        F.explode(F.when(F.size("ordered") > 0, each).otherwise(bare)).alias("r"))
            .select("course_id", "path", F.coalesce(F.col("r.pos") == 0, F.lit(True)).alias("first"), "r.m", "prefix", "r.skills",
                    *lesson_columns(F.col("r.p"), F.col("r.pos"))))


def staged_catalog(manifests: DataFrame, path: str) -> dict[str, DataFrame]:
    """catalog_tables over one staged copy of the parsed manifests, written in one pass over their texts. Of manifests that claim one course the one
    of the smallest path counts; the others are flagged in the table `repeated_courses`. `manifests` has what is beside the lessons, `published_lessons`
    lessons with their skills and their course's prefix."""
    rows = stage(catalog_rows(manifests), f"{path}/rows")
    every, lessons = rows.filter("first").select("course_id", "path", "m"), rows.filter("lesson_pos IS NOT NULL").drop("first", "m")
    twice = stage(repeated_courses(every), f"{path}/repeated")
    kept, others = one_per_course(every, twice)
    if twice.isEmpty():  # no row need be looked up
        kept = every
    else:
        lessons = one_per_course(lessons, twice)[0]
    return {**catalog_tables(kept, lessons.select("course_id", *LESSON_COLUMNS)), "manifests": kept, "repeated_courses": others, "published_lessons": lessons.drop("path")}
