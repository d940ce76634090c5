"""From flags to a decision."""
from pyspark.sql import DataFrame, functions as F

from lectern.operators.flags import ADVISORY, HARD


def gate(flags: DataFrame, courses: DataFrame) -> DataFrame:
    """One row per course, flagged or not: FAIL if any flag is HARD."""
    counts = flags.groupBy("course_id").agg(
        F.count_if(F.col("severity") == HARD).alias("hard"), F.count_if(F.col("severity") == ADVISORY).alias("advisory"))
    zero = F.lit(0).cast("bigint")
    return (courses.select(F.col("course_id").cast("string").alias("course_id")).distinct().join(counts, "course_id", "left")
            .select("course_id", F.coalesce("hard", zero).alias("hard"), F.coalesce("advisory", zero).alias("advisory"))
            .withColumn("verdict", F.when(F.col("hard") > 0, "FAIL").otherwise("PASS")))


def check_verdicts(flags: DataFrame) -> DataFrame:
    return flags.groupBy("course_id", "check_name").agg(
        F.max(F.when(F.col("severity") == HARD, "FAIL").otherwise("ADVISORY")).alias("verdict"), F.count("*").alias("flags"))


def suite_report(flags: DataFrame) -> DataFrame:
    """Flags and courses per check and rule, with subtotals ('all')."""
    # Counting courses first keeps the roll-up free of distinct sets.
    per_course = flags.groupBy("check_name", "rule", "course_id").agg(F.count("*").alias("n"))
    per_rule = per_course.groupBy("check_name", "rule").agg(F.sum("n").alias("flags"), F.count("*").alias("courses"))
    return (per_rule.rollup("check_name", "rule").agg(F.sum("flags").alias("flags"), F.sum("courses").alias("rule_courses"))
            .select(F.coalesce("check_name", F.lit("all")).alias("check_name"), F.coalesce("rule", F.lit("all")).alias("rule"),
                    "flags", "rule_courses"))


def severity_matrix(flags: DataFrame) -> DataFrame:
    return flags.groupBy("check_name").pivot("severity", [HARD, ADVISORY]).count().na.fill(0)
