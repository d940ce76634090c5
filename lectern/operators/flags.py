"""The one shape every rule returns: flags(course_id, check_name, rule, severity, subject, detail)."""
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HARD, ADVISORY = "HARD", "advisory"
COLUMNS = ["course_id", "check_name", "rule", "severity", "subject", "detail"]


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(value).cast("string")


def flag(df: DataFrame, check: str, rule: str | Column, severity, subject, detail="") -> DataFrame:
    return df.select(
        F.col("course_id").cast("string").alias("course_id"),
        F.lit(check).alias("check_name"),
        F.lit(rule).alias("rule"),
        _text(severity).alias("severity"),
        F.coalesce(_text(subject), F.lit("")).alias("subject"),
        F.coalesce(_text(detail), F.lit("")).alias("detail"),
    )


def finding(condition: Column, rule: str, severity, subject, detail="") -> Column:
    """One finding inside a row: a struct where the condition holds, else null."""
    return F.when(condition, F.struct(
        F.lit(rule).alias("rule"), _text(severity).alias("severity"),
        F.coalesce(_text(subject), F.lit("")).alias("subject"), F.coalesce(_text(detail), F.lit("")).alias("detail")))


def gathered(*findings: Column, lists: tuple[Column, ...] = ()) -> Column:
    """All findings of a row as one array; `lists` are arrays of findings."""
    parts = [F.array_compact(F.array(*findings))] if findings else []
    parts += [F.coalesce(x, F.array().cast(FINDINGS)) for x in lists]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def exploded(df: DataFrame, check: str, findings: Column) -> DataFrame:
    # The outer form keeps the optimizer from testing the array (and so computing it) a second time below.
    rows = df.select(F.col("course_id").cast("string").alias("course_id"), F.explode_outer(findings).alias("f")).filter("f is not null")
    return rows.select("course_id", F.lit(check).alias("check_name"), "f.rule", "f.severity", "f.subject", "f.detail")


def emit(df: DataFrame, check: str, *findings: Column, lists: tuple[Column, ...] = ()) -> DataFrame:
    """Flags of all findings of a row in one pass over df."""
    return exploded(df, check, gathered(*findings, lists=lists))


FINDINGS = "array<struct<rule:string,severity:string,subject:string,detail:string>>"


def union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
