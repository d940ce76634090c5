"""Rules on a course as a whole: ladder, schedule, capstone, length, outcomes, research, artifacts, routing."""
from pyspark.sql import DataFrame, Window, functions as F

from lectern import vocab
from lectern.operators.flags import ADVISORY, HARD, flag, union
from lectern.operators.graph import duplicates
from lectern.operators.order import position_key


# ---- ladder: modules(course_id, module_id, pos, rung, band) ------------------------------------

def no_rung(modules: DataFrame) -> DataFrame:
    return flag(modules.filter("rung is null"), "ladder", "no_rung", ADVISORY, F.col("module_id"))


def _before():
    # A course's modules are one array of its document, so this window is as small as that array.
    return Window.partitionBy("course_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)


def ladder_backward(modules: DataFrame) -> DataFrame:
    top = F.max("rung").over(_before())
    climbed = modules.filter("rung is not null").withColumn("top", top)
    return flag(climbed.filter("rung < top"), "ladder", "ladder_backward", HARD, F.col("module_id"),
                F.concat_ws("<", "rung", "top"))


def band_dip(modules: DataFrame) -> DataFrame:
    """Compared with the last band that was set; a module without a rung is skipped."""
    last = F.coalesce(F.last("band", ignorenulls=True).over(_before()), F.lit(0))
    climbed = modules.filter("rung is not null").withColumn("last_band", last)
    return flag(climbed.filter("band < last_band"), "ladder", "band_dip", ADVISORY, F.col("module_id"),
                F.concat_ws("<", "band", "last_band"))


def unscheduled(lessons: DataFrame, weeks: DataFrame, schedule: DataFrame) -> DataFrame:
    """Only courses with a schedule; the schedule's weeks may all be empty."""
    planned = weeks.select("course_id").distinct()
    miss = (lessons.select("course_id", "lesson_id").distinct().join(planned, "course_id", "left_semi")
            .join(schedule.select("course_id", "lesson_id").distinct(), ["course_id", "lesson_id"], "left_anti"))
    return flag(miss, "ladder", "unscheduled", ADVISORY, F.col("lesson_id"))


# ---- capstone, length, outcomes ---------------------------------------------------------------

def capstone_untaught(courses: DataFrame, capstone_skills: DataFrame, teaches: DataFrame) -> DataFrame:
    taught = teaches.select("course_id", "skill").distinct()
    lost = capstone_skills.join(taught, ["course_id", "skill"], "left_anti")
    return union(flag(lost, "capstone", "capstone_untaught", HARD, F.col("skill")),
                 flag(courses.filter("not has_capstone"), "capstone", "no_capstone", ADVISORY, F.col("course_id")))


def length_mismatch(courses: DataFrame) -> DataFrame:
    """courses(course_id, declared_lessons, n_lessons)"""
    return flag(courses.filter("n_lessons > 0 and declared_lessons <> n_lessons"), "length", "length_mismatch", HARD,
                F.col("course_id"), F.concat_ws("<>", "declared_lessons", "n_lessons"))


def unproven_outcomes(outcomes: DataFrame, proofs: DataFrame) -> DataFrame:
    lost = outcomes.select("course_id", "outcome").distinct().join(
        proofs.select("course_id", "outcome").distinct(), ["course_id", "outcome"], "left_anti")
    return flag(lost, "outcomes", "unproven_outcome", HARD, F.col("outcome"))


def unknown_proofs(outcomes: DataFrame, proofs: DataFrame) -> DataFrame:
    lost = proofs.select("course_id", "outcome").distinct().join(
        outcomes.select("course_id", "outcome").distinct(), ["course_id", "outcome"], "left_anti")
    return flag(lost, "outcomes", "unknown_proof", HARD, F.col("outcome"))


def bad_traces(modules: DataFrame, outcomes: DataFrame) -> DataFrame:
    silent = modules.filter(F.coalesce(F.size("traces_to"), F.lit(0)) <= 0)
    known = outcomes.select("course_id", "outcome").distinct()
    lost = (modules.select("course_id", "module_id", F.explode("traces_to").alias("outcome"))
            .join(known, ["course_id", "outcome"], "left_anti"))
    return union(flag(silent, "outcomes", "no_trace", ADVISORY, F.col("module_id")),
                 flag(lost, "outcomes", "unknown_trace", HARD, F.col("module_id"), F.col("outcome")))


# ---- research ---------------------------------------------------------------------------------

def no_research(lessons: DataFrame) -> DataFrame:
    return flag(lessons.filter(F.coalesce(F.to_json("research"), F.lit("{}")) == "{}"), "research", "no_research", ADVISORY, F.col("lesson_id"))


def off_list_claims(claims: DataFrame, surfaces=tuple(vocab.KIT_SURFACES)) -> DataFrame:
    off = (F.col("status") == "verified") & ~F.col("surface").isin(list(surfaces))
    return flag(claims.filter(off), "research", "off_list_claim", HARD,
                F.concat_ws("/", "lesson_id", "claim_id"), F.col("surface"))


# ---- artifacts(course_id, lesson_id, place, artifact_id, consumes, terminal) -------------------

def duplicate_artifacts(artifacts: DataFrame) -> DataFrame:
    return flag(duplicates(artifacts, "artifact_id"), "artifacts", "duplicate_artifact", HARD, F.col("artifact_id"))


def _built_at(artifacts: DataFrame) -> DataFrame:
    """The last lesson that builds an artifact id counts."""
    return (artifacts.groupBy("course_id", F.col("artifact_id").alias("consumed"))
            .agg(F.max(position_key()).alias("built")))


def _uses(artifacts: DataFrame) -> DataFrame:
    uses = artifacts.select("course_id", "lesson_id", "artifact_id", position_key().alias("key"),
                            F.explode("consumes").alias("consumed"))
    return uses.join(_built_at(artifacts), ["course_id", "consumed"], "left")


def unknown_consumes(artifacts: DataFrame) -> DataFrame:
    return flag(_uses(artifacts).filter("built is null"), "artifacts", "unknown_consumes", HARD,
                F.concat_ws("/", "lesson_id", "artifact_id"), F.col("consumed"))


def backward_consumes(artifacts: DataFrame) -> DataFrame:
    return flag(_uses(artifacts).filter("built >= key"), "artifacts", "backward_consumes", HARD,
                F.concat_ws("/", "lesson_id", "artifact_id"), F.col("consumed"))


def consumes_flags(artifacts: DataFrame) -> DataFrame:
    """unknown_consumes and backward_consumes in one join."""
    rule = F.when(F.col("built").isNull(), "unknown_consumes").when(F.col("built") >= F.col("key"), "backward_consumes")
    found = _uses(artifacts).withColumn("rule", rule).filter("rule IS NOT NULL")
    return flag(found, "artifacts", F.col("rule"), HARD, F.concat_ws("/", "lesson_id", "artifact_id"), F.col("consumed"))


def unconsumed(artifacts: DataFrame) -> DataFrame:
    used = _uses(artifacts).filter("built < key").select("course_id", F.col("consumed").alias("artifact_id")).distinct()
    ends = artifacts.groupBy("course_id").agg(F.max(position_key()).alias("end"))
    idle = (artifacts.filter("not terminal").join(used, ["course_id", "artifact_id"], "left_anti")
            .join(ends, "course_id").filter(position_key() < F.col("end")))
    return flag(idle, "artifacts", "unconsumed", ADVISORY, F.concat_ws("/", "lesson_id", "artifact_id"))


def routing_budget(courses: DataFrame, max_guests: int = 2) -> DataFrame:
    """One backbone, at most two guests, one lesson template."""
    rules = F.array(
        F.when(F.coalesce(F.size("backbone"), F.lit(0)) != 1, F.lit("backbone")),
        F.when(F.size("guests") > max_guests, F.lit("guests")),
        F.when(F.col("template").isNull(), F.lit("template")))
    broken = courses.select("course_id", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule"))
    return flag(broken, "routing", "routing_budget", ADVISORY, F.col("course_id"), F.col("rule"))


def ladder_flags(t) -> DataFrame:
    m = t["modules"]
    return union(no_rung(m), ladder_backward(m), band_dip(m), unscheduled(t["lessons"], t["weeks"], t["schedule"]))


def outcome_flags(t) -> DataFrame:
    return union(unproven_outcomes(t["outcomes"], t["proofs"]), unknown_proofs(t["outcomes"], t["proofs"]),
                 bad_traces(t["modules"], t["outcomes"]))


def research_flags(t) -> DataFrame:
    return union(no_research(t["lessons"]), off_list_claims(t["claims"]))


def artifact_flags(t) -> DataFrame:
    a = t["artifacts"]
    return union(duplicate_artifacts(a), consumes_flags(a), unconsumed(a))
