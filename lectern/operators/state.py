"""Progress and change: hash drift, the state ledger, the next lesson, stale claims, frozen facts."""
from pyspark.sql import DataFrame, functions as F

from lectern import vocab
from lectern.functions.text import stem
from lectern.operators.flags import HARD, flag
from lectern.operators.order import position_key

FILE = ["course_id", "path"]


def drift(planned: DataFrame, on_disk: DataFrame, lock: DataFrame, force: bool = False) -> DataFrame:
    """planned, on_disk (…, path, content), lock(…, path, sha256) -> what to do and the new lock row.

    A file whose hash left the lock was edited by a person and is skipped, unless forced.
    """
    disk = on_disk.select(*FILE, F.sha2("content", 256).alias("disk_sha"))
    known = lock.select(*FILE, F.col("sha256").alias("lock_sha"))
    edited = F.coalesce(F.col("disk_sha") != F.col("lock_sha"), F.lit(False)) & F.lit(not force)
    return (planned.select(*FILE, F.sha2("content", 256).alias("plan_sha")).join(disk, FILE, "left").join(known, FILE, "left")
            .select(*FILE, F.when(edited, "skip").otherwise("write").alias("action"),
                    F.when(edited, F.col("disk_sha")).otherwise(F.col("plan_sha")).alias("sha256"),
                    edited.alias("edited_by_human")))


def state_ledger(lessons: DataFrame, prereqs: DataFrame, drafted: DataFrame) -> DataFrame:
    """lessons(course_id, lesson_id, place, research_verified), prereqs(…, lesson_id, pre, pre_pos) of kind
    lesson, drafted(course_id, lesson_id) -> ledger(…, status, blocked_by)."""
    key = ["course_id", "lesson_id"]
    done = drafted.select(*key).distinct().withColumn("drafted", F.lit(True))
    waiting = (prereqs.join(done.select("course_id", F.col("lesson_id").alias("pre")), ["course_id", "pre"], "left_anti")
               .groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pre_pos", "pre"))),
                                              lambda p: p["pre"]).alias("blocked_by")))
    status = (F.when(F.col("drafted"), "drafted").when(F.col("research_verified"), "researched").otherwise("briefed"))
    return (lessons.join(done, key, "left").join(waiting, key, "left")
            .select(*key, "mod_idx", "ord", "array_pos", status.alias("status"),
                    F.coalesce("blocked_by", F.array().cast("array<string>")).alias("blocked_by")))


def ledger_rows(lessons: DataFrame, drafted: DataFrame) -> DataFrame:
    """The ledger of a catalog's lessons, as in its state file: lessons as ordered (with brief and research), drafted(course_id, stem) the drafts that are
    there -> course_id, no, lesson_id, module_id, status, dominant_job, the paths of its files (null where there is none) and blocked_by.

    Of lessons with one id the last names the files. A prerequisite blocks if it is a lesson without a draft; order is that of the brief.
    """
    key = ["course_id", "lesson_id"]
    known = F.when(F.col("mod_idx") < vocab.UNKNOWN_MODULE_POS, F.col("mod_idx"))
    there = drafted.select("course_id", "stem").distinct().withColumn("drafted", F.lit(True))
    names = (lessons.groupBy(*key).agg(F.max_by(stem(known, F.col("ord"), F.col("lesson_id")), "lesson_pos").alias("stem"))
             .join(there, ["course_id", "stem"], "left").withColumn("drafted", F.coalesce("drafted", F.lit(False))))
    open_ones = names.filter("NOT drafted").select("course_id", F.col("lesson_id").alias("pre"))
    waiting = (lessons.select("course_id", "lesson_pos", F.posexplode("brief.prerequisites").alias("at", "pre")).join(open_ones, ["course_id", "pre"])
               .groupBy("course_id", "lesson_pos").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "pre"))), lambda p: p["pre"]).alias("blocked_by")))
    researched = F.coalesce(F.to_json("research"), F.lit("{}")) != "{}"

    def path(folder: str, end: str, where):
        return F.when(where, F.concat(F.lit(f"lessons/{folder}/"), F.col("stem"), F.lit(end)))
    return (lessons.join(names, key).join(waiting, ["course_id", "lesson_pos"], "left").select(
        "course_id", (F.col("lesson_pos") + 1).cast("bigint").alias("no"), "lesson_id", "module_id",
        F.when(F.col("drafted"), "drafted").when(F.col("research.status") == "verified", "researched").otherwise("briefed").alias("status"),
        F.col("brief.dominant_job").alias("dominant_job"), path("briefs", ".brief.yaml", F.lit(True)).alias("brief_file"),
        path("research", ".research.yaml", researched).alias("research_file"),
        path("facts", ".facts.md", researched & (F.size("research.frozen_facts") > 0)).alias("facts_file"), path("drafts", ".md", F.col("drafted")).alias("draft_file"),
        F.coalesce("blocked_by", F.array().cast("array<string>")).alias("blocked_by")))


def lifecycle_counts(ledger: DataFrame) -> DataFrame:
    """One row per course; every step of the life cycle has its column."""
    return ledger.groupBy("course_id").agg(
        F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in vocab.LIFECYCLE])


def next_lesson(ledger: DataFrame) -> DataFrame:
    open_now = ledger.filter((F.size("blocked_by") == 0) & (F.col("status") != "drafted"))
    return open_now.groupBy("course_id").agg(F.min_by("lesson_id", position_key()).alias("next_to_write"))


def syllabus(lessons: DataFrame, modules: DataFrame) -> DataFrame:
    """lessons(course_id, lesson_id, module_id, lesson_pos, title, job, difficulty) -> numbered rows."""
    titles = modules.groupBy("course_id", "module_id").agg(F.max_by("title", "pos").alias("module_title"))
    return (lessons.join(titles, ["course_id", "module_id"], "left")
            .select("course_id", (F.col("lesson_pos") + 1).cast("bigint").alias("no"),
                    F.coalesce("title", "lesson_id").alias("lesson"), F.coalesce("module_title", "module_id").alias("module"),
                    F.col("job"), F.coalesce(F.col("difficulty").cast("string"), F.lit("?")).alias("difficulty")))


def module_cover(modules: DataFrame) -> DataFrame:
    """Cover map: modules(course_id, module_id, pos, title)."""
    return modules.select("course_id", (F.col("pos") + 1).cast("bigint").alias("no"), "title")


def stale_claims(claims: DataFrame, policy: DataFrame, today) -> DataFrame:
    """claims(course_id, lesson_id, claim_id, kind, checked_on), policy(course_id, days, lesson_id)."""
    aged = claims.filter("kind = 'onchain'").join(policy, ["course_id", "lesson_id"])
    return flag(aged.filter(F.date_add("checked_on", F.col("days").cast("int")) < F.lit(today).cast("date")), "research",
                "stale_claim", HARD, F.concat_ws("/", "lesson_id", "claim_id"), F.col("checked_on").cast("string"))


def facts_present(facts: DataFrame, drafts: DataFrame) -> DataFrame:
    """facts(course_id, stem, pos, fact): each must stand in its draft word for word."""
    lost = facts.join(drafts, ["course_id", "stem"]).filter(~F.contains("md", F.col("fact")))
    return flag(lost, "drafts", "fact_absent", HARD, F.col("stem"), F.col("pos"))
