"""The publish projection: ids, slots, skills, blocks, assets, and the rules the target enforces."""
from pyspark.sql import Column, DataFrame, functions as F

from lectern import vocab
from lectern.functions.text import slug
from lectern.operators.flags import ADVISORY, HARD, flag, union
from lectern.operators.order import number_within

OVERRIDABLE = ["slug", "course_id", "prefix", "title", "description", "difficulty", "creator", "duration",
               "xpPerLesson", "xpReward"]


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def course_prefix(course_id: Column, given: Column) -> Column:
    initials = F.array_join(F.transform(F.filter(F.split(course_id, "-", -1), lambda t: t != ""), lambda t: F.substring(t, 1, 1)), "")
    return F.coalesce(_filled(given), F.substring(F.coalesce(_filled(initials), F.lit("c")), 1, 6))


def publish_meta(courses: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """courses(course_id, title, promise, hours, n_lessons, publish struct): override > manifest > default."""
    said = courses
    if overrides is not None:
        given = [c for c in OVERRIDABLE[:1] + OVERRIDABLE[2:] if c in overrides.columns]
        renamed = overrides.select("course_id", *[F.col(c).alias(f"_{c}") for c in given])
        said = courses.join(renamed, "course_id", "left")
    else:
        given = []

    def value(name: str) -> Column:
        own = F.col(f"publish.{name}")
        return F.coalesce(F.col(f"_{name}"), own) if name in given else own

    hours, n = F.col("hours"), F.col("n_lessons")
    duration = (F.when(hours >= 1, F.ceil(hours).cast("double")).when(hours > 0, F.bround(hours, 2))
                .otherwise(n.cast("double")))
    own_slug = F.coalesce(_filled(value("slug")), slug(F.col("course_id")))
    public_id = F.coalesce(_filled(value("course_id")), F.concat(F.lit("course-"), own_slug))
    return said.select(
        "course_id", own_slug.alias("slug"),
        F.regexp_replace(F.substring(public_id, 1, 32), r"-+\z", "").alias("publish_id"),
        course_prefix(F.col("course_id"), value("prefix")).alias("prefix"),
        F.coalesce(_filled(value("title")), F.col("title"), F.col("course_id")).alias("title"),
        F.coalesce(_filled(value("description")), F.col("promise"), F.lit("")).alias("description"),
        F.coalesce(value("difficulty"), F.lit("beginner")).alias("difficulty"),
        F.coalesce(value("duration"), duration).alias("duration"),
        F.coalesce(value("xpPerLesson"), F.lit(20).cast("bigint")).alias("xp_per_lesson"),
        F.coalesce(value("xpReward"), F.least(F.lit(5000), 20 * F.greatest(F.lit(1), n)).cast("bigint")).alias("xp_reward"),
        F.coalesce(value("creator"), F.lit(vocab.DEFAULT_CREATOR)).alias("creator"), n.alias("n_lessons"))


def lesson_publish_id(prefix: Column, lesson_id: Column) -> Column:
    return F.concat(F.lit("lesson-"), prefix, F.lit("-"), slug(lesson_id))


def module_key(module_id: Column) -> Column:
    return slug(F.replace(module_id, F.lit("module-"), F.lit("")))


def assign_slots(lessons: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lessons(course_id, publish_id, lesson_pos), previous(course_id, publish_id, slot, retired).

    Known lessons keep their slot; unseen ones get the numbers after the highest ever given, in course
    order. A lesson that left retires its slot, so no number is given twice.
    """
    key = ["course_id", "publish_id"]
    active = previous.filter("not retired").select(*key, "slot")
    top = previous.groupBy("course_id").agg(F.max("slot").alias("top"))
    fresh = lessons.join(active.select(*key), key, "left_anti")
    ranked = number_within(fresh, ["course_id"], [], "lesson_pos", ["publish_id"], "rank")
    numbered = (ranked.join(top, "course_id", "left")
                .select(*key, (F.coalesce("top", F.lit(-1)) + 1 + F.col("rank")).cast("bigint").alias("slot")))
    kept = active.join(lessons.select(*key), key, "left_semi").select(*key, F.col("slot").cast("bigint").alias("slot"))
    left = active.join(lessons.select(*key), key, "left_anti").select("course_id", "slot")
    retired = left.unionByName(previous.filter("retired").select("course_id", "slot"))
    return kept.unionByName(numbered), retired.select("course_id", F.col("slot").cast("bigint").alias("slot"))


def mapped_skills(teaches: Column, prerequisites: Column, skills_map: Column, default_skills: Column) -> Column:
    """Skills of a lesson from the nodes its module teaches and it asks for, or the course's own if none is mapped."""
    empty = F.array().cast("array<string>")
    nodes = F.concat(F.coalesce(teaches, empty), F.coalesce(prerequisites, empty))
    mapped = F.array_distinct(F.filter(F.transform(nodes, lambda n: F.try_element_at(skills_map, n)), lambda s: F.coalesce(s, F.lit("")) != ""))
    return F.get(F.transform(F.array(mapped), lambda s: F.when(F.size(s) > 0, s).otherwise(F.coalesce(default_skills, empty))), F.lit(0))


def lesson_skills(lessons: DataFrame, modules: DataFrame, courses: DataFrame) -> DataFrame:
    """lessons(course_id, lesson_id, module_id, prerequisites): mapped nodes, first mention kept."""
    first_module = (modules.groupBy("course_id", "module_id")
                    .agg(F.min_by("teaches_skills", "pos").alias("teaches")))
    maps = courses.select("course_id", F.col("publish.skills_map").alias("skills_map"),
                          F.col("publish.default_skills").alias("default_skills"))
    return (lessons.join(first_module, ["course_id", "module_id"], "left").join(maps, "course_id", "left")
            .select("course_id", "lesson_id", mapped_skills(*map(F.col, ("teaches", "prerequisites", "skills_map", "default_skills"))).alias("skills")))


def code_block_key(challenge: Column) -> Column:
    return slug(F.coalesce(challenge["id"], F.lit("exercise")))


def quiz_block_key(block: Column, i: Column) -> Column:
    return slug(F.coalesce(_filled(block["key"]), F.when(i == 0, "check").otherwise(F.concat(F.lit("check-"), (i + 1).cast("string")))))


def lesson_blocks(lessons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ordered blocks of each lesson: prose, runnable challenges, quizzes; and what was skipped."""
    shape = "array<struct<key:string,type:string,language:string>>"
    runnable = F.filter("brief.coding_challenges", lambda c: c["language"].isin(vocab.CHALLENGE_LANGS))
    code = F.transform(runnable, lambda c: F.struct(
        code_block_key(c).alias("key"), F.lit("code").alias("type"), c["language"].alias("language")))
    quiz = F.transform("brief.quiz_blocks", lambda b, i: F.struct(
        quiz_block_key(b, i).alias("key"), F.lit("quiz").alias("type"), F.lit(None).cast("string").alias("language")))
    intro = F.array(F.struct(F.lit("intro").alias("key"), F.lit("prose").alias("type"),
                             F.lit(None).cast("string").alias("language")))
    none = F.array().cast(shape)
    laid = lessons.select("course_id", "lesson_id", F.posexplode(F.concat(
        intro.cast(shape), F.coalesce(code.cast(shape), none), F.coalesce(quiz.cast(shape), none))).alias("pos", "b"))
    skipped = F.filter("brief.coding_challenges",
                       lambda c: ~F.coalesce(c["language"].isin(vocab.CHALLENGE_LANGS), F.lit(False)))
    warnings = (lessons.select("course_id", "lesson_id", F.explode(skipped).alias("c"))
                .select("course_id", "lesson_id", slug(F.coalesce("c.id", F.lit("exercise"))).alias("key"), F.col("c.language").alias("language")))
    return laid.select("course_id", "lesson_id", "pos", "b.*"), warnings


def publish_rules(published: DataFrame, lessons: DataFrame, files: DataFrame, references: DataFrame) -> DataFrame:
    """published(course_id, publish_id, xp_per_lesson, n_lessons), lessons(course_id, publish_id, pos,
    produces, consumes), files and references (course_id, path)."""
    bad_course = ~F.col("publish_id").rlike(r"\Acourse-[a-z0-9-]+\z") | (F.length("publish_id") > 32)
    produced = (lessons.select("course_id", "pos", F.explode("produces").alias("capability"))
                .groupBy("course_id", "capability").agg(F.min("pos").alias("first")))
    needs = lessons.select("course_id", "publish_id", "pos", F.explode("consumes").alias("capability"))
    early = needs.join(produced, ["course_id", "capability"], "left").filter("first is null or first >= pos")
    orphans = files.select("course_id", "path").distinct().join(
        references.select("course_id", "path").distinct(), ["course_id", "path"], "left_anti")
    over = published.filter(F.col("xp_per_lesson") * F.col("n_lessons") > 10000)
    return union(
        flag(published.filter(bad_course), "publish", "bad_course_id", HARD, F.col("publish_id")),
        flag(lessons.filter(~F.col("publish_id").rlike(r"\Alesson-[a-z0-9-]+\z")), "publish", "bad_lesson_id", HARD, F.col("publish_id")),
        flag(over, "publish", "xp_ceiling", HARD, F.col("publish_id"), F.col("xp_per_lesson") * F.col("n_lessons")),
        flag(published.filter(~F.col("xp_per_lesson").between(1, 100)), "publish", "xp_range", HARD,
             F.col("publish_id"), F.col("xp_per_lesson")),
        flag(early, "publish", "consumes_before_produces", HARD, F.col("publish_id"), F.col("capability")),
        flag(orphans, "publish", "orphan_file", HARD, F.col("path")))


def ship_assets(assets: DataFrame) -> DataFrame:
    """assets(course_id, stem, file, bytes) -> what ships: rasters beside the lesson, card sources apart."""
    base, ext = F.regexp_extract("file", r"\A(.*)\.([^.]+)\z", 1), F.lower(F.regexp_extract("file", r"\A(.*)\.([^.]+)\z", 2))
    typed = assets.withColumn("base", base).withColumn("ext", ext)
    webps = (typed.filter((F.col("ext") == "webp") & F.col("file").rlike(r"\Av\d+-"))
             .select("course_id", "stem", "base").distinct().withColumn("newer", F.lit(True)))
    kept = typed.join(webps, ["course_id", "stem", "base"], "left").filter(
        F.col("newer").isNull() | (F.col("ext") != "png"))
    source = (F.col("ext") == "html") & F.col("file").rlike(r"\Av") & ~F.col("file").rlike(r"\.__[\w-]+\.html\z")
    kind = F.when(F.col("ext").isin(vocab.RASTER_EXT), "raster").when(source, "source")
    return kept.withColumn("kind", kind).filter("kind is not null").select("course_id", "stem", "file", "kind", "bytes")


def asset_balance(shipped: DataFrame, prose: DataFrame) -> DataFrame:
    """Image links in the prose against rasters copied, per course."""
    links = prose.select("course_id", F.regexp_count("prose", F.lit(r"\]\(assets/")).cast("bigint").alias("refs"),
                         F.lit(0).cast("bigint").alias("copied"))
    copies = shipped.filter("kind = 'raster'").select("course_id", F.lit(0).cast("bigint").alias("refs"),
                                                      F.lit(1).cast("bigint").alias("copied"))
    return (links.unionByName(copies).groupBy("course_id").agg(F.sum("refs").alias("refs"), F.sum("copied").alias("copied"))
            .withColumn("match", F.col("refs") == F.col("copied")))


def oversize_banners(assets: DataFrame, cap: int = vocab.ASSET_CAP_BYTES) -> DataFrame:
    banner = F.col("file").rlike(r"\Abanner\.(webp|jpe?g)\z")
    return flag(assets.filter(banner & (F.col("bytes") > cap)), "publish", "oversize_banner", ADVISORY, F.col("file"), F.col("bytes"))
