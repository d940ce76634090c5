"""The documents of a course, assembled bottom-up in the manifest's own row.

Parts are cut from the manifest's text, so unknown keys, key order, values and integers of any length stay; only what a document adds is composed. Nothing is shuffled but the one row per course that publishing metadata adds and the paths of challenge files.
"""
from pyspark.sql import Column, DataFrame, functions as F

from lectern import vocab
from lectern.functions.text import JSON_OPTIONS, module_slug, slug, stem, strip
from lectern.operators.flatten import last_index, ordered_lessons
from lectern.operators.publish import code_block_key, lesson_publish_id, lesson_skills, module_key, quiz_block_key

# The manifest and a lesson as texts of their parts.
PARTS = ("schema_version STRING, course STRING, dag STRING, glossary STRING, concept_ledger STRING, modules ARRAY<STRING>, cadence STRING, "
         "assessment STRING")
LESSON_PARTS = "id STRING, brief STRING, research STRING"
QUESTIONS = "brief STRUCT<quiz_blocks: ARRAY<STRUCT<questions: STRING>>>"
DOCUMENT = "ARRAY<STRUCT<kind: STRING, subject: STRING, path: STRING, doc: STRING>>"
# Names of the files a course document refers to.
REFERENCES = '{"cadence":"cadence.yaml","assessment":"assessment.yaml","state":"_state.yaml","manifest":"manifest.json"}'


def json_object(**members: Column) -> Column:
    """An object of JSON texts, in the order given."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def with_member(obj: Column, name: str, value: Column) -> Column:
    """The text of an object with one more member at its end; as the last of its name it counts."""
    inner = F.btrim(F.regexp_extract(obj, r"(?s)\A\s*\{(.*)\}\s*\z", 1))
    return F.concat(F.lit("{"), inner, F.when(inner == "", F.lit("")).otherwise(F.lit(",")), F.lit(f'"{name}":'), value, F.lit("}"))


def holds(text: Column) -> Column:
    """Whether a JSON text is there and is not null, false, zero or empty."""
    return F.coalesce(~text.rlike(r'\A\s*(?:null|false|-?0+(?:\.0*)?(?:[eE][-+]?\d+)?|""|\{\s*\}|\[\s*\])\s*\z'), F.lit(False))


def _file(kind: str, subject: Column, path: Column, doc: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), subject.cast("string").alias("subject"), path.alias("path"), doc.alias("doc"))


def _stem(l: Column) -> Column:
    return stem(F.when(l["mod_idx"] < vocab.UNKNOWN_MODULE_POS, l["mod_idx"]), l["ord"], l["id"])


def course_documents(manifests: DataFrame) -> DataFrame:
    """manifests(course_id, raw, m) -> documents(course_id, kind, subject, path, doc): every file of a course tree with its content.

    Of lessons or modules with one id, the last one is written, as all share one path.
    """
    p = F.from_json("raw", PARTS, JSON_OPTIONS)
    rows = (manifests.withColumn("p", p).withColumn("ordered", ordered_lessons())
            .withColumn("ids", F.transform("m.modules", lambda x: x["id"])).withColumn("lesson_ids", F.transform("ordered", lambda l: l["id"])))
    last = F.filter("ordered", lambda l, i: last_index(F.col("lesson_ids"), l["id"]) == i)
    rows = rows.withColumn("last", last)
    # Every lesson text is read once; its parts then serve three kinds of files.
    rows = rows.withColumn("read", F.transform("last", lambda l: F.struct(l["id"].alias("id"), _stem(l).alias("stem"), F.from_json(l["raw"], LESSON_PARTS, JSON_OPTIONS).alias("l"))))
    course = json_object(
        schema_version=F.coalesce("p.schema_version", F.lit("1")), course=F.coalesce("p.course", F.lit("{}")), dag=F.coalesce("p.dag", F.lit("{}")),
        glossary=F.coalesce("p.glossary", F.lit("[]")), concept_ledger=F.coalesce("p.concept_ledger", F.lit("[]")), references=F.lit(REFERENCES),
        modules=F.coalesce(F.to_json("ids"), F.lit("[]")), lessons=F.coalesce(F.to_json("lesson_ids"), F.lit("[]")))
    cid = F.col("course_id")

    def module_file(raw: Column, i: Column) -> Column:
        mod = F.get("m.modules", i)
        known = F.filter(F.array_distinct(F.coalesce(mod["lessons"], F.array().cast("array<string>"))), lambda x: F.array_contains("lesson_ids", x))
        named = F.transform(known, lambda x: F.struct(x.alias("k"), F.concat(
            F.lit("../../lessons/briefs/"), F.get(F.filter("read", lambda l: l["id"] == x), F.lit(0))["stem"], F.lit(".brief.yaml")).alias("v")))
        doc = json_object(module=with_member(raw, "lesson_files", F.to_json(F.map_from_entries(named))))
        path = F.concat(F.format_string("modules/%02d-", i), module_slug(mod["id"]), F.lit("/module.yaml"))
        return F.when(last_index(F.col("ids"), mod["id"]) == i, _file("module", mod["id"], path, doc))

    def under(folder: str, end: str):
        return lambda l: F.concat(F.lit(f"lessons/{folder}/"), l["stem"], F.lit(end))

    briefs = F.transform("read", lambda l: _file("brief", l["id"], under("briefs", ".brief.yaml")(l), json_object(lesson=F.coalesce(l["l"]["brief"], F.lit("null")))))
    research = F.transform("read", lambda l: F.when(holds(l["l"]["research"]), _file(
        "research", l["id"], under("research", ".research.yaml")(l), json_object(research=l["l"]["research"]))))

    def fact_file(l: Column) -> Column:
        facts = F.from_json(l["l"]["research"], "frozen_facts ARRAY<STRING>", JSON_OPTIONS)["frozen_facts"]
        return F.when(F.size(facts) > 0, _file("facts", l["id"], under("facts", ".facts.md")(l), F.concat(F.array_join(facts, "\n", "null"), F.lit("\n"))))

    none = F.array().cast(DOCUMENT)
    whole = F.array(_file("course", cid, F.lit("course.yaml"), course), _file("manifest", cid, F.lit("manifest.json"), F.col("raw")),
                    F.when(holds(F.col("p.cadence")), _file("cadence", cid, F.lit("cadence.yaml"), F.col("p.cadence"))),
                    F.when(holds(F.col("p.assessment")), _file("assessment", cid, F.lit("assessment.yaml"), F.col("p.assessment"))))
    lists = [whole, F.transform("p.modules", module_file), briefs, research, F.transform("read", fact_file)]
    return rows.select("course_id", F.explode(F.concat(*[F.coalesce(x.cast(DOCUMENT), none) for x in lists])).alias("f")).filter("f IS NOT NULL").select("course_id", "f.*")


# ---- the publish tree ---------------------------------------------------------------------------

BLOCK = ("STRUCT<key: STRING, type: STRING, src: STRING, language: STRING, buildType: STRING, deployable: BOOLEAN, starter: STRING, solution: STRING, "
         "tests: STRING, hints: ARRAY<STRING>, questions: STRING>")
LESSON_DOCUMENT = f"id STRING, slug STRING, title STRING, skills ARRAY<STRING>, blocks ARRAY<{BLOCK}>"
ROLES = ["starter", "solution", "tests"]


def _role_file(role: str, language: Column) -> Column:
    ext = F.lit(".rs")
    for name, value in vocab.SOURCE_EXT.items():
        ext = F.when(language == name, F.lit(value)).otherwise(ext)
    return F.lit("tests.json") if role == "tests" else F.concat(F.lit(role), ext)


def _blocks(brief: Column, questions: Column) -> Column:
    """Blocks of a lesson in order: the prose, runnable challenges, quizzes with their questions as in the manifest's text."""
    def block(**given) -> Column:
        names = [f.split(":")[0].strip() for f in BLOCK[len("STRUCT<"):-1].split(", ")]
        return F.struct(*[given.get(n, F.lit(None)).alias(n) for n in names]).cast(BLOCK)

    def code(c: Column) -> Column:
        key = code_block_key(c)
        files = {role: F.concat(key, F.lit("/"), _role_file(role, c["language"])) for role in ROLES}
        return block(key=key, type=F.lit("code"), language=c["language"], buildType=F.when(~F.coalesce(c["buildType"], F.lit("")).isin("", "standard"), c["buildType"]),
                     deployable=F.when(c["deployable"], F.lit(True)), hints=F.when(F.size(c["hints"]) > 0, c["hints"]), **files)

    def quiz(b: Column, i: Column) -> Column:
        asked = F.get(questions, i)["questions"]
        return block(key=quiz_block_key(b, i), type=F.lit("quiz"), questions=F.when(holds(asked), asked).otherwise(F.lit("[]")))

    runnable = F.filter(brief["coding_challenges"], lambda c: F.coalesce(c["language"].isin(vocab.CHALLENGE_LANGS), F.lit(False)))
    none = F.array().cast(f"ARRAY<{BLOCK}>")
    return F.concat(F.array(block(key=F.lit("intro"), type=F.lit("prose"), src=F.lit("intro.md"))), F.coalesce(F.transform(runnable, code), none),
                    F.coalesce(F.transform(brief["quiz_blocks"], quiz), none))


def _document(doc: Column) -> Column:
    """The text of a lesson document; questions are spliced in as they are."""
    blocks = F.transform(doc["blocks"], lambda b: F.when(b["questions"].isNull(), F.to_json(b)).otherwise(
        with_member(F.to_json(b.dropFields("questions")), "questions", b["questions"])))
    return with_member(F.to_json(doc.dropFields("blocks")), "blocks", F.concat(F.lit("["), F.array_join(blocks, ","), F.lit("]")))


def lesson_documents(lessons: DataFrame, modules: DataFrame | None = None, courses: DataFrame | None = None, meta: DataFrame | None = None) -> DataFrame:
    """One row per lesson: course_id, lesson_id, lesson_pos, path, doc (id, slug, title, skills, blocks) and its text.

    lessons: as ordered, with raw and brief; courses with publish; meta: publish_meta of the courses. Lessons that have their skills and prefix
    (staged as `published_lessons`) are joined with nothing.
    """
    if meta is None:
        asked = F.from_json("raw", QUESTIONS, JSON_OPTIONS)["brief"]["quiz_blocks"]
        return _lesson_documents(lessons.select("course_id", "lesson_id", "lesson_pos", F.col("brief.title").alias("_title"), _blocks(F.col("brief"), asked).alias("_blocks"), "skills", "prefix"))
    named = lessons.withColumn("prerequisites", F.col("brief.prerequisites")).withColumn("_skill_row", F.struct("lesson_pos", "lesson_id"))
    # A lesson is told by its place: ids may repeat.
    skills = lesson_skills(named.select("course_id", F.col("_skill_row").alias("lesson_id"), "module_id", "prerequisites"), modules, courses)
    asked = F.from_json("raw", QUESTIONS, JSON_OPTIONS)["brief"]["quiz_blocks"]
    # Blocks are put together before the join, so that it carries neither briefs nor the texts of lessons. All else is joined first: blocks are dealt once.
    rest = skills.select("course_id", F.col("lesson_id.lesson_pos").alias("lesson_pos"), "skills").join(meta.select("course_id", "prefix"), "course_id")
    rows = (lessons.select("course_id", "lesson_id", "lesson_pos", F.col("brief.title").alias("_title"), _blocks(F.col("brief"), asked).alias("_blocks"))
            .join(rest, ["course_id", "lesson_pos"]))
    return _lesson_documents(rows)


def _lesson_documents(rows: DataFrame) -> DataFrame:
    doc = F.struct(lesson_publish_id(F.col("prefix"), F.col("lesson_id")).alias("id"), slug(F.col("lesson_id")).alias("slug"),
                   F.coalesce("_title", "lesson_id").alias("title"), F.col("skills"), F.col("_blocks").alias("blocks"))
    return (rows.select("course_id", "lesson_id", "lesson_pos", F.concat(F.lit("lessons/"), slug(F.col("lesson_id")), F.lit("/lesson.yaml")).alias("path"), doc.alias("doc"))
            .withColumn("text", _document(F.col("doc"))))


def course_publish_documents(manifests: DataFrame, meta: DataFrame, lessons: DataFrame | None = None) -> DataFrame:
    """The published course document: course_id, doc with its modules and their lessons in course order, and its text.

    lessons: as ordered, where they are staged; then `manifests` need not hold their texts."""
    kept = [F.transform("m.modules", lambda x: F.struct(*[x[f].alias(f) for f in ("id", "title", "description")])).alias("modules"),
            F.col("m.academy.extra_course_keys").alias("extra_course_keys")]
    places = manifests.select("course_id", F.transform(ordered_lessons(), lambda l: F.struct(l["module"].alias("module"), l["id"].alias("id"))).alias("ordered"), *kept)
    if lessons is not None:
        place = F.struct("lesson_pos", F.col("module_id").alias("module"), F.col("lesson_id").alias("id"))
        placed = lessons.groupBy("course_id").agg(F.sort_array(F.collect_list(place)).alias("ordered"))
        places = manifests.select("course_id", *kept).join(placed, "course_id", "left").withColumn("ordered", F.coalesce("ordered", F.array().cast(placed.schema["ordered"].dataType)))
    # Neither lessons nor what else a manifest holds is joined.
    rows = places.join(meta, "course_id")
    modules = F.transform("modules", lambda x: F.struct(
        module_key(x["id"]).alias("key"), F.coalesce(x["title"], x["id"]).alias("title"), F.nullif(x["description"], F.lit("")).alias("description"),
        F.transform(F.filter("ordered", lambda l: l["module"] == x["id"]), lambda l: lesson_publish_id(F.col("prefix"), l["id"])).alias("lessons")))
    doc = F.struct(F.col("publish_id").alias("id"), "slug", "title", F.nullif("description", F.lit("")).alias("description"), "difficulty", "duration",
                   F.col("xp_per_lesson").alias("xpPerLesson"), F.col("xp_reward").alias("xpReward"), "creator",
                   F.coalesce(modules, F.array().cast("array<struct<key:string,title:string,description:string,lessons:array<string>>>")).alias("modules"))
    extra = F.aggregate(F.map_entries(F.coalesce("extra_course_keys", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))),
                        F.to_json("doc"), lambda text, e: F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(","),
                                                                   F.substring(F.to_json(F.create_map(e["key"], e["value"])), 2, 1 << 30)))
    return rows.select("course_id", doc.alias("doc"), "extra_course_keys").withColumn("text", extra).select("course_id", "doc", "text")


def challenge_copies(lessons: DataFrame, files: DataFrame) -> DataFrame:
    """Sources of runnable challenges: course_id, lesson_id, key, role, src, dest, content. content is that of the placeholder where no file
    of files(course_id, path) is at src, else null: the file is copied."""
    each = (lessons.select("course_id", "lesson_id", F.explode("brief.coding_challenges").alias("c"))
            .filter(F.col("c.language").isin(vocab.CHALLENGE_LANGS)).withColumn("key", code_block_key(F.col("c"))))
    roles = each.select("course_id", "lesson_id", "key", F.explode(F.array(*[F.struct(
        F.lit(r).alias("role"), strip(F.coalesce(F.col(f"c.{r}"), F.lit(""))).alias("src"), _role_file(r, F.col("c.language")).alias("file")) for r in ROLES])).alias("r"))
    there = files.select("course_id", F.col("path").alias("src"), F.lit(True).alias("there")).distinct()
    dest = F.concat(F.lit("lessons/"), slug(F.col("lesson_id")), F.lit("/"), F.col("key"), F.lit("/"), F.col("file"))
    return (roles.select("course_id", "lesson_id", "key", "r.*").join(there, ["course_id", "src"], "left")
            .select("course_id", "lesson_id", "key", "role", "src", dest.alias("dest"),
                    F.when(F.col("there").isNull() | (F.col("src") == ""), F.when(F.col("role") == "tests", F.lit("[]\n")).otherwise(F.lit(""))).alias("content")))
