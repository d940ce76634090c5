"""Manifests to tables.

A course is one document, so ordering its lessons and numbering its modules happens in the document's
row, before anything is exploded: none of these tables needs a shuffle.
"""
from pyspark.sql import Column, DataFrame, functions as F

from lectern import schemas, vocab
from lectern.functions.text import is_blank, quiz_stem, stem


def flatten_modules(manifests: DataFrame) -> DataFrame:
    """modules(course_id, module_id, pos, mod_idx, …): mod_idx is the last place of the id."""
    ids = F.transform("m.modules", lambda x: x["id"])
    return (manifests.select("course_id", ids.alias("ids"), F.posexplode("m.modules").alias("pos", "mod"))
            .select("course_id", F.col("mod.id").alias("module_id"), "pos",
                    last_index(F.col("ids"), F.col("mod.id")).alias("mod_idx"),
                    F.coalesce("mod.title", "mod.id").alias("title"), F.col("mod.description").alias("description"),
                    F.col("mod.artifact_rung").alias("rung"), F.col("mod.difficulty_band").alias("band"),
                    F.col("mod.depends_on").alias("depends_on"), F.col("mod.requires_skills").alias("requires_skills"),
                    F.col("mod.teaches_skills").alias("teaches_skills"), F.col("mod.traces_to").alias("traces_to"),
                    F.col("mod.lessons").alias("lesson_ids")))


def last_index(ids: Column, wanted: Column) -> Column:
    from_end = F.array_position(F.reverse(ids), wanted)
    return F.when(from_end > 0, F.size(ids) - from_end).cast("int")


def ordered_lessons(schema: str = schemas.LESSON_PLACE) -> Column:
    """The lessons of a manifest's row in course order: module place, then `order` (0 if absent), then place in the array. Every text is parsed once,
    by a schema that holds at least that of a place; what it gives is the field `l`."""
    def ordered(from_end: Column) -> Column:
        def placed(raw: Column, l: Column, i: Column) -> Column:
            at = F.array_position(from_end, l["module"])
            idx = F.coalesce(F.when(at > 0, F.size(from_end) - at).cast("int"), F.lit(vocab.UNKNOWN_MODULE_POS))
            return F.struct(idx.alias("mod_idx"), F.coalesce(l["order"], F.lit(0)).cast("bigint").alias("ord"), i.alias("array_pos"),
                            raw.alias("raw"), l["id"].alias("id"), l["module"].alias("module"), l.alias("l"))
        return F.array_sort(F.transform("m.lessons", lambda raw, i: F.get(F.transform(F.array(F.from_json(raw, schema)), lambda l: placed(raw, l, i)), F.lit(0))))
    # The ids are turned round once for all lessons of a row.
    return F.get(F.transform(F.array(F.reverse("m.modules.id")), ordered), F.lit(0))


LESSON_COLUMNS = ["lesson_id", "module_id", "mod_idx", "ord", "array_pos", "lesson_pos", "raw", "brief", "research"]


def lesson_columns(place: Column, pos: Column) -> list[Column]:
    """LESSON_COLUMNS of an element of ordered_lessons(schemas.LESSON) and its place."""
    l = place["l"]
    columns = [l["id"], l["module"], place["mod_idx"], place["ord"], place["array_pos"], pos, place["raw"], l["brief"], l["research"]]
    return [c.alias(name) for c, name in zip(columns, LESSON_COLUMNS)]


def order_lessons(manifests: DataFrame) -> DataFrame:
    """lessons in course order, parsed."""
    return (manifests.select("course_id", F.posexplode(ordered_lessons(schemas.LESSON)).alias("pos", "p"))
            .select("course_id", *lesson_columns(F.col("p"), F.col("pos"))))


PLACE = ["mod_idx", "ord", "array_pos"]


def with_defaults(lessons: DataFrame) -> DataFrame:
    """briefs(course_id, lesson_id, place, kind, declared_kind, raw, brief)"""
    declared = F.coalesce("brief.kind", F.lit("build"))
    return lessons.select(
        "course_id", "lesson_id", *PLACE, declared.alias("declared_kind"),
        F.when(declared.isin(vocab.LESSON_KINDS), declared).otherwise("build").alias("kind"), "raw", "brief")


def stems(lessons: DataFrame) -> DataFrame:
    """File stems of every lesson: stems(course_id, lesson_id, stem, quiz_stem, kind, opener)."""
    known = F.when(F.col("mod_idx") < vocab.UNKNOWN_MODULE_POS, F.col("mod_idx"))
    return lessons.select(
        "course_id", "lesson_id", stem(known, F.col("ord"), F.col("lesson_id")).alias("stem"),
        quiz_stem(known, F.col("ord"), F.col("lesson_id")).alias("quiz_stem"),
        F.coalesce("brief.kind", F.lit("build")).alias("kind"), (F.col("lesson_pos") == 0).alias("opener"))


def flatten_prereqs(lessons: DataFrame, nodes: DataFrame) -> DataFrame:
    """prereqs(…, pre, kind): a lesson id first, else a skill node, else unknown."""
    named = lessons.select("course_id", "lesson_id", *PLACE, F.explode("brief.prerequisites").alias("pre"))
    return resolve_prereqs(named, lessons, nodes)


def resolve_prereqs(named: DataFrame, lessons: DataFrame, nodes: DataFrame) -> DataFrame:
    names = (lessons.select("course_id", F.col("lesson_id").alias("pre"), F.lit("lesson").alias("kind"))
             .unionByName(nodes.select("course_id", F.col("node").alias("pre"), F.lit("skill").alias("kind")))
             .groupBy("course_id", "pre").agg(F.min("kind").alias("kind")))
    return (named.join(names, ["course_id", "pre"], "left")
            .withColumn("kind", F.coalesce("kind", F.lit("unknown"))))


def flatten_skills(modules: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """teaches, requires (course_id, module_id, skill) and first_taught(course_id, skill, at)."""
    teaches = modules.select("course_id", "module_id", "mod_idx", F.explode("teaches_skills").alias("skill"))
    requires = modules.select("course_id", "module_id", "mod_idx", F.explode("requires_skills").alias("skill"))
    return teaches, requires, first_taught(teaches)


def first_taught(teaches: DataFrame) -> DataFrame:
    return teaches.groupBy("course_id", "skill").agg(F.min("mod_idx").alias("at"))


def flatten_dag(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    nodes = manifests.select("course_id", F.posexplode("m.dag.nodes").alias("pos", "node"))
    edges = (manifests.select("course_id", F.explode("m.dag.edges").alias("e"))
             .select("course_id", F.get("e", F.lit(0)).alias("src"), F.get("e", F.lit(1)).alias("dst")))
    return nodes, edges


def flatten_quiz(lessons: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """quiz_blocks, questions (options still an array) and options(…, pos)."""
    blocks = (lessons.select("course_id", "lesson_id", F.posexplode("brief.quiz_blocks").alias("block", "b"))
              .select("course_id", "lesson_id", "block", F.col("b.key").alias("key"),
                      F.col("b.questions").alias("questions")))
    questions = (blocks.select("course_id", "lesson_id", "block", F.posexplode("questions").alias("q_pos", "q"))
                 .select("course_id", "lesson_id", "block", "q_pos",
                         F.concat_ws("#", "lesson_id", "block", "q_pos").alias("question"),
                         F.col("q.id").alias("q_id"), F.col("q.prompt").alias("prompt"),
                         F.coalesce("q.multiSelect", F.lit(False)).alias("multi"),
                         F.coalesce("q.options", F.array().cast(
                             "array<struct<id:string,label:string,correct:boolean,feedback:string>>")).alias("options"),
                         F.col("q.explanation").alias("explanation")))
    return blocks, questions, explode_options(questions)


def explode_options(questions: DataFrame) -> DataFrame:
    return (questions.select("course_id", "question", "q_id", "multi", F.posexplode("options").alias("pos", "o"))
            .select("course_id", "question", "q_id", "multi", "pos", F.col("o.id").alias("o_id"),
                    F.coalesce("o.correct", F.lit(False)).alias("correct"),
                    F.coalesce("o.label", F.lit("")).alias("label")))


def flatten_challenges(lessons: DataFrame) -> DataFrame:
    return (lessons.select("course_id", "lesson_id", F.posexplode("brief.coding_challenges").alias("pos", "c"))
            .select("course_id", "lesson_id", "pos", "c.*").withColumnRenamed("id", "challenge_id"))


def flatten_claims(lessons: DataFrame) -> DataFrame:
    return (lessons.select("course_id", "lesson_id", F.explode("research.claims").alias("c"))
            .select("course_id", "lesson_id", F.col("c.id").alias("claim_id"), F.col("c.status").alias("status"),
                    F.coalesce("c.mcp", F.lit("")).alias("surface")))


def flatten_facts(lessons: DataFrame) -> DataFrame:
    return lessons.select("course_id", "lesson_id", F.posexplode("research.frozen_facts").alias("pos", "fact"))


def flatten_artifacts(lessons: DataFrame) -> DataFrame:
    """artifacts(course_id, lesson_id, place, artifact_id, consumes, terminal)"""
    a = F.col("brief.artifact")
    return (lessons.filter(F.coalesce(a["id"], F.lit("")) != "")
            .select("course_id", "lesson_id", *PLACE, a["id"].alias("artifact_id"), a["consumes"].alias("consumes"),
                    (F.coalesce(a["terminal"], F.lit("")) != "").alias("terminal")))


def flatten_course_lists(manifests: DataFrame) -> dict[str, DataFrame]:
    """The course-level lists: outcomes, proofs, schedule, glossary, concepts, capstone skills."""
    outcomes = manifests.select("course_id", F.explode("m.course.terminal_outcomes.id").alias("outcome"))
    proofs = (manifests.select("course_id", F.explode("m.assessment.proof_matrix").alias("p"))
              .select("course_id", F.col("p.outcome").alias("outcome"), F.col("p.proven_by").alias("proven_by")))
    weeks = manifests.select("course_id", F.posexplode("m.cadence.release.schedule").alias("pos", "w"))
    return {
        "outcomes": outcomes.filter("outcome is not null"),
        "proofs": proofs,
        "weeks": weeks.select("course_id", "pos", F.col("w.week").alias("week")),
        "schedule": weeks.select("course_id", F.col("w.week").alias("week"),
                                 F.explode("w.publish").alias("lesson_id")),
        "glossary": manifests.select("course_id", F.explode("m.glossary").alias("g")).select("course_id", "g.*"),
        "concepts": manifests.select("course_id", F.explode("m.concept_ledger").alias("g")).select("course_id", "g.*"),
        "capstone_skills": manifests.select("course_id",
                                            F.explode("m.assessment.capstone.requires_skills").alias("skill")),
    }


def course_rows(manifests: DataFrame) -> DataFrame:
    cap = F.col("m.assessment.capstone")
    has_capstone = F.coalesce(F.to_json(cap) != "{}", F.lit(False))  # absent and empty are the same
    return manifests.select(
        "course_id", F.col("m.course.id").alias("id"), F.col("m.course.title").alias("title"),
        F.col("m.course.one_line_promise").alias("promise"), F.col("m.course.length_target.hours").alias("hours"),
        F.col("m.course.length_target.lessons").alias("declared_lessons"),
        F.coalesce(F.size("m.lessons"), F.lit(0)).cast("bigint").alias("n_lessons"), has_capstone.alias("has_capstone"),
        F.col("m.course.routing.backbone_pattern").alias("backbone"),
        F.col("m.course.routing.guest_patterns").alias("guests"),
        F.col("m.course.routing.lesson_template").alias("template"), F.col("m.academy").alias("publish"))


def catalog_texts(manifests: DataFrame) -> DataFrame:
    """Texts that stand in a manifest beside its lessons: covers, modules, outcomes, the glossary."""
    def texts(items: Column, subject: str, *fields: tuple[str, str]) -> Column:
        return F.flatten(F.transform(items, lambda x: F.array(*[F.struct(
            F.lit(field).alias("field"), x[subject].cast("string").alias("subject"), x[name].cast("string").alias("text")) for field, name in fields])))

    cover = F.array(F.struct(F.lit("course_overview").alias("field"), F.col("course_id").cast("string").alias("subject"),
                             F.col("m.course.overview").alias("text")))
    lists = [cover, texts(F.col("m.modules"), "id", ("module_title", "title"), ("module_description", "description"), ("module_question", "driving_question"),
                          ("module_artifact", "artifact")),
             F.transform("m.modules", lambda x: F.struct(F.lit("module_outcome").alias("field"), x["id"].alias("subject"), x["outcome"]["statement"].alias("text"))),
             texts(F.col("m.course.terminal_outcomes"), "id", ("outcome", "statement")), texts(F.col("m.glossary"), "term", ("glossary_term", "term"), ("glossary_def", "def"))]
    none = F.array().cast("array<struct<field:string,subject:string,text:string>>")
    return (manifests.select("course_id", F.explode(F.concat(*[F.coalesce(x, none) for x in lists])).alias("t")).select("course_id", "t.field", "t.subject", "t.text")
            .filter(~is_blank(F.col("text"))))


def text_fields(lessons: DataFrame, courses: DataFrame, drafts: DataFrame, manifests: DataFrame | None = None) -> DataFrame:
    """Every text a learner may read: text_fields(course_id, field, subject, text). manifests adds catalog_texts."""
    brief_fields = ["title", "hook", "concept_spec", "artifact_spec", "exercise_spec", "the_tradeoff"]
    from_briefs = lessons.select("course_id", F.col("lesson_id").alias("subject"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"brief.{f}").alias("text")) for f in brief_fields])).alias("t"))
    quiz = F.flatten(F.transform(F.flatten(F.transform("brief.quiz_blocks", lambda b: b["questions"])), lambda q: F.concat(
        F.array(F.struct(F.lit("quiz_prompt").alias("field"), q["prompt"].alias("text")),
                F.struct(F.lit("quiz_explanation").alias("field"), q["explanation"].alias("text"))),
        F.transform(q["options"], lambda o: F.struct(F.lit("quiz_label").alias("field"), o["label"].alias("text"))),
        F.transform(q["options"], lambda o: F.struct(F.lit("quiz_feedback").alias("field"), o["feedback"].alias("text"))))))
    code = F.flatten(F.transform("brief.coding_challenges", lambda c: F.concat(
        F.array(F.struct(F.lit("challenge_title").alias("field"), c["title"].alias("text")), F.struct(F.lit("challenge_prompt").alias("field"), c["prompt"].alias("text"))),
        F.transform(F.coalesce(c["hints"], F.array().cast("array<string>")), lambda h: F.struct(F.lit("challenge_hint").alias("field"), h.alias("text"))))))
    goals = F.transform("brief.objectives", lambda o: F.struct(F.lit("objective").alias("field"), o["statement"].alias("text")))
    from_quiz = (lessons.select("course_id", F.col("lesson_id").alias("subject"), F.explode(quiz).alias("t"))
                 .unionByName(lessons.select("course_id", F.col("lesson_id").alias("subject"), F.explode(code).alias("t")))
                 .unionByName(lessons.select("course_id", F.col("lesson_id").alias("subject"), F.explode(goals).alias("t"))))
    from_courses = courses.select("course_id", F.col("course_id").alias("subject"), F.explode(F.array(
        F.struct(F.lit("course_title").alias("field"), F.col("title").alias("text")),
        F.struct(F.lit("course_promise").alias("field"), F.col("promise").alias("text")))).alias("t"))
    from_drafts = drafts.select("course_id", F.col("stem").alias("subject"), F.struct(
        F.lit("draft").alias("field"), F.col("md").alias("text")).alias("t"))
    together = from_briefs.unionByName(from_quiz).unionByName(from_courses).unionByName(from_drafts)
    texts = together.select("course_id", "t.field", "subject", "t.text").filter(~is_blank(F.col("text")))
    return texts if manifests is None else texts.unionByName(catalog_texts(manifests))


def catalog_tables(manifests: DataFrame, lessons: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables the rules read; `lessons` may come from a staged copy."""
    lessons = order_lessons(manifests) if lessons is None else lessons
    modules, courses = flatten_modules(manifests), course_rows(manifests)
    nodes, edges = flatten_dag(manifests)
    teaches, requires, first = flatten_skills(modules)
    blocks, questions, options = flatten_quiz(lessons)
    ids = (courses.select("course_id", F.lit("course").alias("kind"), "id")
           .unionByName(modules.select("course_id", F.lit("module").alias("kind"), F.col("module_id").alias("id")))
           .unionByName(lessons.select("course_id", F.lit("lesson").alias("kind"), F.col("lesson_id").alias("id"))))
    return {
        "courses": courses, "modules": modules, "lessons": lessons, "briefs": with_defaults(lessons),
        "stems": stems(lessons), "ids": ids, "nodes": nodes, "edges": edges,
        "graphs": manifests.select("course_id", F.col("m.dag.nodes").alias("nodes"), F.col("m.dag.edges").alias("edges")),
        "module_deps": modules.select("course_id", "module_id", F.explode("depends_on").alias("dep")),
        "module_skills": requires.unionByName(teaches).drop("mod_idx"),
        "teaches": teaches, "requires": requires, "first_taught": first,
        "prereqs": flatten_prereqs(lessons, nodes), "quiz_blocks": blocks, "questions": questions, "options": options,
        "challenges": flatten_challenges(lessons), "claims": flatten_claims(lessons), "facts": flatten_facts(lessons),
        "artifacts": flatten_artifacts(lessons), **flatten_course_lists(manifests),
    }
