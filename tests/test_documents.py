"""Course trees and publish trees against documents put together by hand."""
import copy
import json

import manifest_kit as kit
import pytest
from pyspark.sql import functions as F

from lectern.operators import documents
from lectern.operators.flatten import catalog_tables
from lectern.operators.publish import publish_meta
from lectern.sources import sinks
from lectern.sources.manifests import parse_manifests


def rich_course():
    m = kit.sound_course()
    m["course"]["extra"] = {"z": [1, 2.5, None, {"k": "é\"\\"}], "a": 12345678901234567890}
    m["modules"][0].update(unknown=[True, {}], lessons=["welcome", "ghost", "welcome", "glass"])
    m["glossary"] = [{"term": "t", "more": {"x": 1}}]
    m["academy"] = {"prefix": "st", "skills_map": {"light": "optics"}, "default_skills": ["any"], "extra_course_keys": {"track": "a\"b", "tier": "1"}}
    glass = kit.lesson(m, "glass")["brief"]
    glass["x"] = {"deep": {"er": [[]]}}
    asked = kit._quiz([kit.question(note={"why": "kept"})])
    glass["quiz_blocks"] = [asked[0], {"questions": None}, {"key": "Own Key"}]
    glass["coding_challenges"] = [
        {"id": "Grind", "language": "rust", "starter": " src/a.rs ", "solution": "src/b.rs", "tests": "", "hints": ["h1", "h2"], "deployable": True, "buildType": "buildable"},
        {"id": "x", "language": "go"}, {"language": "typescript", "starter": "src/a.rs", "buildType": "standard", "deployable": False, "hints": []}]
    kit.lesson(m, "focus")["research"] = {}
    return m


@pytest.fixture(scope="module")
def course(spark):
    bare = {"course": {"id": "bare"}, "lessons": [{"id": "a", "module": "none"}, {"id": "a", "brief": {"title": "Second"}}], "cadence": {}, "assessment": {"x": 0}}
    rows = [("s/manifest.json", json.dumps(rich_course(), ensure_ascii=False)), ("b/manifest.json", json.dumps(bare)), ("e/manifest.json", "{}")]
    return parse_manifests(spark.createDataFrame(rows, "path string, value string"))[0], bare


def test_course_tree_keeps_every_key_of_the_manifest(spark, course, tmp_path):
    manifests, bare = course
    sinks.write_course_tree(manifests, str(tmp_path), buckets=2)
    rows = sinks.read_course_tree(spark, str(tmp_path)).collect()
    m = rich_course()
    got = {x.path: x.doc for x in rows if x.course_id == "stars"}
    read = {p: (json.loads(d) if not p.endswith(".md") else d) for p, d in got.items()}
    stems = {"welcome": "m00-l1-welcome", "glass": "m01-l1-glass", "focus": "m01-l2-focus"}
    modules = copy.deepcopy(m["modules"])
    modules[0]["lesson_files"] = {i: f"../../lessons/briefs/{stems[i]}.brief.yaml" for i in ("welcome", "glass")}
    modules[1]["lesson_files"] = {}
    want = {"manifest.json": m, "cadence.yaml": m["cadence"], "assessment.yaml": m["assessment"],
            "course.yaml": {"schema_version": 1, "course": m["course"], "dag": m["dag"], "glossary": m["glossary"], "concept_ledger": [],
                            "references": {"cadence": "cadence.yaml", "assessment": "assessment.yaml", "state": "_state.yaml", "manifest": "manifest.json"},
                            "modules": ["m-one", "m-two"], "lessons": ["welcome", "glass", "focus"]},
            "modules/00-m-one/module.yaml": {"module": modules[0]}, "modules/01-m-two/module.yaml": {"module": modules[1]}}
    for lesson in m["lessons"]:
        want[f"lessons/briefs/{stems[lesson['id']]}.brief.yaml"] = {"lesson": lesson["brief"]}
        if lesson["research"]:
            want[f"lessons/research/{stems[lesson['id']]}.research.yaml"] = {"research": lesson["research"]}
            want[f"lessons/facts/{stems[lesson['id']]}.facts.md"] = "one fact\n"
    assert read == want
    assert list(read["course.yaml"]["course"]) == list(m["course"]) and list(read["lessons/briefs/m01-l1-glass.brief.yaml"]["lesson"]) == list(kit.lesson(m, "glass")["brief"])
    other = {x.path: json.loads(x.doc) for x in rows if x.course_id == "bare"}
    assert sorted(other) == ["assessment.yaml", "course.yaml", "lessons/briefs/m99-l0-a.brief.yaml", "manifest.json"] and other["manifest.json"] == bare
    assert other["lessons/briefs/m99-l0-a.brief.yaml"] == {"lesson": {"title": "Second"}} and other["course.yaml"]["lessons"] == ["a", "a"]
    assert sum(x.course_id not in ("stars", "bare") for x in rows) == 2  # an empty manifest: itself and a course document


def test_publish_tree_round_trip(spark, course, tmp_path):
    manifests, _ = course
    t = catalog_tables(manifests)
    meta = publish_meta(t["courses"])
    files = spark.createDataFrame([("stars", "src/a.rs"), ("bare", "src/b.rs")], "course_id string, path string")
    docs = documents.lesson_documents(t["lessons"], t["modules"], t["courses"], meta)
    copies = documents.challenge_copies(t["lessons"], files)
    prose = spark.createDataFrame([("stars", "m00-l1-welcome", "# hi\n")], "course_id string, stem string, prose string")
    sinks.write_publish_tree(documents.course_publish_documents(manifests, meta), docs, copies, prose, str(tmp_path), buckets=2)
    back = {x.lesson_id: x for x in sinks.read_lesson_documents(spark, str(tmp_path)).filter("course_id = 'stars'").collect()}
    assert sorted(docs.filter("course_id = 'stars'").select("lesson_id", "doc").collect()) == sorted((x.lesson_id, x.doc) for x in back.values())
    asked = kit._quiz([kit.question(note={"why": "kept"})])[0]["questions"]
    assert json.loads(back["glass"].text) == {
        "id": "lesson-st-glass", "slug": "glass", "title": "About glass", "skills": ["optics"], "blocks": [
            {"key": "intro", "type": "prose", "src": "intro.md"},
            {"key": "grind", "type": "code", "language": "rust", "buildType": "buildable", "deployable": True, "starter": "grind/starter.rs",
             "solution": "grind/solution.rs", "tests": "grind/tests.json", "hints": ["h1", "h2"]},
            {"key": "exercise", "type": "code", "language": "typescript", "starter": "exercise/starter.ts", "solution": "exercise/solution.ts", "tests": "exercise/tests.json"},
            {"key": "check", "type": "quiz", "questions": asked}, {"key": "check-2", "type": "quiz", "questions": []}, {"key": "own-key", "type": "quiz", "questions": []}]}
    assert json.loads(back["focus"].text)["skills"] == ["any"]
    got = {(x.key, x.role): (x.src, x.dest, x.content) for x in copies.collect()}
    assert got == {("grind", "starter"): ("src/a.rs", "lessons/glass/grind/starter.rs", None), ("grind", "solution"): ("src/b.rs", "lessons/glass/grind/solution.rs", ""),
                   ("grind", "tests"): ("", "lessons/glass/grind/tests.json", "[]\n"), ("exercise", "starter"): ("src/a.rs", "lessons/glass/exercise/starter.ts", None),
                   ("exercise", "solution"): ("", "lessons/glass/exercise/solution.ts", ""), ("exercise", "tests"): ("", "lessons/glass/exercise/tests.json", "[]\n")}
    course = json.loads(spark.read.parquet(f"{tmp_path}/courses").filter("course_id = 'stars'").first().text)
    assert course["modules"] == [{"key": "m-one", "title": "One", "lessons": ["lesson-st-welcome"]}, {"key": "m-two", "title": "Two", "lessons": ["lesson-st-glass", "lesson-st-focus"]}]
    assert (course["id"], course["duration"], course["track"], course["tier"], course["xpPerLesson"]) == ("course-stars", 3.0, 'a"b', "1", 20)


@pytest.mark.parametrize("text, filled", [(None, False), ("null", False), (" {} ", False), ("[ ]", False), ('""', False), ("0", False), ("-0.0e5", False), ("false", False),
                                          ("0.5", True), ('{"a":1}', True), ("[0]", True), ('"x"', True), ("true", True)])
def test_what_counts_as_filled(spark, text, filled):
    assert spark.createDataFrame([(text,)], "t string").select(documents.holds(F.col("t"))).first()[0] is filled


def test_files_of_a_course_tree_are_compressed(spark, course, tmp_path):
    sinks.write_course_tree(course[0], str(tmp_path), buckets=2)
    files = [f for f in tmp_path.rglob("part-*")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sinks.read_course_tree(spark, str(tmp_path)).count() == documents.course_documents(course[0]).count()


def test_no_text_of_a_lesson_is_joined(spark, course):
    tables = catalog_tables(course[0])
    docs = documents.lesson_documents(tables["lessons"], tables["modules"], tables["courses"], publish_meta(tables["courses"]))
    plan = docs._jdf.queryExecution().analyzed()
    below = [plan]
    while below and "Join" not in below[0].nodeName():
        below = [below[0].children().apply(i) for i in range(below[0].children().size())]
    side = below[0].children().apply(0)
    while "Join" in side.nodeName() or side.nodeName() == "Project" and "Join" in side.children().apply(0).nodeName():
        side = side.children().apply(0)
    names = {side.output().apply(i).name() for i in range(side.output().size())}
    assert "_blocks" in names and not names & {"raw", "brief"}
