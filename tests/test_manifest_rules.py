import json

import pytest

from lectern.operators.flatten import catalog_tables
from lectern.operators.gate import gate
from lectern.plans.checks import run_checks
from lectern.plans.staging import staged_catalog
from lectern.sources.manifests import parse_manifests, read_manifests
from tests import manifest_kit as kit


@pytest.fixture(scope="module")
def judged(spark, phrases):
    manifests, rejects = parse_manifests(spark.createDataFrame(kit.texts() + [("bad", '{"a": 1} trailing'), ("list", "[1]")], "path string, value string"))
    tables = catalog_tables(manifests)
    flags = run_checks(tables, phrases).collect()
    found = {}
    for f in flags:
        found.setdefault(f.course_id, set()).add(f.rule)
    verdicts = {r.course_id: r.verdict for r in gate(spark.createDataFrame(flags, run_checks(tables, phrases, ["length"]).schema), tables["courses"]).collect()}
    return found, verdicts, {r.path: r.reason for r in rejects.collect()}


def test_sound_course_has_no_flag(judged):
    found, verdicts, _ = judged
    assert found.get("case-sound", set()) == set()
    assert verdicts["case-sound"] == "PASS"


@pytest.mark.parametrize("name", [n for n, (_, rule) in kit.MUTATIONS.items() if rule])
def test_mutation_trips_its_rule(judged, name):
    assert kit.MUTATIONS[name][1] in judged[0]["case-" + name.replace(" ", "-")]


def test_hard_flags_fail_the_gate_and_advisory_flags_do_not(judged):
    _, verdicts, _ = judged
    assert verdicts["case-cycle"] == "FAIL" and verdicts["case-verify"] == "PASS"


def test_damaged_manifests_are_set_aside(judged):
    assert judged[2] == {"bad": "not JSON", "list": "not an object"}


def test_duplicating_a_course_changes_no_flags(spark, phrases):
    m = kit.mutated(kit.MUTATIONS["forward"][0])
    rows = []
    for name in ("a", "b"):
        m["course"]["id"] = name
        rows.append((name, json.dumps(m)))
    flags = run_checks(catalog_tables(parse_manifests(spark.createDataFrame(rows, "path string, value string"))[0]), phrases).collect()
    def of(c):
        return sorted((f.rule, f.subject, f.detail) for f in flags if f.course_id == c)
    assert of("a") and of("a") == of("b")


def test_manifests_are_read_from_folders(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "manifest.json").write_text(json.dumps(kit.sound_course()))
    (tmp_path / "x" / "package.json").write_text("{}")
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "manifest.json").write_text("{")
    manifests, rejects = read_manifests(spark, str(tmp_path))
    assert manifests.count() == 2 and rejects.count() == 1


def test_lesson_order(spark):
    manifests, _ = parse_manifests(spark.createDataFrame([("p", json.dumps(kit.sound_course()))], "path string, value string"))
    rows = catalog_tables(manifests)["lessons"].orderBy("lesson_pos").collect()
    assert [r.lesson_id for r in rows] == ["welcome", "glass", "focus"]


def test_of_two_manifests_of_a_course_one_counts(spark, tmp_path):
    rows = [(p, json.dumps(kit.sound_course())) for p in ("b/manifest.json", "a/manifest.json", "c/manifest.json")]
    tables = staged_catalog(parse_manifests(spark.createDataFrame(rows, "path string, value string"))[0], str(tmp_path))
    assert tables["courses"].count() == 1 and tables["lessons"].count() == 3
    assert sorted((x.rule, x.subject, x.detail) for x in tables["repeated_courses"].collect()) == [
        ("repeated_course", "b/manifest.json", "a/manifest.json"), ("repeated_course", "c/manifest.json", "a/manifest.json")]
