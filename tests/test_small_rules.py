"""Shell words, bare integers, exact medians, texts beside lessons: against plain versions."""
import json
import random
import shlex
import statistics

import manifest_kit as kit
from pyspark.sql import functions as F

from lectern.operators import briefs, corpus
from lectern.operators.flatten import catalog_tables, catalog_texts
from lectern.sources.manifests import parse_manifests


def test_first_words_are_those_of_a_shell(spark):
    r = random.Random(1)
    texts = ["".join(r.choice(["a", "py", " ", "'", '"', "\\", "\t", "é", "#"]) for _ in range(r.randint(1, 9))).strip() for _ in range(1500)]
    texts = [t for t in texts if t] + ["'python3' a.py", "pyth\"on\"3 x", "echo\\ x y", '"a\\"b\\x" c', "x" * 50_000 + " y", "''"]

    def want(t):
        try:
            return (shlex.split(t) or [""])[0]
        except ValueError:
            return None
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", briefs.first_shell_word(F.col("t")).alias("w")).collect()
    assert [(x.t, x.w) for x in got if x.w != want(x.t)] == []


def test_quoted_difficulties_are_no_integers(spark):
    cases = {"7": True, '"7"': False, "0": True, "2": False, "4.5": False, "null": False, '"x"': False, "-1": True}
    rows = [(k, json.dumps({"course": {"id": f"c{i}"}, "lessons": [{"id": "l", "brief": {"difficulty": "@"}}]}).replace('"@"', k)) for i, k in enumerate(cases)]
    flags = briefs.bad_difficulty(catalog_tables(parse_manifests(spark.createDataFrame(rows, "path string, value string"))[0])["briefs"])
    assert sorted(x.course_id for x in flags.collect()) == [f"c{i}" for i, bad in enumerate(cases.values()) if bad]


def test_medians_by_counts(spark):
    r = random.Random(2)
    rows = [(f, r.choice([r.randint(0, 20), r.randint(-300, 100_000), 7])) for f in "aabbbcd" for _ in range(r.choice([1, 2, 301, 500]))] + [("a", None), ("z", None)]
    got = {x.f: x.median for x in corpus.exact_medians(spark.createDataFrame(rows, "f string, v int"), "f", "v").collect()}
    assert got == {f: statistics.median([v for k, v in rows if k == f and v is not None]) for f in "abcd"}


def test_texts_beside_lessons(spark):
    m = kit.sound_course()
    m["course"]["overview"] = "Welcome"
    m["glossary"] = [{"term": "lens", "def": "bends light"}, {"term": " "}]
    m["modules"][0].update(description="d", driving_question="q", artifact="a", outcome={"statement": "o"})
    got = catalog_texts(parse_manifests(spark.createDataFrame([("p", json.dumps(m))], "path string, value string"))[0]).collect()
    assert sorted((x.field, x.subject, x.text) for x in got) == [
        ("course_overview", "stars", "Welcome"), ("glossary_def", "lens", "bends light"), ("glossary_term", "lens", "lens"), ("module_artifact", "m-one", "a"),
        ("module_description", "m-one", "d"), ("module_outcome", "m-one", "o"), ("module_question", "m-one", "q"), ("module_title", "m-one", "One"),
        ("module_title", "m-two", "Two"), ("outcome", "to-1", "s")]
