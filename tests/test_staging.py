"""The staged catalog: one copy of the parsed manifests, written in one pass."""
import json
import os

import manifest_kit as kit
from lectern.operators.flatten import catalog_tables
from lectern.plans.staging import staged_catalog
from lectern.sources.manifests import parse_manifests


def test_one_compact_copy_gives_the_tables_of_the_manifests(spark, tmp_path):
    def course(n):
        m = kit.sound_course()
        m["course"].update(id=f"c{n}", overview=f"O {n}")
        m["lessons"] = [dict(x, id=f"{x['id']}{k}", order=k % 3) for k in range(12) for x in m["lessons"]]
        return m
    docs = [course(n) for n in range(60)] + [{"course": {"id": "none"}}, {"course": {"id": "empty"}, "lessons": []}]
    texts = [(f"p/{n:02}", json.dumps(m)) for n, m in enumerate(docs)] + [("z/again", json.dumps(course(3)))]
    manifests = parse_manifests(spark.createDataFrame(texts, "path string, value string"))[0]
    staged, direct = staged_catalog(manifests, str(tmp_path)), catalog_tables(manifests.filter("path <> 'z/again'"))
    assert sorted(os.listdir(tmp_path)) == ["repeated", "rows"]
    for name, table in direct.items():
        assert sorted(map(repr, staged[name].collect())) == sorted(map(repr, table.collect())), name
    assert {(r.course_id, r.n_lessons) for r in staged["courses"].collect()} >= {("none", 0), ("empty", 0), ("c0", 36)}
    assert [(r.subject, r.detail) for r in staged["repeated_courses"].collect()] == [("z/again", "p/03")]


def test_derived_manifests_are_not_written_as_texts(spark, tmp_path, monkeypatch):
    from oracle import manifest_data as md, shared
    monkeypatch.setattr(shared, "_MADE", {})
    made = []
    monkeypatch.setattr(shared, "fresh_path", lambda spark, name: made.append(name) or str(tmp_path / name))
    md.tables(spark, "/root/testdata/sf0.001")
    assert made == ["catalog"]


def test_a_text_is_checked_by_two_readings_that_copy_nothing(spark):
    from lectern.functions.text import is_json
    texts = ['{"a": [1, {"b": "x"}]}', " 1 ", "null", '{"a": 1} x', '{"a": 1}, {"b": 2}', '1, "broken": "x"', '1]} {"v":[2', '{"a": "\\q"}', '{"a": 01}', "", "  ", '{"broken": "x", "v": 1}', None]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    checked = df.filter(is_json(df["t"]))
    assert [r.n for r in checked.orderBy("n").collect()] == [0, 1, 2, 11]
    assert [r.j for r in df.select("n", is_json(df["t"]).alias("j")).orderBy("n").collect()] == [n in (0, 1, 2, 11) for n in range(len(texts))]
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and "StructField(v," not in plan


def test_only_lessons_of_another_shape_are_rewritten(spark):
    from oracle import manifest_data as md
    texts = md.texts(spark, "/root/testdata/sf0.001")
    assert "replace(array_join" not in texts._jdf.queryExecution().optimizedPlan().toString()
    whole = "".join(r.value for r in texts.filter("path LIKE 'catalog/%'").collect())
    assert '"quiz_wrong"' not in whole and '"challenges_wrong"' not in whole and '"assessment":"@' not in whole
    assert all(x in whole for x in ('"quiz_blocks":{"a":1}', '"coding_challenges":"none"', '"assessment":{"gate":"listen to it"', '"assessment":{"gate":"write code"'))


ODD = ['{"a": [1, {"b": "x"}]}', " 1 ", "null", '{"a": 1} x', '{"a": 1}, {"b": 2}', '1, "broken": "x"', '1]} {"v":[2', '{"a": "\\q"}', '{"a": 01}', "", "  ", '{"broken": "x", "v": 1}', None,
       '{"modules": "x", "course": {"id": "c"}}', '{"modules": [1, {"id": "m"}], "course": {"id": "c"}}', '{"course": {"id": "c"}} ]}', '{"course": {"length_target": {"hours": "x"}}}',
       '\n\t {"course": {"id": "d"}}\n', '[{"course": {}}]', "{}", '{"_mark": "z", "course": {"id": "e"}}', '{}],"v":[{}', '{"course": {"id": "f"}', '{"course": {"id": "g"}}, "x": 1',
       '{"lessons": [1, "a", {"b": 2.50, "b": 3}, null]}', '{"lessons": {"a": 1}, "course": {"id": "h"}}', '{"course": {"id": "x"}, "course": {"id": "y"}}', "{'a': 1}", '{"course": null}', '"str"']


def test_a_manifest_is_checked_and_parsed_by_one_reading(spark):
    from lectern import schemas
    from lectern.functions.text import JSON_OPTIONS, is_json
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(f"p{n:02}", t) for n, t in enumerate(ODD)], "path string, value string")
    manifests, rejects = parse_manifests(df)
    plain = df.filter(is_json(F.col("value")) & F.col("value").rlike(r"\A\s*\{")).select("path", F.from_json("value", schemas.MANIFEST, JSON_OPTIONS).alias("m"))
    assert sorted(map(repr, manifests.select("path", "m").collect())) == sorted(map(repr, plain.collect()))
    assert manifests.count() + rejects.filter("path <> 'p12'").count() == len(ODD) - 1  # a null text is neither
    plan = manifests._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "from_json(" in line]


def test_derived_lessons_are_written_once_and_their_lines_cut_once(spark):
    from oracle import manifest_data as md
    plan = md.texts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJson") == 2  # of a lesson, of the rest
    assert "element_at(" not in plan  # split_part is one


def test_a_source_of_one_row_group_is_spread_however_many_splits_it_has(spark, tmp_path):
    from lectern.session import spread
    path = str(tmp_path / "t")
    spark.range(4000).selectExpr("id", "sha2(string(id), 512) AS x").coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= 8
        assert sum(n > 0 for n in spread(df, "id").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lesson_documents_of_staged_lessons_need_no_join(spark):
    from lectern.operators import documents, publish
    from oracle import manifest_data as md
    t = md.tables(spark, SF)
    meta = publish.publish_meta(t["courses"])
    staged, joined = documents.lesson_documents(t["published_lessons"]), documents.lesson_documents(t["lessons"], t["modules"], t["courses"], meta)
    columns = ["course_id", "lesson_id", "lesson_pos", "path", "text"]
    assert _rows(staged.select(*columns)) == _rows(joined.select(*columns)) and staged.count() > 100
    assert "Join" not in _plan(staged) and "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()


def test_course_documents_of_staged_lessons_are_those_of_the_manifests(spark):
    from lectern.operators import documents, publish
    from oracle import manifest_data as md
    t = md.tables(spark, SF)
    meta = publish.publish_meta(t["courses"])
    staged, plain = documents.course_publish_documents(t["manifests"], meta, t["lessons"]), documents.course_publish_documents(md.manifests(spark, SF), meta)
    assert _rows(staged.select("course_id", "text")) == _rows(plain.select("course_id", "text")) and staged.count() > 10
    bare = spark.createDataFrame([("p", '{"course":{"id":"c"},"modules":[{"id":"m"}],"lessons":[]}')], "path string, value string")
    bare_t = catalog_tables(parse_manifests(bare)[0])
    assert _rows(documents.course_publish_documents(parse_manifests(bare)[0], publish.publish_meta(bare_t["courses"]), bare_t["lessons"])) == _rows(
        documents.course_publish_documents(parse_manifests(bare)[0], publish.publish_meta(bare_t["courses"])))


def test_rules_on_what_lessons_name_share_one_join(spark):
    from lectern.operators import course, graph
    from lectern.operators.flags import union
    from oracle import manifest_data as md
    t = md.tables(spark, SF)
    apart = union(graph.forward_lesson_deps(t["prereqs"], t["lessons"]), graph.untaught_skills(t["prereqs"], t["first_taught"]),
                  graph.late_skills(t["prereqs"], t["first_taught"]), graph.unresolved_prereqs(t["prereqs"]))
    together = graph.prereq_flags(t["lessons"], t["nodes"], t["teaches"])
    assert _rows(together) == _rows(apart) and {x.rule for x in together.collect()} == {"forward_lesson_dep", "untaught_skill", "late_skill", "unresolved_prereq"}
    assert _rows(course.consumes_flags(t["artifacts"])) == _rows(union(course.unknown_consumes(t["artifacts"]), course.backward_consumes(t["artifacts"])))
    assert sum("Generate" in line and "prerequisites" in line for line in _plan(graph.dag_flags(t)).splitlines()) == 1
    assert sum("Generate" in line and "consumes" in line for line in _plan(course.artifact_flags(t)).splitlines()) == 2


def test_raw_texts_of_lessons_are_read_where_parsing_leaves_a_doubt(spark):
    from lectern.operators import briefs, quiz
    texts = ['{"id":"a","brief":{"difficulty":"7","quiz_blocks":[],"coding_challenges":{"a":1}}}', '{"id":"b","brief":{"difficulty":7,"quiz_blocks":null}}',
             '{"id":"c","brief":{"difficulty":2,"quiz\\u005fblocks":"x"}}', '{"id":"d","brief":{"difficulty":2.5,"coding_challenges":[1]}}', '{"id":"e","brief":{"difficulty":0}}',
             '{"id":"f","brief":{"difficulty":"x","quiz_blocks":3}}', '{"id":"g"}', '{"id":"h","brief":{"difficulty":-1}}']
    rows = spark.createDataFrame([("p", '{"course":{"id":"c"},"lessons":[' + ",".join(texts) + "]}")], "path string, value string")
    t = catalog_tables(parse_manifests(rows)[0])
    assert sorted((x.subject, x.detail) for x in briefs.bad_difficulty(t["briefs"]).collect()) == [("b", "7"), ("e", "0"), ("h", "-1")]
    assert sorted((x.subject, x.detail) for x in quiz.not_a_list(t["lessons"]).collect()) == [("a", "coding_challenges"), ("c", "quiz_blocks"), ("f", "quiz_blocks")]
    assert "(difficulty,LongType,true)),true), CASE WHEN" in _plan(briefs.bad_difficulty(t["briefs"]))
    assert "get_json_object(CASE WHEN" in _plan(quiz.not_a_list(t["lessons"]))


def test_a_short_list_of_phrases_is_found_in_each_row(spark):
    from lectern.operators import blocklist
    texts = spark.createDataFrame([(1, "A Movie REVIEW, a movie review"), (2, None), (3, "été x"), (4, ""), (1, "x")], "id int, text string")
    found = blocklist.hits(texts, ["id"], "text", spark.createDataFrame([("movie review",), ("x",), ("été",), ("",), ("x",)], "phrase string"))
    assert sorted(map(tuple, found.collect())) == [(1, "movie review"), (1, "x"), (3, "x"), (3, "été")]
    assert "Join" not in _plan(found) and "MapInArrow" not in _plan(found)


def test_challenge_files_come_from_one_pass_over_the_documents(spark):
    from oracle import manifest_queries as mq
    from lectern.operators.flags import union
    got = mq.challenge_files(spark, SF)
    assert _rows(got.distinct()) == _rows(union(*[spark.sql(f.replace("{0}", "{l}"), l=mq.lines(spark, SF)) for f in mq.FILES]).distinct())
    assert _plan(got).count("Relation [") == 1


def test_a_source_of_many_files_is_not_shuffled(spark, tmp_path):
    from lectern.session import spread
    wanted = 2 * spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for files, split, moved in ((wanted, 1 << 12, False), (wanted - 1, 1 << 12, True), (wanted, 1 << 27, True)):
            path = str(tmp_path / f"{files}-{split}")
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.range(4000).repartition(files).write.parquet(path)
            df = spread(spark.read.parquet(path), "id")
            assert ("Repartition" in _plan(df)) is moved and df.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
