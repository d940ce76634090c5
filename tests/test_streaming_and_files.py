from lectern.plans.checks import draft_flags
from lectern.sources import files
from lectern.streaming.gate import stream_draft_flags

SCHEMA = "course_id string, stem string, md string"


def test_stream_equals_batch(spark, phrases, tmp_path):
    rows = [("c", f"m00-l{i}-x", f"# T\na — b {i}\n```sh\nforge test\n```") for i in range(6)]
    source, out = str(tmp_path / "in"), str(tmp_path / "flags")
    spark.createDataFrame(rows[:3], SCHEMA).write.parquet(source)
    run = lambda: stream_draft_flags(spark, source, SCHEMA, phrases, out, str(tmp_path / "check")).awaitTermination()
    run()
    spark.createDataFrame(rows[3:], SCHEMA).write.mode("append").parquet(source)
    run()
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch").collect())
    assert streamed == sorted(tuple(r) for r in draft_flags(spark.createDataFrame(rows, SCHEMA), phrases).collect())


def test_course_tree_is_read(spark, tmp_path):
    root = tmp_path / "stars" / "lessons"
    (root / "drafts").mkdir(parents=True)
    (root / "assets" / "m00-l1-a").mkdir(parents=True)
    (root / "drafts" / "m00-l1-a.md").write_text("# A\n")
    (root / "drafts" / "000-cover.md").write_text("# Cover\n")
    (root / "assets" / "m00-l1-a" / "v01-chart.png").write_bytes(b"123")
    ch = tmp_path / "stars" / "challenges" / "x"
    ch.mkdir(parents=True)
    (ch / "tests.json").write_text('[{"id": "t1", "input": "1", "expectedOutput": "2"}]')
    (ch / "starter.rs").write_text("fn a() {}")
    assert [tuple(r) for r in files.read_drafts(spark, str(tmp_path)).collect()] == [("stars", "m00-l1-a", "# A\n")]
    assert [tuple(r) for r in files.read_assets(spark, str(tmp_path)).collect()] == [("stars", "m00-l1-a", "v01-chart.png", 1, 3)]
    listed, tests = files.read_challenge_files(spark, str(tmp_path))
    assert {r.path for r in listed.collect()} == {"challenges/x/tests.json", "challenges/x/starter.rs"}
    assert [(r.case_id, r.expected) for r in files.test_cases(tests).collect()] == [("t1", "2")]
    (tmp_path / "block.txt").write_text("# note\n\n  Movie Review \n")
    assert [r.phrase for r in files.read_blocklist(spark, str(tmp_path / "block.txt")).collect()] == ["movie review"]
    (tmp_path / "tsc.log").write_text("src/b0003.ts(1,2): error TS2304: no x\nFound 1 error.\n")
    assert [(r.block, r.msg) for r in files.read_diagnostics(spark, str(tmp_path / "tsc.log"), "ts").collect()] == [(3, "error TS2304: no x")]
