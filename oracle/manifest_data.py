"""Course manifests derived from `documents`: one course per document, one lesson per line.

Field values are scalar SQL over (d = doc_id, i = line number from 0, x = line) that Spark and DuckDB read
alike. Spark assembles them into manifest JSON, row by row, and the library parses that text again; the
oracle uses the scalars directly. Remainders of d + i plant every defect the rules look for.
"""
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.plans.staging import staged_catalog
from lectern.session import spread
from lectern.sources.manifests import parse_manifests
from oracle.shared import once

H = "(d + i)"
COURSE_ID = "CASE WHEN d % 41 = 0 THEN 'Course ' || d ELSE 'course-' || d END"

LESSON = {
    "id": f"CASE WHEN {H} % 29 = 5 THEN 'Lesson ' || i WHEN {H} % 31 = 7 THEN 'l0' ELSE 'l' || i END",
    "module": f"CASE WHEN {H} % 23 = 3 THEN 'mod-x' ELSE 'mod-' || CAST(floor(i / 4) AS INT) END",
    "ord": f"CASE WHEN {H} % 17 = 2 THEN NULL ELSE (i * 7) % 5 END",
    "kind": f"CASE {H} % 11 WHEN 0 THEN 'video' WHEN 1 THEN 'concept' WHEN 2 THEN NULL ELSE 'build' END",
    "title": "x",
    "hook": f"CASE WHEN {H} % 13 = 4 THEN '' ELSE split_part(x, ' ', 2) END",
    "concept_spec": "x",
    "artifact_spec": f"CASE WHEN {H} % 7 = 1 THEN NULL ELSE 'build ' || split_part(x, ' ', 1) END",
    "exercise_spec": "'do it'",
    "the_tradeoff": f"CASE WHEN {H} % 19 = 6 THEN '   ' ELSE 'cost' END",
    "fading": f"CASE WHEN {H} % 9 = 2 THEN NULL ELSE 'worked' END",
    "dominant_job": f"CASE {H} % 10 WHEN 0 THEN 'motivate' WHEN 1 THEN 'explain' WHEN 2 THEN 'frame' "
                    f"WHEN 3 THEN 'demystify' WHEN 4 THEN NULL ELSE 'show-how' END",
    "est_length": f"CASE {H} % 6 WHEN 0 THEN '~1,500-2,800 words' WHEN 1 THEN 'long' WHEN 2 THEN length(x) || ' words' "
                  f"WHEN 3 THEN NULL ELSE '3,000' END",
    # '@' marks the object form: {"gate": …}.
    "assessment": f"CASE {H} % 8 WHEN 0 THEN '' WHEN 1 THEN 'watch the video' WHEN 2 THEN 'read and build it' "
                  f"WHEN 3 THEN '@listen to it' WHEN 4 THEN '@write code' WHEN 5 THEN NULL ELSE 'tests pass' END",
    "difficulty": f"CASE {H} % 12 WHEN 0 THEN 0 WHEN 1 THEN 4 WHEN 2 THEN NULL ELSE 1 + i % 3 END",
    "objectives": f"CASE {H} % 14 WHEN 0 THEN 'null' WHEN 1 THEN 'empty' ELSE 'two' END",
    "objective_1": "x || CASE WHEN i % 4 = 0 THEN ' Understand it' ELSE ' do it' END",
    "objective_2": "'write ' || split_part(x, ' ', 1)",
    "pre_1": f"CASE WHEN {H} % 21 = 8 THEN NULL WHEN {H} % 16 = 3 THEN 'ghost' WHEN {H} % 16 = 4 THEN 'l' || (i + 1) "
             f"WHEN i = 0 THEN 's1' ELSE 'l' || (i - 1) END",
    "pre_2": f"CASE WHEN {H} % 21 = 8 THEN NULL ELSE 's' || length(x) % 9 END",
    "command": f"CASE WHEN {H} % 5 = 0 THEN NULL WHEN {H} % 5 = 1 THEN 'python3 a.py | wc -l' "
               f"WHEN {H} % 5 = 2 THEN 'curl x | shasum' ELSE 'echo ' || i END",
    "artifact": f"CASE WHEN {H} % 3 = 0 THEN NULL WHEN {H} % 15 = 4 THEN 'a0' ELSE 'a' || i END",
    "consume_1": "'a' || (i - 1)",
    "consume_2": "'a' || (i * 3) % 10",
    "terminal": f"CASE WHEN {H} % 7 = 0 THEN 'done' ELSE NULL END",
    "research": f"CASE WHEN {H} % 4 = 1 THEN NULL WHEN {H} % 2 = 0 THEN 'verified' ELSE 'gathering' END",
    "claim_surface": f"CASE {H} % 6 WHEN 0 THEN 'web' WHEN 2 THEN 'hearsay' WHEN 4 THEN NULL ELSE 'helius' END",
    "fact_1": "split_part(x, ' ', 1) || ' ' || split_part(x, ' ', 2)",
    "fact_2": "'fixed fact ' || i",
    "quiz": f"CASE WHEN {H} % 18 = 9 THEN 'wrong' WHEN {H} % 5 = 2 THEN 'null' WHEN {H} % 18 = 5 THEN 'empty' ELSE 'two' END",
    "quiz_key": f"CASE WHEN {H} % 3 = 0 THEN NULL ELSE 'Key ' || i END",
    "q1_id": f"CASE WHEN {H} % 20 = 1 THEN '' ELSE 'q1' END",
    "q2_id": f"CASE WHEN {H} % 6 = 3 THEN 'q1' ELSE 'q2' END",
    "q1_prompt": "x",
    "q2_multi": f"({H} % 4 = 0)",
    "q2_oid": f"CASE {H} % 10 WHEN 0 THEN 'a' WHEN 5 THEN '' ELSE 'b' END",
    "q1_slot": f"{H} % 3",
    "q2_a": f"({H} % 2 = 0)",
    "q2_b": f"({H} % 7 < 3)",
    "q1_feedback": f"CASE WHEN {H} % 5 = 1 THEN '' ELSE 'no' END",
    "explanation": f"CASE WHEN {H} % 9 = 4 THEN NULL ELSE 'because' END",
    "label_1": "CASE WHEN i % 5 = 0 THEN x ELSE split_part(x, ' ', 1) END",
    "label_2": "CASE WHEN i % 5 = 1 THEN x ELSE split_part(x, ' ', 2) END",
    "label_3": "CASE WHEN i % 5 = 2 THEN x ELSE split_part(x, ' ', 3) END",
    "challenges": f"CASE WHEN {H} % 18 = 16 THEN 'wrong' WHEN {H} % 6 = 4 THEN 'two' ELSE 'null' END",
    "c1_id": f"CASE {H} % 5 WHEN 0 THEN '' WHEN 1 THEN 'Bad Id' ELSE 'ch-1' END",
    "c2_id": f"CASE {H} % 4 WHEN 0 THEN 'ch-1' ELSE 'ch-2' END",
    "c1_lang": f"CASE {H} % 9 WHEN 1 THEN 'go' WHEN 4 THEN 'typescript' ELSE 'rust' END",
    "c2_build": f"CASE {H} % 7 WHEN 0 THEN NULL WHEN 1 THEN 'other' ELSE 'buildable' END",
    "c1_starter": f"CASE WHEN {H} % 8 = 2 THEN '' ELSE 'challenges/l' || i || '/starter' END",
    "c1_tests": "'challenges/l' || i || '/tests.json'",
    "c2_accept": f"({H} % 3 = 1)",
}

MODULE = {
    "id": "CASE WHEN (d + m) % 9 = 8 THEN 'mod-0' WHEN (d + m) % 26 = 25 THEN 'Mod ' || m ELSE 'mod-' || m END",
    "title": "CASE WHEN (d + m) % 5 = 0 THEN NULL ELSE 'Module ' || m END",
    "rung": "CASE WHEN (d + m) % 8 = 0 THEN NULL ELSE (m * 2 + d) % 7 END",
    "band": "CASE WHEN (d + m) % 5 = 1 THEN NULL ELSE (m + d * 3) % 4 END",
    "dep": "CASE WHEN (d + m) % 10 = 3 THEN 'mod-99' WHEN m = 0 THEN NULL ELSE 'mod-' || (m - 1) END",
    "teach_1": "'s' || (m * 2) % 8",
    "teach_2": "'s' || (m * 2 + 1) % 8",
    "require_1": "'s' || (m + 5) % 10",
    "trace": "CASE WHEN (d + m) % 6 = 0 THEN NULL ELSE 'to-' || (d + m) % 4 END",
}


def _struct(pairs: list[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in pairs) + ")"


# A line, its first words and d + i are worked out once for all fields of a lesson. The line is cut once, and only as far as its words are wanted.
LINE_CUT = f"named_struct('h', {H}, 'x', x, 'w', split(x, ' ', 4))"
LINE_WORDS = "named_struct('h', c.h, 'x', c.x, 'w1', c.w[0], 'w2', coalesce(get(c.w, 1), ''), 'w3', coalesce(get(c.w, 2), ''))"


def _of_line(sql: str) -> str:
    parts = re.sub(r"split_part\(x, ' ', (\d)\)", r"p.w\1", sql).split("'")
    parts[::2] = [re.sub(r"(?<![.\w])x\b", "p.x", part.replace(H, "p.h")) for part in parts[::2]]
    return "'".join(parts)


def _lesson_fields() -> str:
    """Of p (LINE_WORDS of a line) and i: the scalars of LESSON, each worked out once."""
    return _struct([(k, _of_line(v)) for k, v in LESSON.items()])


def _lesson_json() -> str:
    """Of f (_lesson_fields of a line) and i. Fields of another type than a struct can give them are put into the text of the lessons that have one."""
    e = {k: f"f.{k}" for k in LESSON}
    opt1 = [_struct([("id", f"'{o}'"), ("label", e[f"label_{n}"]), ("correct", f"{e['q1_slot']} = {n - 1}"),
                     ("feedback", e["q1_feedback"])]) for n, o in ((1, "a"), (2, "b"), (3, "c"))]
    opt2 = [_struct([("id", "'a'"), ("label", e["label_1"]), ("correct", e["q2_a"]), ("feedback", "'no'")]),
            _struct([("id", e["q2_oid"]), ("label", e["label_3"]), ("correct", e["q2_b"]), ("feedback", "'no'")])]
    q1 = _struct([("id", e["q1_id"]), ("prompt", e["q1_prompt"]), ("multiSelect", "false"),
                  ("options", f"array({', '.join(opt1)})"), ("explanation", e["explanation"])])
    q2 = _struct([("id", e["q2_id"]), ("prompt", "'why?'"), ("multiSelect", e["q2_multi"]),
                  ("options", f"array({', '.join(opt2)})"), ("explanation", "'so'")])
    block = _struct([("key", e["quiz_key"]), ("questions", f"CASE WHEN {e['quiz']} = 'two' THEN array({q1}, {q2}) "
                                                           f"ELSE filter(array({q1}), q -> false) END")])
    c1 = _struct([("id", e["c1_id"]), ("language", e["c1_lang"]), ("buildType", "CAST(NULL AS STRING)"), ("starter", e["c1_starter"]),
                  ("solution", "'challenges/l' || i || '/solution'"), ("tests", e["c1_tests"]), ("acceptance_criteria", "array('ok')")])
    c2 = _struct([("id", e["c2_id"]), ("language", "'typescript'"), ("buildType", e["c2_build"]), ("starter", "'challenges/s'"),
                  ("solution", "CAST(NULL AS STRING)"), ("tests", "'challenges/t.json'"),
                  ("acceptance_criteria", f"CASE WHEN {e['c2_accept']} THEN array('ok') END")])
    goals = f"array({_struct([('bloom', chr(39) + 'apply' + chr(39)), ('statement', e['objective_1'])])}, " \
            f"{_struct([('bloom', chr(39) + 'apply' + chr(39)), ('statement', e['objective_2'])])})"
    plain = ["title", "kind", "hook", "concept_spec", "artifact_spec", "exercise_spec", "the_tradeoff", "fading", "dominant_job",
             "est_length", "assessment", "difficulty"]
    brief = _struct([("id", e["id"]), *[(k, e[k]) for k in plain],
                     ("objectives", f"CASE {e['objectives']} WHEN 'null' THEN NULL WHEN 'empty' THEN filter({goals}, g -> false) ELSE {goals} END"),
                     ("prerequisites", f"CASE WHEN {e['pre_1']} IS NULL THEN NULL ELSE array({e['pre_1']}, {e['pre_2']}) END"),
                     ("just_in_time", "named_struct('define', array('a'), 'footguns', array('b'))"),
                     ("verify", f"CASE WHEN {e['command']} IS NOT NULL THEN {_struct([('command', e['command']), ('expect', chr(39) + '1' + chr(39))])} END"),
                     ("artifact", f"CASE WHEN {e['artifact']} IS NOT NULL THEN "
                                  f"{_struct([('id', e['artifact']), ('consumes', 'array(' + e['consume_1'] + ', ' + e['consume_2'] + ')'), ('terminal', e['terminal'])])} END"),
                     ("quiz_wrong", f"CASE WHEN {e['quiz']} = 'wrong' THEN 'x' END"),
                     ("quiz_blocks", f"CASE WHEN {e['quiz']} IN ('two', 'empty') THEN array({block}) END"),
                     ("challenges_wrong", f"CASE WHEN {e['challenges']} = 'wrong' THEN 'x' END"),
                     ("coding_challenges", f"CASE WHEN {e['challenges']} = 'two' THEN array({c1}, {c2}) END")])
    claim = _struct([("id", "'C' || i"), ("mcp", e["claim_surface"]), ("status", e["research"])])
    research = _struct([("status", e["research"]), ("claims", f"array({claim})"), ("frozen_facts", f"array({e['fact_1']}, {e['fact_2']})")])
    lesson = _struct([("id", e["id"]), ("module", e["module"]), ("order", e["ord"]), ("brief", brief),
                      ("research", f"CASE WHEN {e['research']} IS NOT NULL THEN {research} END")])
    text = f"to_json({lesson})"
    # A text is searched only for the field that it holds; nothing is searched for ''.
    for holds, pattern, to in [("f.assessment LIKE '@%'", "'\"assessment\":\"' || f.assessment || '\"'", "'\"assessment\":{\"gate\":\"' || coalesce(substr(f.assessment, 2), '') || '\",\"answer_shape\":\"x\"}'"),
                               ("f.quiz = 'wrong'", "'\"quiz_wrong\":\"x\"'", "'\"quiz_blocks\":{\"a\":1}'"),
                               ("f.challenges = 'wrong'", "'\"challenges_wrong\":\"x\"'", "'\"coding_challenges\":\"none\"'")]:
        text = f"replace({text}, CASE WHEN {holds} THEN {pattern} ELSE '' END, {to})"
    return text


def _module_struct() -> str:
    e = {k: f"({v})" for k, v in MODULE.items()}
    return _struct([("id", e["id"]), ("title", e["title"]), ("artifact_rung", e["rung"]), ("difficulty_band", e["band"]),
                    ("depends_on", f"CASE WHEN {e['dep']} IS NOT NULL THEN array({e['dep']}) END"),
                    ("teaches_skills", f"array({e['teach_1']}, {e['teach_2']})"), ("requires_skills", f"array({e['require_1']})"),
                    ("traces_to", f"CASE WHEN {e['trace']} IS NULL THEN filter(array(''), t -> false) ELSE array({e['trace']}) END")])


# Course-level values over (d, n = number of lines).
EDGE_SRC = "'s' || i % 8"
EDGE_DST = "CASE WHEN d % 3 = 0 THEN 's' || (i % 8 + 1) ELSE 's' || (i * 3 + length(x)) % 8 END"


def manifest_texts(spark: SparkSession, sf: str) -> DataFrame:
    """texts(path, value): the manifest of each document as JSON."""
    docs = spread(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id").select(
        F.col("doc_id").alias("d"), F.split("text", "\n", -1).alias("lines"))
    n = "size(lines)"
    parts = docs.select(
        "d", "lines", F.expr(f"transform(transform(transform(transform(lines, (x, i) -> {LINE_CUT}), c -> {LINE_WORDS}), (p, i) -> {_lesson_fields()}), (f, i) -> {_lesson_json()})").alias("lesson_texts"),
        F.expr(f"transform(sequence(0, CAST(floor(({n} - 1) / 4) AS INT)), m -> {_module_struct()})").alias("modules"),
        F.expr(f"transform(lines, (x, i) -> array({EDGE_SRC}, {EDGE_DST}))").alias("edges"))
    head = F.expr(f"""to_json(named_struct(
      'schema_version', 1,
      'course', named_struct('id', {COURSE_ID}, 'title', 'Doc ' || d, 'one_line_promise', lines[0],
        'terminal_outcomes', transform(array('to-0', 'to-1', 'to-2'), o -> named_struct('id', o, 'bloom', 'create')),
        'length_target', named_struct('hours', CASE WHEN d % 6 = 0 THEN NULL ELSE {n} * 0.25D END,
                                      'lessons', CASE d % 5 WHEN 0 THEN {n} + 1 WHEN 1 THEN NULL ELSE {n} END),
        'routing', named_struct('backbone_pattern', CASE WHEN d % 7 = 0 THEN array('p', 'q') ELSE array('p') END,
          'guest_patterns', transform(sequence(1, CAST(d % 4 + 1 AS INT)), g -> 'g' || g),
          'lesson_template', CASE WHEN d % 5 = 2 THEN NULL ELSE 't' END)),
      'dag', named_struct('nodes', transform(sequence(0, 7), s -> 's' || s), 'edges', edges),
      'modules', modules,
      'cadence', named_struct('release', named_struct('schedule', CASE WHEN d % 4 = 0 THEN NULL ELSE array(named_struct('week', 1,
         'publish', transform(filter(sequence(0, {n} - 1), p -> p % 5 <> 4), p -> 'l' || p))) END)),
      'assessment', named_struct('proof_matrix', array(named_struct('outcome', 'to-0', 'proven_by', 'x'),
                                                      named_struct('outcome', 'to-' || d % 5, 'proven_by', 'y')),
         'capstone', CASE WHEN d % 10 = 0 THEN NULL ELSE named_struct('id', 'cap', 'requires_skills', array('s' || d % 9)) END),
      'academy', CASE WHEN d % 2 = 0 THEN named_struct('prefix', CASE WHEN d % 4 = 0 THEN 'p' || d END,
         'xpPerLesson', 10 + d % 120, 'skills_map', map('s0', 'basics', 's1', 'accounts', 's2', 'basics'), 'default_skills', array('general')) END))""")
    lessons = F.expr("array_join(lesson_texts, ',')")
    value = F.concat(F.expr("substr(h, 1, length(h) - 1)"), F.lit(',"lessons":['), lessons, F.lit("]}"))
    whole = parts.withColumn("h", head).select("d", value.alias("v"))
    # Every 50th document has a damaged copy beside it.
    copies = F.when(F.col("d") % 50 == 49, F.array(F.lit("catalog/"), F.lit("damaged/"))).otherwise(F.array(F.lit("catalog/")))
    return (whole.withColumn("folder", F.explode(copies))
            .select(F.concat("folder", "d", F.lit("/manifest.json")).alias("path"),
                    F.when(F.col("folder") == "damaged/", F.substring("v", 1, 100)).otherwise(F.col("v")).alias("value")))


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Assembled whenever they are read: they are some ten times the documents, and the parsed catalog is staged."""
    return manifest_texts(spark, sf)


def manifests(spark: SparkSession, sf: str) -> DataFrame:
    return parse_manifests(texts(spark, sf))[0]


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return once(spark, sf, "catalog", lambda path: staged_catalog(manifests(spark, sf), path))


# ---- the same in DuckDB -------------------------------------------------------------------------

def _select(exprs: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in exprs.items())


CTES = {
    "src": f"""SELECT d, {COURSE_ID} AS course_id, lines, len(lines) AS n
               FROM (SELECT doc_id AS d, string_split(text, chr(10)) AS lines FROM documents)""",
    "ln": "SELECT d, course_id, unnest(lines) AS x, generate_subscripts(lines, 1) - 1 AS i FROM src",
    "les": f"SELECT d, course_id, i, x, {_select({k: v for k, v in LESSON.items()})} FROM ln",
    "mseq": "SELECT d, course_id, unnest(range(CAST(floor((n - 1) / 4) AS BIGINT) + 1)) AS m FROM src",
    "mods0": f"SELECT d, course_id, m, {_select(MODULE)} FROM mseq",
    "mods": "SELECT *, max(m) OVER (PARTITION BY d, id) AS mod_idx FROM mods0",
    "midx": "SELECT DISTINCT d, id AS mid, mod_idx FROM mods",
    "pl": """SELECT les.*, coalesce(mod_idx, 1000000) AS mod_idx, coalesce(ord, 0) AS o FROM les
             LEFT JOIN midx ON midx.d = les.d AND midx.mid = les.module""",
    "pos": "SELECT *, row_number() OVER (PARTITION BY d ORDER BY mod_idx, o, i) - 1 AS pos, mod_idx * 1000000000 + o * 1000000 + i AS pkey FROM pl",
    "bk": "SELECT *, CASE WHEN kind IN ('build', 'concept') THEN kind ELSE 'build' END AS k2, coalesce(kind, 'build') AS k1 FROM pos",
    "node": "SELECT d, course_id, unnest(['s0','s1','s2','s3','s4','s5','s6','s7']) AS node FROM src",
    "edge": f"SELECT d, course_id, i, {EDGE_SRC} AS src, {EDGE_DST} AS dst FROM ln",
    "qs": """SELECT d, course_id, i, id AS lesson_id, 0 AS q_pos, q1_id AS q_id, q1_prompt AS prompt, false AS multi, explanation,
               ['a','b','c'] AS oids, [label_1, label_2, label_3] AS labels, [q1_slot = 0, q1_slot = 1, q1_slot = 2] AS rights,
               [q1_feedback, q1_feedback, q1_feedback] AS feeds FROM les WHERE quiz = 'two'
             UNION ALL SELECT d, course_id, i, id, 1, q2_id, 'why?', q2_multi, 'so', ['a', q2_oid], [label_1, label_3], [q2_a, q2_b], ['no','no']
               FROM les WHERE quiz = 'two'""",
    "ch": """SELECT d, course_id, i, id AS lesson_id, 0 AS pos, c1_id AS cid, c1_lang AS lang, CAST(NULL AS VARCHAR) AS build, c1_starter AS starter,
               'challenges/l' || i || '/solution' AS solution, c1_tests AS tests, true AS accept FROM les WHERE challenges = 'two'
             UNION ALL SELECT d, course_id, i, id, 1, c2_id, 'typescript', c2_build, 'challenges/s', NULL, 'challenges/t.json', c2_accept
               FROM les WHERE challenges = 'two'""",
    "art": """SELECT d, course_id, id AS lesson_id, artifact AS aid, consume_1, consume_2, terminal IS NOT NULL AS term, pkey FROM pos WHERE artifact IS NOT NULL""",
    "uses": """SELECT a.d, a.course_id, a.lesson_id, a.aid, a.pkey, u.c AS consumed, b.built FROM art a, unnest([consume_1, consume_2]) AS u(c)
               LEFT JOIN (SELECT d, aid, max(pkey) AS built FROM art GROUP BY ALL) b ON b.d = a.d AND b.aid = u.c""",
    "pre": """SELECT p.d, p.course_id, p.id AS lesson_id, p.mod_idx, p.pkey, u.c AS pre,
               CASE WHEN u.c IN (SELECT id FROM les WHERE les.d = p.d) THEN 'lesson' WHEN u.c IN ('s0','s1','s2','s3','s4','s5','s6','s7') THEN 'skill'
                    ELSE 'unknown' END AS kind
             FROM pos p, unnest([pre_1, pre_2]) AS u(c) WHERE p.pre_1 IS NOT NULL""",
    "tea": "SELECT d, course_id, id AS module_id, mod_idx, unnest([teach_1, teach_2]) AS skill FROM mods",
    "de": """SELECT DISTINCT d, course_id, src, dst FROM edge WHERE src IN ('s0','s1','s2','s3','s4','s5','s6','s7')
             AND dst IN ('s0','s1','s2','s3','s4','s5','s6','s7')""",
    "walk": """SELECT d, course_id, dst AS node, 1 AS len FROM de UNION
               SELECT w.d, w.course_id, e.dst, w.len + 1 FROM walk w JOIN de e ON e.d = w.d AND e.src = w.node WHERE w.len < 8""",
    "kedge": """SELECT d, i, CAST(substr(src, 2) AS INT) + 1 AS a, CAST(substr(dst, 2) AS INT) + 1 AS b FROM edge WHERE dst IN ('s0','s1','s2','s3','s4','s5','s6','s7')""",
    "kout": """SELECT d, a, list_transform(range(1, 9), lambda x: len(list_filter(bs, lambda y: y = x))) AS minus,
               list_transform(range(1, 9), lambda x: 100000 - coalesce(list_position(list_reverse(bs), x), 0)) AS lasts FROM (SELECT d, a, list(b ORDER BY i) AS bs FROM kedge GROUP BY ALL)""",
    "kin": """SELECT src.d, src.course_id, list_transform(range(1, 9), lambda x: len(list_filter(coalesce(bs, []), lambda y: y = x))) AS g
              FROM src LEFT JOIN (SELECT d AS kd, list(b) AS bs FROM kedge GROUP BY d) ON kd = src.d""",
    "kahn": """SELECT d, course_id, g, list_filter(range(1, 9), lambda x: g[x] = 0) AS q, list_transform(list_filter(range(1, 9), lambda x: g[x] = 0), lambda x: 0) AS ds, 1 AS p FROM kin
               UNION ALL SELECT d, course_id, list_transform(range(1, 9), lambda x: g[x] - minus[x]), q || new_, ds || list_transform(new_, lambda x: ds[p] + 1), p + 1
               FROM (SELECT kahn.*, coalesce(minus, [0, 0, 0, 0, 0, 0, 0, 0]) AS minus,
                       list_transform(list_sort(list_transform(list_filter(range(1, 9), lambda x: coalesce(minus[x], 0) > 0 AND g[x] = minus[x]), lambda x: [lasts[x], x])), lambda s: s[2]) AS new_
                     FROM kahn LEFT JOIN kout ON kout.d = kahn.d AND kout.a = kahn.q[kahn.p] WHERE p <= len(q))""",
    "ans": """SELECT *, list_position(rights, true) AS slot, list_transform(labels, lambda v: length(v)) AS lens FROM qs
              WHERE NOT multi AND len(list_filter(rights, lambda r: r)) = 1""",
    "first": "SELECT d, skill, min(mod_idx) AS seen_at FROM tea GROUP BY ALL",
}
