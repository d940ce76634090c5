"""Queries over manifests derived from `documents`, each with its DuckDB counterpart."""
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern import vocab
from lectern.functions.text import module_slug
from lectern.operators import briefs, challenges, course, graph, publish, quiz, state
from lectern.operators.flags import union
from lectern.operators.gate import check_verdicts, gate, severity_matrix, suite_report
from lectern.plans.checks import run_checks
from lectern.sources.manifests import one_per_course, parse_manifests, repeated_courses
from oracle.draft_queries import phrases, phrases_sql
from oracle import manifest_data as md
from oracle.shared import flag_sql, staged, union_sql, with_ctes

H, A = "'HARD'", "'advisory'"
Q: dict = {}
SQL: dict = {}


def add(name, spark_fn, sql=None, tables=True):
    """spark_fn(tables, spark, sf); without tables it reads the manifests' texts alone and none are staged."""
    Q[name] = lambda spark, sf: spark_fn(md.tables(spark, sf) if tables else None, spark, sf)
    if sql:
        SQL[name] = with_ctes(md.CTES, sql)


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def blank(c: str) -> str:
    """Null or only space. The derived values hold no other space than U+0020 outside words."""
    return f"(NOT coalesce(regexp_matches({c}, '[^\\s\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]'), false))"


def slug_sql(c: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(lower({c}), '[^a-z0-9-]', '-', 'g'), '-'), ''), 'x')"


def stem_sql(c: str = None) -> str:
    idx = "CASE WHEN mod_idx = 1000000 THEN 99 ELSE mod_idx END"
    return f"printf('m%02d-l%d-', CAST({idx} AS INT), CAST(o AS BIGINT)) || {c or slug_sql('id')}"


# ---- sources and flattening ----------------------------------------------------------------------

add("s01_rejected_manifests", lambda t, s, sf: parse_manifests(md.texts(s, sf))[1],
    "SELECT 'damaged/' || doc_id || '/manifest.json' AS path, 'not JSON' AS reason FROM documents WHERE doc_id % 50 = 49", tables=False)


def repeated(t, s, sf):
    """Every seventh manifest stands in a second folder too, before or after its own."""
    rows = staged(s, sf, "claims", lambda: md.manifests(s, sf).select("course_id", "path"))
    number = F.split_part("path", F.lit("/"), F.lit(2)).cast("bigint")
    again = rows.filter(number % 7 == 0).withColumn("path", F.concat(F.when(number % 2 == 0, "archive/").otherwise("zoo/"), "path"))
    twice = rows.unionByName(again)
    return one_per_course(twice, staged(s, sf, "repeated", lambda: repeated_courses(twice)))[1]


add("s01_repeated_courses", repeated, flag_sql("manifest", "repeated_course", H, "CASE WHEN d % 2 = 0 THEN p ELSE 'zoo/' || p END", "CASE WHEN d % 2 = 0 THEN 'archive/' || p ELSE p END",
                                               "FROM (SELECT *, 'catalog/' || d || '/manifest.json' AS p FROM src) WHERE d % 7 = 0"), tables=False)
add("p01_modules", lambda t, s, sf: t["modules"].select("course_id", "module_id", F.col("pos").cast("bigint").alias("pos"),
                                                         F.col("mod_idx").cast("bigint").alias("mod_idx"), "title", "rung", "band"),
    "SELECT course_id, id AS module_id, m AS pos, mod_idx, coalesce(title, id) AS title, rung, band FROM mods")
add("p02_lesson_order", lambda t, s, sf: t["lessons"].select("course_id", "lesson_id", F.col("mod_idx").cast("bigint").alias("mod_idx"), "ord",
                                                             F.col("lesson_pos").cast("bigint").alias("lesson_pos")),
    "SELECT course_id, id AS lesson_id, mod_idx, o AS ord, pos AS lesson_pos FROM pos")
add("p03_prereqs", lambda t, s, sf: t["prereqs"].select("course_id", "lesson_id", "pre", "kind"),
    "SELECT course_id, lesson_id, pre, kind FROM pre")
add("p04_first_taught", lambda t, s, sf: t["first_taught"].select("course_id", "skill", F.col("at").cast("bigint").alias("at")),
    "SELECT course_id, skill, min(mod_idx) AS \"at\" FROM tea GROUP BY course_id, skill")
add("p05_dag_edges", lambda t, s, sf: t["edges"], "SELECT course_id, src, dst FROM edge")
add("p06_quiz_options", lambda t, s, sf: t["options"].select("course_id", "question", "q_id", F.col("pos").cast("bigint").alias("pos"), "o_id", "correct", "label"),
    """SELECT course_id, lesson_id || '#0#' || q_pos AS question, q_id, CAST(p - 1 AS BIGINT) AS pos, oids[p] AS o_id, rights[p] AS correct,
       labels[p] AS label FROM (SELECT *, unnest(range(1, len(oids) + 1)) AS p FROM qs)""")


def list_sizes(t, s, sf):
    names = ["claims", "facts", "artifacts", "schedule", "outcomes", "proofs", "challenges"]
    return union(*[t[n].groupBy("course_id").agg(F.count("*").alias("n")).select("course_id", F.lit(n).alias("list"), "n") for n in names])


add("p07_course_lists", list_sizes, union_sql(
    "SELECT course_id, 'claims' AS list, count(*) AS n FROM les WHERE research IS NOT NULL GROUP BY course_id",
    "SELECT course_id, 'facts', 2 * count(*) FROM les WHERE research IS NOT NULL GROUP BY course_id",
    "SELECT course_id, 'artifacts', count(*) FROM art GROUP BY course_id",
    "SELECT course_id, 'schedule', count(*) FROM ln WHERE d % 4 <> 0 AND i % 5 <> 4 GROUP BY course_id",
    "SELECT course_id, 'outcomes', 3 FROM src", "SELECT course_id, 'proofs', 2 FROM src",
    "SELECT course_id, 'challenges', count(*) FROM ch GROUP BY course_id"))
add("p08_stems", lambda t, s, sf: t["stems"].select("course_id", "lesson_id", "stem", "quiz_stem"),
    f"SELECT course_id, id AS lesson_id, {stem_sql()} AS stem, {stem_sql('id')} AS quiz_stem FROM pos")
add("p08_module_slugs", lambda t, s, sf: t["modules"].select("course_id", "module_id", module_slug(F.col("module_id")).alias("slug")),
    f"SELECT course_id, id AS module_id, {slug_sql('id')} AS slug FROM mods")
add("p09_brief_defaults", lambda t, s, sf: t["briefs"].select("course_id", "lesson_id", "declared_kind", "kind"),
    "SELECT course_id, id AS lesson_id, k1 AS declared_kind, k2 AS kind FROM bk")

# ---- structure -------------------------------------------------------------------------------------

RULES: dict = {}


def rule(name, spark_fn, *sqls):
    """A rule query; its SQL parts also join the full run."""
    RULES[name] = sqls
    add(name, lambda t, s, sf: spark_fn(t), union_sql(*sqls))


KEBAB = "'^[a-z0-9][a-z0-9-]*$'"
rule("g01_bad_ids", lambda t: graph.bad_ids(t["ids"]), *[
    flag_sql("dag", "bad_id", H, c, f"'{k}'", f"FROM {src} WHERE NOT regexp_matches({c}, {KEBAB})")
    for k, src, c in (("course", "src", "course_id"), ("module", "mods", "id"), ("lesson", "les", "id"))])
rule("g05_duplicate_modules", lambda t: graph.duplicate_modules(t["modules"]),
     flag_sql("dag", "duplicate_module", H, "id", "''", "FROM mods GROUP BY course_id, id HAVING count(*) > 1"))
rule("g06_unknown_module_deps", lambda t: graph.unknown_module_deps(t["module_deps"], t["modules"]),
     flag_sql("dag", "unknown_module_dep", H, "id", "dep", "FROM mods a WHERE dep IS NOT NULL AND dep NOT IN (SELECT b.id FROM mods b WHERE b.d = a.d)"))
rule("g07_unknown_module_skills", lambda t: graph.unknown_module_skills(t["module_skills"], t["nodes"]),
     flag_sql("dag", "unknown_module_skill", H, "id", "skill", "FROM (SELECT course_id, id, unnest([require_1, teach_1, teach_2]) AS skill FROM mods) "
              "WHERE skill NOT IN ('s0','s1','s2','s3','s4','s5','s6','s7')"))
rule("b01_duplicate_lessons", lambda t: briefs.duplicate_lessons(t["lessons"]),
     flag_sql("briefs", "duplicate_lesson", H, "id", "''", "FROM les GROUP BY course_id, id HAVING count(*) > 1"))
rule("b02_bad_opener", lambda t: briefs.bad_opener(t["briefs"]),
     flag_sql("briefs", "bad_opener", A, "id", "dominant_job", "FROM pos WHERE pos = 0 AND dominant_job IS DISTINCT FROM 'motivate'"))
rule("b03_bad_kind", lambda t: briefs.bad_kind(t["briefs"]),
     flag_sql("briefs", "bad_kind", H, "id", "k1", "FROM bk WHERE k1 NOT IN ('build', 'concept')"))

_miss = {k: blank(k) for k in ("id", "title", "hook", "concept_spec", "the_tradeoff", "assessment", "dominant_job")}
_miss |= {"objectives": "objectives = 'null'", "prerequisites": "pre_1 IS NULL", "just_in_time": "false", "difficulty": "difficulty IS NULL"}
_build = {k: f"k2 = 'build' AND {blank(k)}" for k in vocab.BRIEF_BUILD_KEYS}
_keys = ", ".join(f"CASE WHEN {({**_miss, **_build})[k]} THEN '{k}' END" for k in vocab.BRIEF_CORE_KEYS + vocab.BRIEF_BUILD_KEYS)
rule("b04_missing_keys", lambda t: briefs.missing_keys(t["briefs"]),
     flag_sql("briefs", "missing_keys", H, "id", "keys", f"FROM (SELECT course_id, id, concat_ws(',', {_keys}) AS keys FROM bk) WHERE keys <> ''"))
rule("b05_no_objectives", lambda t: briefs.no_objectives(t["briefs"]),
     flag_sql("briefs", "no_objectives", H, "id", "''", "FROM les WHERE objectives <> 'two'"))
rule("b06_bad_job", lambda t: briefs.bad_job(t["briefs"]),
     flag_sql("briefs", "bad_job", "CASE WHEN dominant_job IN ('frame', 'demystify') THEN 'advisory' ELSE 'HARD' END", "id", "dominant_job",
              "FROM les WHERE dominant_job IS NULL OR dominant_job IN ('frame', 'demystify', 'explain')"))
rule("b07_passive_gate", lambda t: briefs.passive_gate(t["briefs"]),
     flag_sql("briefs", "gate", H, "id", "found", """FROM (SELECT *, CASE WHEN coalesce(trim(g), '') = '' THEN 'no_gate'
        WHEN regexp_matches(g, '(?i)\\b(watch|read|review the video|listen|observe)\\b')
         AND NOT regexp_matches(g, '(?i)\\b(build|write|deploy|derive|implement|test|pass|ship|fix|run|submit|create)\\b') THEN 'passive_gate' END AS found
        FROM (SELECT *, replace(assessment, '@', '') AS g FROM les)) WHERE found IS NOT NULL"""))
rule("b08_no_verify", lambda t: briefs.no_verify(t["briefs"]),
     flag_sql("briefs", "no_verify", A, "id", "''", "FROM bk WHERE k2 = 'build' AND command IS NULL"))


def doc_phrases(spark, sf):
    """All word triples of benchmark items: a list that grows with the table."""
    return staged(spark, sf, "phrases", lambda: phrases(spark, sf, 3))


add("b09_blocklist_hits", lambda t, s, sf: briefs.blocklist_hits(t["briefs"], doc_phrases(s, sf)),
    flag_sql("briefs", "blocklist", H, "id", "phrase", f"""FROM (SELECT course_id, id, phrase FROM (SELECT course_id, id,
      lower(concat_ws(chr(10), title, hook, concept_spec, artifact_spec)) AS low FROM les), {phrases_sql(3)} WHERE contains(low, phrase))"""))
rule("b10_bad_difficulty", lambda t: briefs.bad_difficulty(t["briefs"]),
     flag_sql("briefs", "bad_difficulty", A, "id", "difficulty", "FROM les WHERE difficulty NOT BETWEEN 1 AND 3"))
rule("b11_weak_verbs", lambda t: briefs.weak_verbs(t["briefs"]),
     flag_sql("briefs", "weak_verb", A, "id", "p", f"""FROM (SELECT course_id, id, unnest([0, 1]) AS p, unnest([objective_1, objective_2]) AS o FROM les
        WHERE objectives = 'two') WHERE {' OR '.join(f"contains(lower(o), '{v}')" for v in vocab.WEAK_VERBS)}"""))
rule("b12_short_target", lambda t: briefs.short_target(t["briefs"]),
     flag_sql("briefs", "short_target", A, "id", "target", """FROM (SELECT course_id, id, list_max(list_transform(regexp_extract_all(est_length, '[0-9,]+'),
        lambda n: TRY_CAST(replace(n, ',', '') AS BIGINT))) AS target FROM les) WHERE target > 0 AND target < 3000"""))
rule("l01_no_rung", lambda t: course.no_rung(t["modules"]),
     flag_sql("ladder", "no_rung", A, "id", "''", "FROM mods WHERE rung IS NULL"))
_before = "OVER (PARTITION BY d ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
rule("l02_ladder_in_manifests", lambda t: course.ladder_backward(t["modules"]),
     flag_sql("ladder", "ladder_backward", H, "id", "rung || '<' || top", f"FROM (SELECT *, max(rung) {_before} AS top FROM mods WHERE rung IS NOT NULL) WHERE rung < top"))
rule("l03_band_in_manifests", lambda t: course.band_dip(t["modules"]),
     flag_sql("ladder", "band_dip", A, "id", "band || '<' || lb",
              f"FROM (SELECT *, coalesce(last_value(band IGNORE NULLS) {_before}, 0) AS lb FROM mods WHERE rung IS NOT NULL) WHERE band < lb"))
rule("l04_unscheduled", lambda t: course.unscheduled(t["lessons"], t["weeks"], t["schedule"]),
     flag_sql("ladder", "unscheduled", A, "id", "''", """FROM (SELECT DISTINCT d, course_id, id FROM les WHERE d % 4 <> 0) a WHERE id NOT IN
        (SELECT 'l' || i FROM ln WHERE ln.d = a.d AND i % 5 <> 4)"""))
rule("l05_capstone_untaught", lambda t: course.capstone_untaught(t["courses"], t["capstone_skills"], t["teaches"]),
     flag_sql("capstone", "capstone_untaught", H, "'s' || d % 9", "''", "FROM src WHERE d % 10 <> 0 AND 's' || d % 9 NOT IN (SELECT skill FROM tea WHERE tea.d = src.d)"),
     flag_sql("capstone", "no_capstone", A, "course_id", "''", "FROM src WHERE d % 10 = 0"))
rule("l06_length_mismatch", lambda t: course.length_mismatch(t["courses"]),
     flag_sql("length", "length_mismatch", H, "course_id", "(n + 1) || '<>' || n", "FROM src WHERE d % 5 = 0"))
rule("o01_unproven_outcomes", lambda t: course.unproven_outcomes(t["outcomes"], t["proofs"]),
     flag_sql("outcomes", "unproven_outcome", H, "o", "''", "FROM (SELECT d, course_id, unnest(['to-1', 'to-2']) AS o FROM src) WHERE o <> 'to-' || d % 5"))
rule("o02_unknown_proofs", lambda t: course.unknown_proofs(t["outcomes"], t["proofs"]),
     flag_sql("outcomes", "unknown_proof", H, "'to-' || d % 5", "''", "FROM src WHERE d % 5 > 2"))
rule("o03_bad_traces", lambda t: course.bad_traces(t["modules"], t["outcomes"]),
     flag_sql("outcomes", "no_trace", A, "id", "''", "FROM mods WHERE trace IS NULL"),
     flag_sql("outcomes", "unknown_trace", H, "id", "trace", "FROM mods WHERE trace = 'to-3'"))
rule("r01_no_research", lambda t: course.no_research(t["lessons"]),
     flag_sql("research", "no_research", A, "id", "''", "FROM les WHERE research IS NULL"))
rule("r02_claims_in_manifests", lambda t: course.off_list_claims(t["claims"]),
     flag_sql("research", "off_list_claim", H, "id || '/C' || i", "claim_surface", "FROM les WHERE research = 'verified' AND coalesce(claim_surface, '') NOT IN ('web', 'helius')"))
rule("a01_duplicate_artifacts", lambda t: course.duplicate_artifacts(t["artifacts"]),
     flag_sql("artifacts", "duplicate_artifact", H, "aid", "''", "FROM art GROUP BY course_id, aid HAVING count(*) > 1"))
rule("a02_unknown_consumes", lambda t: course.unknown_consumes(t["artifacts"]),
     flag_sql("artifacts", "unknown_consumes", H, "lesson_id || '/' || aid", "consumed", "FROM uses WHERE built IS NULL"))
rule("a03_backward_consumes", lambda t: course.backward_consumes(t["artifacts"]),
     flag_sql("artifacts", "backward_consumes", H, "lesson_id || '/' || aid", "consumed", "FROM uses WHERE built >= pkey"))
rule("a04_unconsumed", lambda t: course.unconsumed(t["artifacts"]),
     flag_sql("artifacts", "unconsumed", A, "lesson_id || '/' || aid", "''", """FROM (SELECT *, max(pkey) OVER (PARTITION BY d) AS top FROM art) a
        WHERE NOT term AND pkey < top AND aid NOT IN (SELECT consumed FROM uses WHERE uses.d = a.d AND built < uses.pkey)"""))
rule("w01_routing_budget", lambda t: course.routing_budget(t["courses"]),
     flag_sql("routing", "routing_budget", A, "course_id", "'backbone'", "FROM src WHERE d % 7 = 0"),
     flag_sql("routing", "routing_budget", A, "course_id", "'guests'", "FROM src WHERE d % 4 > 1"),
     flag_sql("routing", "routing_budget", A, "course_id", "'template'", "FROM src WHERE d % 5 = 2"))

# ---- quiz and challenges ---------------------------------------------------------------------------

WHERE = "lesson_id || '#0#' || q_pos"
rule("q01_not_a_list", lambda t: quiz.not_a_list(t["lessons"]),
     flag_sql("briefs", "not_a_list", H, "id", "'quiz_blocks'", "FROM les WHERE quiz = 'wrong'"),
     flag_sql("briefs", "not_a_list", H, "id", "'coding_challenges'", "FROM les WHERE challenges = 'wrong'"))
rule("q02_empty_quiz", lambda t: quiz.empty_quiz(t["quiz_blocks"]),
     flag_sql("briefs", "empty_quiz", H, "id", "0", "FROM les WHERE quiz = 'empty'"))
rule("q03_bad_questions", lambda t: quiz.bad_questions(t["questions"]),
     flag_sql("briefs", "question_without_id", H, WHERE, "''", "FROM qs WHERE q_id = ''"),
     flag_sql("briefs", "duplicate_question", H, "lesson_id || '#0'", "q_id", "FROM qs WHERE q_id <> '' GROUP BY course_id, lesson_id, q_id HAVING count(*) > 1"),
     flag_sql("briefs", "no_prompt", H, WHERE, "''", f"FROM qs WHERE {blank('prompt')}"))
rule("q04_few_options", lambda t: quiz.few_options(t["questions"]),
     flag_sql("briefs", "few_options", A, WHERE, "2", "FROM qs WHERE len(oids) = 2"))
rule("q05_bad_option_ids", lambda t: quiz.bad_option_ids(t["questions"]),
     flag_sql("briefs", "option_without_id", H, WHERE, "''", "FROM qs WHERE list_contains(oids, '')"),
     flag_sql("briefs", "duplicate_option", H, WHERE, "''", "FROM qs WHERE len(list_distinct(oids)) < len(oids)"))
_n = "len(list_filter(rights, lambda r: r))"
rule("q06_bad_correctness", lambda t: quiz.bad_correctness(t["questions"]),
     flag_sql("briefs", "bad_correctness", H, WHERE, _n, f"FROM qs WHERE CASE WHEN multi THEN {_n} < 1 ELSE {_n} <> 1 END"))
rule("q07_missing_feedback", lambda t: quiz.missing_feedback(t["questions"]),
     flag_sql("briefs", "no_feedback", A, WHERE, "oid", """FROM (SELECT course_id, lesson_id, q_pos, unnest(oids) AS oid, unnest(rights) AS r, unnest(feeds) AS f FROM qs)
        WHERE NOT r AND f = ''"""),
     flag_sql("briefs", "no_explanation", A, WHERE, "''", "FROM qs WHERE explanation IS NULL"))
CW = "lesson_id || '/' || coalesce(nullif(cid, ''), CAST(pos AS VARCHAR))"
rule("c01_bad_challenge", lambda t: challenges.bad_challenge(t["challenges"]),
     flag_sql("briefs", "challenge_without_id", H, CW, "''", "FROM ch WHERE cid = ''"),
     flag_sql("briefs", "bad_challenge_id", H, CW, "''", "FROM ch WHERE cid = 'Bad Id'"),
     flag_sql("briefs", "duplicate_challenge", H, "lesson_id || '/' || cid", "''", "FROM ch WHERE cid NOT IN ('', 'Bad Id') GROUP BY course_id, lesson_id, cid HAVING count(*) > 1"),
     flag_sql("briefs", "bad_language", H, CW, "lang", "FROM ch WHERE lang NOT IN ('rust', 'typescript')"),
     flag_sql("briefs", "bad_build_type", H, CW, "build", "FROM ch WHERE build = 'other'"))
rule("c02_incomplete_challenge", lambda t: challenges.incomplete_challenge(t["challenges"]),
     flag_sql("briefs", "buildable_not_rust", A, CW, "lang", "FROM ch WHERE build = 'buildable' AND lang <> 'rust'"),
     flag_sql("briefs", "missing_reference", H, CW, "'starter'", "FROM ch WHERE coalesce(starter, '') = ''"),
     flag_sql("briefs", "missing_reference", H, CW, "'solution'", "FROM ch WHERE coalesce(solution, '') = ''"),
     flag_sql("briefs", "no_acceptance_criteria", A, CW, "''", "FROM ch WHERE NOT accept"))


def lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("d"), F.size(F.split("text", "\n", -1)).alias("n"))
    return docs.select("d", F.expr(md.COURSE_ID).alias("course_id"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))


FILES = ["SELECT course_id, 'challenges/l' || i || '/starter' AS path FROM {0} WHERE i % 3 <> 0",
         "SELECT course_id, 'challenges/l' || i || '/solution' AS path FROM {0} WHERE i % 2 = 0",
         "SELECT course_id, 'challenges/l' || i || '/tests.json' AS path FROM {0} WHERE (d + i) % 4 <> 0",
         "SELECT DISTINCT course_id, 'challenges/s' AS path FROM {0} WHERE d % 2 = 0"]
TEST_TEXT = """CASE (d + i) % 5 WHEN 0 THEN '[{"id":"a","input":"1","expectedOutput":"2"}]'
  WHEN 1 THEN '[ ]' WHEN 2 THEN 'not json' WHEN 3 THEN '[{"id":"a"}]' ELSE '{"a":1}' END"""


def challenge_files(spark, sf):
    """FILES in one pass over the lines; the folder shared by a course comes with its first line."""
    path = F.array_compact(F.array(*[F.expr(f"CASE WHEN {where} THEN {value} END") for value, where in (
        ("'challenges/l' || i || '/starter'", "i % 3 <> 0"), ("'challenges/l' || i || '/solution'", "i % 2 = 0"),
        ("'challenges/l' || i || '/tests.json'", "(d + i) % 4 <> 0"), ("'challenges/s'", "d % 2 = 0 AND i = 0"))]))
    return lines(spark, sf).select("course_id", F.explode(path).alias("path"))


def test_files(spark, sf):
    value, rest = F.expr(TEST_TEXT), lines(spark, sf)
    return rest.select("course_id", F.expr("'challenges/l' || i || '/tests.json'").alias("path"), value.alias("value"))


def file_rule(name, spark_fn, sql):
    RULES[name] = (sql,)
    add(name, spark_fn, sql)


file_rule("c03_missing_files", lambda t, s, sf: challenges.missing_files(t["challenges"], challenge_files(s, sf)),
    flag_sql("challenges", "missing_file", H, CW, "role || ':' || path", f"""FROM (SELECT course_id, lesson_id, cid, pos, unnest(['starter','solution','tests']) AS role,
      unnest([starter, solution, tests]) AS path FROM ch) WHERE coalesce(path, '') <> '' AND (course_id, path) NOT IN ({union_sql(*[f.replace("{0}", "ln") for f in FILES])})"""))
file_rule("c04_bad_tests", lambda t, s, sf: challenges.bad_tests(t["challenges"], test_files(s, sf)),
    flag_sql("challenges", "bad_tests", H, CW, "found", f"""FROM (SELECT ch.*, CASE (ch.d + ch.i) % 5 WHEN 1 THEN 'tests_not_array' WHEN 2 THEN 'tests_not_json'
      WHEN 3 THEN 'test_incomplete' WHEN 4 THEN 'tests_not_array' END AS found FROM ch WHERE pos = 0) WHERE found IS NOT NULL"""))
add("x16_smoke_eligibility", lambda t, s, sf: briefs.smoke_eligibility(t["briefs"]),
    "SELECT course_id, id AS lesson_id, command, NOT starts_with(command, 'curl') AS eligible FROM les WHERE command IS NOT NULL")

# ---- publishing ------------------------------------------------------------------------------------

add("u01_publish_meta", lambda t, s, sf: publish.publish_meta(t["courses"]).withColumn("duration", F.round(100 * F.col("duration")).cast("bigint")),
    f"""SELECT course_id, {slug_sql('course_id')} AS slug, regexp_replace(substr('course-' || {slug_sql('course_id')}, 1, 32), '-+$', '') AS publish_id,
      coalesce(CASE WHEN d % 4 = 0 THEN 'p' || d END, substr(CASE WHEN d % 41 = 0 THEN 'C' ELSE 'c' || substr(CAST(d AS VARCHAR), 1, 1) END, 1, 6)) AS prefix,
      'Doc ' || d AS title, lines[1] AS description, 'beginner' AS difficulty,
      CAST(CASE WHEN d % 6 = 0 THEN n * 100 WHEN n >= 4 THEN ceil(n * 0.25) * 100 ELSE n * 25 END AS BIGINT) AS duration,
      CASE WHEN d % 2 = 0 THEN 10 + d % 120 ELSE 20 END AS xp_per_lesson, least(5000, 20 * n) AS xp_reward,
      '{vocab.DEFAULT_CREATOR}' AS creator, n AS n_lessons FROM src""")


def overridden(t, s, sf):
    """Every third course has its title, points and hours set by the publisher, null or empty where they are not."""
    set_ = t["courses"].filter("pmod(length(course_id), 3) = 0").select(
        "course_id", F.when(F.col("n_lessons") % 2 == 0, F.concat(F.lit("Set "), "course_id")).otherwise("").alias("title"),
        F.when(F.col("n_lessons") % 3 == 0, 50).cast("bigint").alias("xpPerLesson"), F.lit(2.5).alias("duration"))
    return publish.publish_meta(t["courses"], set_).select("course_id", "title", "xp_per_lesson", F.round(100 * F.col("duration")).cast("bigint").alias("duration"), "xp_reward")


add("u01_overrides", overridden, """SELECT course_id, CASE WHEN mine AND n % 2 = 0 THEN 'Set ' || course_id ELSE 'Doc ' || d END AS title,
    CASE WHEN mine AND n % 3 = 0 THEN 50 WHEN d % 2 = 0 THEN 10 + d % 120 ELSE 20 END AS xp_per_lesson,
    CAST(CASE WHEN mine THEN 250 WHEN d % 6 = 0 THEN n * 100 WHEN n >= 4 THEN ceil(n * 0.25) * 100 ELSE n * 25 END AS BIGINT) AS duration, least(5000, 20 * n) AS xp_reward
  FROM (SELECT *, length(course_id) % 3 = 0 AS mine FROM src)""")


def skills(t, s, sf):
    rows = t["lessons"].select("course_id", "lesson_id", "module_id", F.col("brief.prerequisites").alias("prerequisites"))
    return publish.lesson_skills(rows, t["modules"], t["courses"]).withColumn("skills", F.array_join("skills", ","))


SKILLS_SQL = """SELECT course_id, lesson_id, CASE WHEN s <> '' THEN s WHEN d % 2 = 0 THEN 'general' ELSE '' END AS skills FROM (
  SELECT les.d, les.course_id, les.id AS lesson_id, CASE WHEN les.d % 2 = 1 THEN '' ELSE
    array_to_string(list_filter([
      CASE WHEN b_at IS NOT NULL THEN CASE WHEN a_at IS NULL OR b_at < a_at THEN 'basics' ELSE 'accounts' END WHEN a_at IS NOT NULL THEN 'accounts' END,
      CASE WHEN b_at IS NOT NULL AND a_at IS NOT NULL THEN CASE WHEN b_at < a_at THEN 'accounts' ELSE 'basics' END END], lambda v: v IS NOT NULL), ',') END AS s
  FROM (SELECT l.*, list_position(list_transform(nodes, lambda v: v IN ('s0', 's2')), true) AS b_at, list_position(nodes, 's1') AS a_at
    FROM (SELECT les.*, list_concat(coalesce(tt, []), CASE WHEN pre_1 IS NULL THEN [] ELSE [pre_1, pre_2] END) AS nodes FROM les
      LEFT JOIN (SELECT d AS td, id AS tid, arg_min([teach_1, teach_2], m) AS tt FROM mods GROUP BY ALL) ON td = les.d AND tid = les.module) l) les)"""
add("u03_lesson_skills", skills, SKILLS_SQL)


def blocks(t, s, sf):
    return publish.lesson_blocks(t["lessons"])[0].withColumn("pos", F.col("pos").cast("bigint"))


add("u04_lesson_blocks", blocks, f"""SELECT course_id, lesson_id, row_number() OVER (PARTITION BY course_id, i ORDER BY r, p) - 1 AS pos, key, type, language FROM (
  SELECT course_id, i, id AS lesson_id, 0 AS r, 0 AS p, 'intro' AS key, 'prose' AS type, NULL AS language FROM les
  UNION ALL SELECT course_id, i, lesson_id, 1, pos, {slug_sql('cid')}, 'code', lang FROM ch WHERE lang <> 'go'
  UNION ALL SELECT course_id, i, id, 2, 0, {slug_sql("coalesce(quiz_key, 'check')")}, 'quiz', NULL FROM les WHERE quiz IN ('two', 'empty'))""")
add("u04_skipped_blocks", lambda t, s, sf: publish.lesson_blocks(t["lessons"])[1],
    f"SELECT course_id, lesson_id, {slug_sql('cid')} AS key, lang AS language FROM ch WHERE lang = 'go'")

# ---- the graph and the audits inside manifests ------------------------------------------------------

NODES = "('s0','s1','s2','s3','s4','s5','s6','s7')"
rule("g02_edges_in_manifests", lambda t: graph.dangling_edges(t["nodes"], t["edges"]),
     flag_sql("dag", "dangling_edge", H, "src || '->' || dst", "''", f"FROM (SELECT DISTINCT course_id, src, dst FROM edge WHERE src NOT IN {NODES} OR dst NOT IN {NODES})"))
rule("g03_cycles_in_manifests", lambda t: graph.cycle_flags_in_rows(t["graphs"]),
     flag_sql("dag", "cycle", H, "node", "''", "FROM walk WHERE len = 8"))


def ledger(t, s, sf):
    """Every third stem has a draft."""
    drafted = t["stems"].select("course_id", "stem").filter("pmod(length(stem) + length(course_id), 3) = 0")
    return state.ledger_rows(t["lessons"], drafted).withColumn("blocked_by", F.array_join("blocked_by", ","))


add("t02_ledger_rows", ledger, f"""SELECT * FROM (WITH nm AS (SELECT d AS nd, id AS nid, st, (length(st) + length(course_id)) % 3 = 0 AS drafted
    FROM (SELECT *, {stem_sql()} AS st FROM pos QUALIFY row_number() OVER (PARTITION BY d, id ORDER BY pos DESC) = 1)),
  bl AS (SELECT d AS bd, i AS bi, string_agg(pre, ',' ORDER BY k) AS blocked FROM (SELECT d, i, unnest([pre_1, pre_2]) AS pre, unnest([1, 2]) AS k FROM pos WHERE pre_1 IS NOT NULL)
    JOIN nm ON nd = d AND nid = pre AND NOT drafted GROUP BY ALL)
  SELECT course_id, pos + 1 AS no, id AS lesson_id, module AS module_id, CASE WHEN drafted THEN 'drafted' WHEN research = 'verified' THEN 'researched' ELSE 'briefed' END AS status, dominant_job,
    'lessons/briefs/' || st || '.brief.yaml' AS brief_file, CASE WHEN research IS NOT NULL THEN 'lessons/research/' || st || '.research.yaml' END AS research_file,
    CASE WHEN research IS NOT NULL THEN 'lessons/facts/' || st || '.facts.md' END AS facts_file, CASE WHEN drafted THEN 'lessons/drafts/' || st || '.md' END AS draft_file,
    coalesce(blocked, '') AS blocked_by
  FROM pos JOIN nm ON nd = d AND nid = id LEFT JOIN bl ON bd = d AND bi = i)""")
# The queue of each course, one node taken off a round: edges into each node that are left, and the nodes a step frees, by their last edge.
add("g03_topo_order", lambda t, s, sf: graph.places(t["graphs"]).select("course_id", "node", F.col("place").cast("bigint").alias("place"), "depth").filter("place IS NOT NULL"), """
  SELECT course_id, 's' || (node - 1) AS node, place, depth FROM (SELECT course_id, unnest(q) AS node, generate_subscripts(q, 1) - 1 AS place, unnest(ds) AS depth
    FROM (SELECT * FROM kahn QUALIFY row_number() OVER (PARTITION BY d ORDER BY p DESC) = 1))""")
rule("g08_lesson_deps_in_manifests", lambda t: graph.forward_lesson_deps(t["prereqs"], t["lessons"]),
     flag_sql("dag", "forward_lesson_dep", H, "lesson_id", "pre", "FROM pre JOIN (SELECT d AS pd, id AS pid, max(pkey) AS pk FROM pos GROUP BY ALL) ON pd = d AND pid = pre WHERE kind = 'lesson' AND pk >= pkey"))
rule("g09_untaught_in_manifests", lambda t: graph.untaught_skills(t["prereqs"], t["first_taught"]),
     flag_sql("dag", "untaught_skill", H, "lesson_id", "pre", "FROM pre LEFT JOIN first ON first.d = pre.d AND skill = pre WHERE kind = 'skill' AND seen_at IS NULL"))
rule("g10_late_skills_in_manifests", lambda t: graph.late_skills(t["prereqs"], t["first_taught"]),
     flag_sql("dag", "late_skill", H, "lesson_id", "pre", "FROM pre JOIN first ON first.d = pre.d AND skill = pre WHERE kind = 'skill' AND seen_at > mod_idx"))
rule("g11_unresolved_in_manifests", lambda t: graph.unresolved_prereqs(t["prereqs"]),
     flag_sql("dag", "unresolved_prereq", H, "lesson_id", "pre", "FROM pre WHERE kind = 'unknown'"))
rule("q08_skew_in_manifests", lambda t: quiz.slot_skew(t["questions"]),
     flag_sql("briefs", "slot_skew", H, "'slot ' || slot", "n || '/' || total", """FROM (SELECT course_id, slot, count(*) AS n, sum(count(*)) OVER (PARTITION BY course_id) AS total
        FROM ans GROUP BY course_id, slot) WHERE total >= 6 AND n * 2 > total"""))
rule("q09_tell_in_manifests", lambda t: quiz.longest_tell(t["questions"]),
     flag_sql("briefs", "longest_tell", A, "course_id", "k || '/' || total", """FROM (SELECT course_id, count(*) AS total, count(*) FILTER (len(lens) >= 2 AND lens[slot] = list_max(lens)
        AND len(list_filter(lens, lambda v: v = list_max(lens))) = 1) AS k FROM ans GROUP BY course_id) WHERE total >= 6 AND k * 10 > total * 7"""))

# ---- the whole gate --------------------------------------------------------------------------------


def default_phrases(spark, sf):
    return spark.createDataFrame([(p,) for p in vocab.DEFAULT_BLOCKLIST], "phrase string")


def with_files(t, spark, sf):
    return {**t, "challenge_files": challenge_files(spark, sf), "test_files": test_files(spark, sf)}


def all_flags(t, spark, sf):
    """The full run, staged once: reports read flags, not rules."""
    return staged(spark, sf, "flags", lambda: run_checks(with_files(t, spark, sf), default_phrases(spark, sf)))


FLAGS = union_sql(*[part for parts in RULES.values() for part in parts])
add("m01_run_checks", lambda t, s, sf: run_checks(with_files(t, s, sf), default_phrases(s, sf)), FLAGS)
add("m02_gate", lambda t, s, sf: gate(all_flags(t, s, sf), t["courses"]),
    f"""SELECT src.course_id, coalesce(hard, 0) AS hard, coalesce(advisory, 0) AS advisory, CASE WHEN hard > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM src
      LEFT JOIN (SELECT course_id, count(*) FILTER (severity = 'HARD') AS hard, count(*) FILTER (severity = 'advisory') AS advisory FROM ({FLAGS}) GROUP BY course_id) f
      ON f.course_id = src.course_id""")
add("m02_check_verdicts", lambda t, s, sf: check_verdicts(all_flags(t, s, sf)),
    f"SELECT course_id, check_name, max(CASE WHEN severity = 'HARD' THEN 'FAIL' ELSE 'ADVISORY' END) AS verdict, count(*) AS flags FROM ({FLAGS}) GROUP BY course_id, check_name")
add("m03_suite_report", lambda t, s, sf: suite_report(all_flags(t, s, sf)),
    f"""SELECT coalesce(check_name, 'all') AS check_name, coalesce(rule, 'all') AS rule, CAST(sum(n) AS BIGINT) AS flags, count(*) AS rule_courses
      FROM (SELECT check_name, rule, course_id, count(*) AS n FROM ({FLAGS}) GROUP BY ALL) GROUP BY ROLLUP (check_name, rule)""")
add("m03_severity_matrix", lambda t, s, sf: severity_matrix(all_flags(t, s, sf)),
    f"""SELECT check_name, count(*) FILTER (severity = 'HARD') AS "HARD", count(*) FILTER (severity = 'advisory') AS advisory FROM ({FLAGS}) GROUP BY check_name""")
