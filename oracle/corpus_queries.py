"""Queries over sources, sinks, text sweeps and corpus profiles."""
from pyspark.sql import SparkSession, functions as F

from lectern import schemas, vocab
from lectern.operators import challenges, code, corpus, documents, drafts, flatten, publish, state, visuals
from lectern.session import fresh_path
from lectern.sources import files, sinks
from lectern.sources.manifests import parse_manifests
from oracle import draft_data as dd, draft_queries as dq, manifest_data as md, manifest_queries as mq, star_queries as sq
from oracle.draft_queries import longs, phrases, phrases_sql
from oracle.shared import flag_sql, union_sql, with_ctes

H = "'HARD'"
Q: dict = {}
SQL: dict = {}


def add(name, fn, sql=None, ctes=dd.CTES):
    Q[name] = fn
    if sql:
        SQL[name] = with_ctes(ctes, sql)


def table(spark: SparkSession, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- sources -----------------------------------------------------------------------------------------


def draft_files(spark, sf):
    t = dd.drafts(spark, sf)
    folder = F.concat(F.lit("/catalog/"), "course_id", F.lit("/lessons/drafts/"))
    covers = t.filter("d % 10 = 0").select(F.concat(folder, F.lit("000-cover.md")).alias("path"), F.lit("# Cover").alias("value"))
    return t.select(F.concat(folder, "stem", F.lit(".md")).alias("path"), F.col("md").alias("value")).unionByName(covers)


add("s02_lesson_drafts", lambda s, sf: files.parse_drafts(draft_files(s, sf)).select("course_id", "stem", F.md5("md").alias("md5")),
    "SELECT course_id, stem, md5(md) AS md5 FROM dr")


def phrase_lines(spark, sf):
    rows = table(spark, sf, "benchmark").select("item_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "x"))
    return rows.select(F.expr("CASE WHEN (item_id + i) % 4 = 0 THEN '# ' || x WHEN (item_id + i) % 4 = 1 THEN '  ' || x || '  ' ELSE x END").alias("value"))


add("s03_blocklist_file", lambda s, sf: files.parse_blocklist(phrase_lines(s, sf)),
    f"""SELECT DISTINCT lower({dd.strip_sql('x')}) AS phrase FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM benchmark)
      WHERE (item_id + i) % 4 <> 0 AND {dd.strip_sql('x')} <> ''""")


def challenge_listing(spark, sf):
    return sq.lessons(spark, sf).select(F.expr("""CASE WHEN okey % 3 = 0 THEN '/catalog/k' || course_id || '/notes/' || okey
      ELSE '/catalog/k' || course_id || '/challenges/c' || okey || '/tests.json' END""").alias("path"), F.lit(10).alias("length"))


add("s04_challenge_files", lambda s, sf: files.parse_paths(challenge_listing(s, sf), r"([^/]+)/(challenges/.+)\z"),
    "SELECT 'k' || o_custkey AS course_id, 'challenges/c' || o_orderkey || '/tests.json' AS path FROM orders WHERE o_orderkey % 3 <> 0")
add("s04_test_cases", lambda s, sf: files.test_cases(mq.test_files(s, sf)),
    """SELECT course_id, 'challenges/l' || i || '/tests.json' AS path, 'a' AS case_id, CASE WHEN (d + i) % 5 = 0 THEN '1' END AS input,
       CASE WHEN (d + i) % 5 = 0 THEN '2' END AS expected FROM ln WHERE (d + i) % 5 IN (0, 3)""", md.CTES)


def compiler_lines(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    ts = F.expr("""CASE WHEN l_returnflag = 'N' THEN 'Found 3 errors.' ELSE '  src/b' || lpad(CAST(l_orderkey % 10000 AS STRING), 4, '0') || CASE WHEN l_suppkey % 2 = 0 THEN '.ts(' ELSE '.tsx(' END
      || l_linenumber || ',7): error TS' || (2300 + l_partkey % 10) || ': msg ' || l_suppkey END""")
    cargo = F.to_json(F.expr("""named_struct('reason', CASE WHEN l_returnflag = 'N' THEN 'build-finished' ELSE 'compiler-message' END, 'message', named_struct(
      'level', CASE WHEN l_returnflag = 'R' THEN 'warning' ELSE 'error' END, 'message', CASE WHEN l_linenumber % 5 = 0 THEN 'aborting due to 2 previous errors' ELSE 'mismatched ' || l_partkey END,
      'code', CASE WHEN l_partkey % 3 <> 0 THEN named_struct('code', 'E0308') END,
      'spans', array(named_struct('is_primary', false, 'label', 'no'), named_struct('is_primary', l_suppkey % 2 = 0, 'label', CASE WHEN l_suppkey % 4 <> 0 THEN 'lab' || l_suppkey END))))"""))
    return li, ts, cargo


def ts_diagnostics(spark, sf):
    li, ts, _ = compiler_lines(spark, sf)
    return longs(files.parse_diagnostics(li.select("l_orderkey", ts.alias("value")), "ts"), "block")


def cargo_diagnostics(spark, sf):
    li, _, cargo = compiler_lines(spark, sf)
    return files.parse_diagnostics(li.select("l_orderkey", cargo.alias("value")), "cargo")


add("s06_typescript_log", ts_diagnostics, """SELECT l_orderkey, l_orderkey % 10000 AS block, 'error TS' || (2300 + l_partkey % 10) || ': msg ' || l_suppkey AS msg FROM lineitem WHERE l_returnflag <> 'N'""")
add("s06_cargo_log", cargo_diagnostics, """SELECT l_orderkey, CASE WHEN l_partkey % 3 <> 0 THEN 'error[E0308]: ' ELSE 'error: ' END || 'mismatched ' || l_partkey ||
  CASE WHEN l_suppkey % 4 = 2 THEN ' — lab' || l_suppkey ELSE '' END AS msg FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber % 5 <> 0""")


def catalog_texts(spark, sf):
    """Each page stands for one catalog of two entries: a numbered list or a pipe table."""
    p = table(spark, sf, "pages").select("page_id", "url")
    first, rest = F.split_part("url", F.lit("?"), F.lit(1)), F.lit("https://example.org/p")
    other = F.concat(rest, (F.col("page_id") % 40).cast("string"))
    year = (2015 + F.col("page_id") % 9).cast("string")
    as_list = F.concat(F.lit("# Catalog\n\nSome words.\n\n1. **Title "), "page_id", F.lit("** — Org A —\n   "), first, F.lit(" — ("), year,
                       F.lit(") —\n   A note about it.\n   More of it.\n\n2. **Second** — Org B — "), other, F.lit(" — (2020) — Short note.\n"))
    as_table = F.concat(F.lit("# Catalog\n\n| # | Title | Author | URL | Year | Why |\n|---|---|---|---|---|---|\n| 1 | Title "), "page_id", F.lit(" | Org A | "), first,
                        F.lit(" | "), year, F.lit(" | A note about it. More of it. |\n| 2 | Second | Org B | "), other, F.lit(" | none | Short note. |\n"))
    return p.select(F.expr("'form' || page_id % 5").alias("form"), F.when(F.col("page_id") % 2 == 0, as_list).otherwise(as_table).alias("md"))


def catalog(spark, sf):
    return files.parse_catalog(catalog_texts(spark, sf))


CATALOG = """SELECT 'form' || page_id % 5 AS form, 1 AS n, 'Title ' || page_id AS title, 'Org A' AS author, split_part(url, '?', 1) AS url, 2015 + page_id % 9 AS year, 'A note about it. More of it.' AS note FROM pages
  UNION ALL SELECT 'form' || page_id % 5, 2, 'Second', 'Org B', 'https://example.org/p' || page_id % 40, CASE WHEN page_id % 2 = 0 THEN 2020 END, 'Short note.' FROM pages"""
add("s07_exemplar_catalogs", catalog, CATALOG)
add("d22_duplicate_urls", lambda s, sf: corpus.catalog_duplicates(catalog(s, sf)),
    f"SELECT url, count(*) AS n, count(DISTINCT form) AS forms FROM ({CATALOG}) GROUP BY url HAVING count(*) > 1")
add("d22_catalog_cube", lambda s, sf: corpus.catalog_cube(catalog(s, sf)),
    f"""SELECT CASE WHEN grouping(form) = 1 THEN 'all' ELSE form END AS form, CASE WHEN grouping(year) = 1 THEN 'all' ELSE coalesce(CAST(year AS VARCHAR), 'unknown') END AS year, count(*) AS n
      FROM ({CATALOG}) GROUP BY CUBE (form, year)""")

# ---- challenge sources -----------------------------------------------------------------------------------


def sources(spark, sf):
    blocks = code.extract_blocks(dd.drafts(spark, sf)).filter("lang in ('typescript', 'rust')")
    return blocks.select("course_id", F.concat_ws("#", "stem", "n_all").alias("source"), "lang", "code")


dd.CTES["so"] = "SELECT course_id, stem || '#' || n_all AS source, lang, code FROM bl WHERE lang IN ('typescript', 'rust')"
dd.CTES["sol"] = """SELECT course_id, source, ltrim(line, ' ' || chr(9)) AS s, p FROM (SELECT course_id, source, unnest(string_split(code, chr(10))) AS line, generate_subscripts(string_split(code, chr(10)), 1) AS p
  FROM so WHERE lang = 'typescript')"""
dd.CTES["gol"] = """SELECT course_id, source, split_part(line, '//', 1) AS s, p FROM (SELECT course_id, source, unnest(string_split(c, chr(10))) AS line, generate_subscripts(string_split(c, chr(10)), 1) AS p
  FROM (SELECT course_id, source, regexp_replace(code, '(?s)/\\*.*?\\*/', '', 'g') AS c FROM so WHERE lang = 'typescript'))"""
_mod = "regexp_extract(s, '^import\\s*(?:\\{[^}]+\\}|\\w+)\\s*from\\s*[''\"]([^''\"]+)[''\"]', 1)"
_glob = f"regexp_extract(s, '\\b({'|'.join(vocab.MISSING_GLOBALS)})\\b', 1)"
add("c05_sandbox_lint", lambda s, sf: challenges.sandbox_lint(sources(s, sf).filter("lang = 'typescript'")),
    f"""SELECT course_id, source, 'module' AS kind, min(p) AS line, arg_min(name, p) AS name FROM (SELECT *, CASE WHEN starts_with(s, 'export ') AND NOT regexp_matches(s, '^export\\s+(interface|type)\\b') THEN 'export'
        WHEN starts_with(s, 'import') AND {_mod} <> '{vocab.SANDBOX_MODULE}' THEN {_mod} END AS name FROM sol) WHERE name IS NOT NULL GROUP BY course_id, source
      UNION ALL SELECT course_id, source, 'global', min(p), arg_min(name, p) FROM (SELECT *, {_glob} AS name FROM gol) WHERE name <> '' GROUP BY course_id, source""")
add("c07_entry_function", lambda s, sf: challenges.entry_function(sources(s, sf)),
    """SELECT course_id, source, CASE WHEN lang = 'typescript' THEN coalesce(nullif(regexp_extract(code, '(?:function\\s+(\\w+)\\s*\\(|(?:const|let|var)\\s+(\\w+)\\s*=\\s*(?:async\\s*)?\\()', 1), ''),
         nullif(regexp_extract(code, '(?:function\\s+(\\w+)\\s*\\(|(?:const|let|var)\\s+(\\w+)\\s*=\\s*(?:async\\s*)?\\()', 2), ''))
       ELSE coalesce(CASE WHEN code LIKE '%fn run_all()%' THEN 'run_all' WHEN code LIKE '%fn check(&self)%' THEN 'check' END, 'solution') END AS entry FROM so""")


def test_inputs(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.expr("'k' || l_suppkey").alias("course_id"), F.col("l_orderkey").alias("challenge"), F.col("l_linenumber").alias("case_id"),
        F.expr("""CASE l_partkey % 7 WHEN 0 THEN '1, 2n' WHEN 1 THEN '"a", true' WHEN 2 THEN '{ owner: 1 }' WHEN 3 THEN 'payer, foo bar , x' WHEN 4 THEN '-.5,x$' WHEN 5 THEN NULL ELSE '-1n, [2' END""").alias("input"))


add("c06_uncallable_inputs", lambda s, sf: challenges.uncallable_inputs(test_inputs(s, sf)),
    """SELECT 'k' || l_suppkey AS course_id, l_orderkey AS challenge, l_linenumber AS case_id, CASE l_partkey % 7 WHEN 2 THEN '{ owner: 1 }' WHEN 3 THEN 'foo bar' ELSE '-1n' END AS fragment
       FROM lineitem WHERE l_partkey % 7 IN (2, 3, 6)""")

# ---- facts, sweeps, profiles --------------------------------------------------------------------------------


def facts(spark, sf):
    """Every line of a document is a fact, and two more."""
    docs = table(spark, sf, "documents").withColumnRenamed("doc_id", "d").withColumnRenamed("source", "course_id")
    return docs.select("course_id", F.expr(dd.STEM).alias("stem"), F.posexplode(F.concat(
        F.split("text", "\n", -1), F.array(F.expr("'fixed fact ' || d % 3"), F.expr("'# Doc ' || d")))).alias("pos", "fact"))


FACTS = f"""SELECT d, course_id, stem, unnest(range(len(fs))) AS pos, unnest(fs) AS fact FROM (SELECT d, course_id, {dd.STEM} AS stem,
  list_concat(string_split(text, chr(10)), ['fixed fact ' || d % 3, '# Doc ' || d]) AS fs FROM (SELECT doc_id AS d, source AS course_id, text FROM documents))"""
add("t06_facts_present", lambda s, sf: state.facts_present(facts(s, sf), dd.drafts(s, sf).select("course_id", "stem", "md")),
    flag_sql("drafts", "fact_absent", H, "stem", "pos", f"FROM (SELECT f.course_id, f.stem, pos FROM ({FACTS}) f JOIN dr USING (d) WHERE NOT contains(md, fact))"))


def fields(spark, sf):
    t = md.tables(spark, sf)
    return flatten.text_fields(t["lessons"], t["courses"], dd.drafts(spark, sf), t["manifests"])


_brief = [("title", "title"), ("hook", "hook"), ("concept_spec", "concept_spec"), ("artifact_spec", "artifact_spec"), ("exercise_spec", "exercise_spec"), ("the_tradeoff", "the_tradeoff")]
ALL = {**md.CTES, **dd.CTES, "pos": md.CTES["pos"]}
ALL["tf"] = f"SELECT * FROM (" + union_sql(
    *[f"SELECT course_id, '{f}' AS field, id AS subject, {c} AS text FROM les" for f, c in _brief],
    "SELECT course_id, 'quiz_prompt', lesson_id, prompt FROM qs", "SELECT course_id, 'quiz_explanation', lesson_id, explanation FROM qs",
    "SELECT course_id, 'quiz_label', lesson_id, unnest(labels) FROM qs", "SELECT course_id, 'quiz_feedback', lesson_id, unnest(feeds) FROM qs",
    "SELECT course_id, 'objective', id, unnest([objective_1, objective_2]) FROM les WHERE objectives = 'two'",
    "SELECT course_id, 'course_title', course_id, 'Doc ' || d FROM src", "SELECT course_id, 'course_promise', course_id, lines[1] FROM src",
    "SELECT course_id, 'module_title', id, title FROM mods",
    "SELECT course_id, 'draft', stem, md FROM dr") + f") WHERE NOT {mq.blank('text')}"
add("d20_dash_coverage", lambda s, sf: drafts.dash_coverage(fields(s, sf)),
    """SELECT field, count(*) AS texts, CAST(sum(CASE WHEN field = 'draft' THEN 0 ELSE len(regexp_extract_all(text, '—|–| -- ')) END) AS BIGINT) + CASE WHEN field = 'draft' THEN (SELECT CAST(sum(dashes) AS BIGINT) FROM dc) ELSE 0 END AS dashes
       FROM tf GROUP BY field""", ALL)
add("d21_phrase_sweep", lambda s, sf: corpus.phrase_sweep(fields(s, sf), phrases(s, sf)),
    f"SELECT course_id, field, subject, phrase FROM tf, {phrases_sql()} WHERE contains(lower(text), phrase)", ALL)


def pieces(spark, sf):
    return corpus.pieces(dd.drafts(spark, sf).withColumn("form", F.element_at(F.array(*[F.lit(b[0]) for b in vocab.LENGTH_BANDS]), (F.col("d") % 5 + 1).cast("int"))), "form")


_form = "CASE d % 5 " + " ".join(f"WHEN {i} THEN '{b[0]}'" for i, b in enumerate(vocab.LENGTH_BANDS)) + " END"
dd.CTES["pcs"] = f"""SELECT dr.d, dr.course_id, dr.stem, {_form.replace('d %', 'dr.d %')} AS form, CAST(coalesce(sum({dd.words_sql('line')}) FILTER (NOT inside), 0) AS BIGINT) AS words,
  count(*) FILTER (inside AND trim(line) <> '') AS code_lines, count(*) FILTER (NOT inside AND trim(line) <> '') AS prose_lines FROM dr LEFT JOIN dx USING (d) GROUP BY dr.d, dr.course_id, dr.stem"""
add("d23_corpus_profile", lambda s, sf: corpus.corpus_profile(pieces(s, sf)),
    """SELECT form, count(*) AS pieces, CAST(sum(words) AS BIGINT) AS total_words, round(avg(words), 2) AS mean_words, median(words) AS median_words, min(words) AS min_words, max(words) AS max_words,
       CAST(sum(code_lines) AS BIGINT) AS code_lines, CAST(sum(prose_lines) AS BIGINT) AS prose_lines FROM pcs GROUP BY form""")
BANDS = "(VALUES " + ", ".join(f"('{f}', {lo}, {hi})" for f, lo, hi in vocab.LENGTH_BANDS) + ") b(form, lo, hi)"
add("d24_length_band", lambda s, sf: corpus.length_band(pieces(s, sf), corpus.bands_table(s)),
    f"SELECT course_id, stem, form, words, CASE WHEN words < lo THEN 'short' ELSE 'long' END AS verdict FROM pcs JOIN {BANDS} USING (form) WHERE words NOT BETWEEN lo AND hi")
add("d24_fitting_forms", lambda s, sf: corpus.fitting_forms(pieces(s, sf), corpus.bands_table(s)),
    f"SELECT course_id, stem, words, b.form FROM pcs JOIN {BANDS} ON words BETWEEN lo AND hi")
ASK = """CASE (conv_id + turn) % 12 WHEN 0 THEN 'Write a Thread about ' || w WHEN 1 THEN 'a blog post about ' || w WHEN 2 THEN 'how ' || w || ' works' WHEN 3 THEN 'How do I build ' || w WHEN 4 THEN 'why ' || w || ' should win'
  WHEN 5 THEN 'slides for my talk on ' || w WHEN 6 THEN 'snippet for ' || w WHEN 7 THEN 'a 4-week bootcamp on ' || w WHEN 8 THEN 'whitepaper of ' || w WHEN 9 THEN 'annotated README of ' || w WHEN 10 THEN 'post about ' || w ELSE text END"""


def asks(spark, sf):
    c = table(spark, sf, "conversations").withColumn("w", F.split_part("text", F.lit(" "), F.lit(1)))
    return corpus.route_form(c.select("conv_id", "turn", F.expr(ASK).alias("ask"))).select("conv_id", "turn", "form")


_route = " ".join(f"WHEN regexp_matches(lower(ask), '{p}') THEN '{f}'" for f, p in vocab.FORM_KEYWORDS)
add("d25_route_form", asks, f"SELECT conv_id, turn, CASE {_route} END AS form FROM (SELECT conv_id, turn, {ASK} AS ask FROM (SELECT *, split_part(text, ' ', 1) AS w FROM conversations))")

# ---- sinks: written to the shared folder and read back -------------------------------------------------------


PLANTED = '"x_unknown":{"z":[2.5,{"k":"é"}],"a":12345678901234567890}'


def course_tree(spark, sf):
    """Unknown keys are planted in courses, modules and briefs, and lesson lists in modules; every document is written, read back and looked into."""
    path, value = fresh_path(spark, "course-tree"), F.col("value")
    for at in ('"course":{', '"brief":{'):
        value = F.replace(value, F.lit(at), F.lit(f"{at}{PLANTED},"))
    value = F.replace(value, F.lit('{"id":"mod-'), F.lit('{"lessons":["l0","ghost","l1"],' + PLANTED + ',"id":"mod-'))
    sinks.write_course_tree(parse_manifests(md.texts(spark, sf).withColumn("value", value))[0], path)
    at = {"manifest": "$.course.title", "module": "$.module.lesson_files", "brief": "$.lesson.title", "research": "$.research.status", "assessment": "$.proof_matrix[1].outcome"}
    doc, kind = F.col("doc"), F.col("kind")
    inside = F.when(kind == "course", F.concat(F.get_json_object(doc, "$.modules"), F.get_json_object(doc, "$.lessons"))).when(kind == "facts", doc)
    for name, where in at.items():
        inside = inside.when(kind == name, F.get_json_object(doc, where))
    return sinks.read_course_tree(spark, path).select("course_id", "kind", "subject", "path", inside.alias("inside"), F.contains(doc, F.lit(PLANTED)).alias("unknown_kept"))


_LAST = f"(SELECT *, {mq.stem_sql()} AS st FROM pos QUALIFY row_number() OVER (PARTITION BY d, id ORDER BY pos DESC) = 1)"
add("k01_course_tree", course_tree, union_sql(
    """SELECT src.course_id, 'course' AS kind, src.course_id AS subject, 'course.yaml' AS path, CAST(to_json(mo) AS VARCHAR) || CAST(to_json(lo) AS VARCHAR) AS inside, true AS unknown_kept
       FROM src JOIN (SELECT d AS md, list(id ORDER BY m) AS mo FROM mods GROUP BY d) ON md = d JOIN (SELECT d AS ld, list(id ORDER BY pos) AS lo FROM pos GROUP BY d) ON ld = d""",
    "SELECT course_id, 'manifest', course_id, 'manifest.json', 'Doc ' || d, true FROM src",
    "SELECT course_id, 'cadence', course_id, 'cadence.yaml', NULL, false FROM src",
    "SELECT course_id, 'assessment', course_id, 'assessment.yaml', 'to-' || d % 5, false FROM src",
    f"""SELECT course_id, 'module', id, printf('modules/%02d-', CAST(m AS INT)) || {mq.slug_sql('id')} || '/module.yaml', CASE WHEN id LIKE 'mod-%' THEN '{{' || coalesce(fl, '') || '}}' ELSE '{{}}' END, id LIKE 'mod-%'
       FROM mods LEFT JOIN (SELECT d AS fd, string_agg('"' || id || '":"../../lessons/briefs/' || st || '.brief.yaml"', ',' ORDER BY id) AS fl
         FROM {_LAST} WHERE id IN ('l0', 'l1') GROUP BY d) ON fd = d WHERE m = mod_idx""",
    f"SELECT course_id, 'brief', id, 'lessons/briefs/' || st || '.brief.yaml', title, true FROM {_LAST}",
    f"SELECT course_id, 'research', id, 'lessons/research/' || st || '.research.yaml', research, false FROM {_LAST} WHERE research IS NOT NULL",
    f"SELECT course_id, 'facts', id, 'lessons/facts/' || st || '.facts.md', fact_1 || chr(10) || fact_2 || chr(10), false FROM {_LAST} WHERE research IS NOT NULL"), md.CTES)


def challenge_files(spark, sf):
    """Two of three challenge files are there."""
    return (md.tables(spark, sf)["challenges"].select("course_id", F.explode(F.array("starter", "solution", "tests")).alias("path"))
            .filter("pmod(length(path) + length(course_id), 3) > 0"))


def publish_tree(spark, sf):
    """Lesson documents as written and read back, one row per block with all it holds."""
    path, t, md_rows = fresh_path(spark, "publish-tree"), md.tables(spark, sf), dd.drafts(spark, sf)
    meta = publish.publish_meta(t["courses"])
    sinks.write_publish_tree(documents.course_publish_documents(t["manifests"], meta, t["lessons"]), documents.lesson_documents(t["published_lessons"]),
                             documents.challenge_copies(t["lessons"], challenge_files(spark, sf)), drafts.project_prose(md_rows, visuals.asset_choice(dq.assets(md_rows)))[0], path)
    back = sinks.read_lesson_documents(spark, path).select("course_id", "lesson_id", "lesson_pos", "path", "doc", F.posexplode("doc.blocks").alias("pos", "b"))
    asked = F.from_json("b.questions", "ARRAY<STRUCT<id: STRING, prompt: STRING, multiSelect: BOOLEAN, options: ARRAY<STRUCT<id: STRING, label: STRING, correct: BOOLEAN>>>>")
    shown = F.array_join(F.transform(asked, lambda q: F.concat_ws("|", q["id"], q["prompt"], q["multiSelect"].cast("string"), F.array_join(F.transform(
        q["options"], lambda o: F.concat_ws(":", o["id"], o["label"], o["correct"].cast("string"))), "/"))), "\n")
    return back.select("course_id", "lesson_id", F.col("lesson_pos").cast("bigint").alias("lesson_pos"), "path", F.col("doc.id").alias("id"), F.col("doc.title").alias("title"),
                       F.array_join("doc.skills", ",").alias("skills"), F.col("pos").cast("bigint").alias("pos"), "b.key", "b.type", "b.src", "b.language", "b.buildType",
                       "b.starter", "b.solution", "b.tests", shown.alias("questions"))


def _prefix(t: str) -> str:
    return f"CASE WHEN {t}.d % 4 = 0 THEN 'p' || {t}.d WHEN {t}.d % 41 = 0 THEN 'C' ELSE 'c' || substr(CAST({t}.d AS VARCHAR), 1, 1) END"


_ASKED = """CASE WHEN quiz <> 'two' THEN '' ELSE concat_ws('|', q1_id, q1_prompt, 'false', concat_ws('/', concat_ws(':', 'a', label_1, CAST(q1_slot = 0 AS VARCHAR)),
    concat_ws(':', 'b', label_2, CAST(q1_slot = 1 AS VARCHAR)), concat_ws(':', 'c', label_3, CAST(q1_slot = 2 AS VARCHAR)))) || chr(10) ||
    concat_ws('|', q2_id, 'why?', CAST(q2_multi AS VARCHAR), concat_ws('/', concat_ws(':', 'a', label_1, CAST(q2_a AS VARCHAR)), concat_ws(':', q2_oid, label_3, CAST(q2_b AS VARCHAR)))) END"""
_EXT = "CASE lang WHEN 'typescript' THEN '.ts' ELSE '.rs' END"
_QUIZ_KEY = mq.slug_sql("coalesce(quiz_key, 'check')")
_LESSON_BLOCKS = union_sql(
    """SELECT d, i, 0 AS r, 0 AS p, 'intro' AS key, 'prose' AS type, 'intro.md' AS src, NULL AS language, NULL AS buildType, NULL AS starter, NULL AS solution,
       NULL AS tests, NULL AS questions FROM les""",
    f"""SELECT d, i, 1, pos, k, 'code', NULL, lang, build, k || '/starter' || {_EXT}, k || '/solution' || {_EXT}, k || '/tests.json', NULL
        FROM (SELECT *, {mq.slug_sql('cid')} AS k FROM ch) WHERE lang <> 'go'""",
    f"SELECT d, i, 2, 0, {_QUIZ_KEY}, 'quiz', NULL, NULL, NULL, NULL, NULL, NULL, {_ASKED} FROM les WHERE quiz IN ('two', 'empty')")
_SKILLS = mq.SKILLS_SQL.replace("SELECT course_id, lesson_id,", "SELECT course_id, i,", 1).replace("les.id AS lesson_id", "les.i")
add("k02_publish_tree", publish_tree, f"""SELECT pos.course_id, pos.id AS lesson_id, pos.pos AS lesson_pos, 'lessons/' || {mq.slug_sql('pos.id')} || '/lesson.yaml' AS path,
    'lesson-' || {_prefix('pos')} || '-' || {mq.slug_sql('pos.id')} AS id, pos.title, k.skills,
    row_number() OVER (PARTITION BY pos.d, pos.i ORDER BY r, p) - 1 AS pos, key, type, src, language, buildType, b.starter, b.solution, b.tests, questions
  FROM pos JOIN ({_LESSON_BLOCKS}) b ON b.d = pos.d AND b.i = pos.i JOIN ({_SKILLS}) k ON k.course_id = pos.course_id AND k.i = pos.i""", md.CTES)
add("u04_challenge_copies", lambda s, sf: documents.challenge_copies(md.tables(s, sf)["lessons"], challenge_files(s, sf)), f"""
  SELECT course_id, lesson_id, key, role, src, 'lessons/' || {mq.slug_sql('lesson_id')} || '/' || key || '/' || CASE role WHEN 'tests' THEN 'tests.json' ELSE role || {_EXT} END AS dest,
    CASE WHEN src = '' OR (length(src) + length(course_id)) % 3 = 0 THEN CASE role WHEN 'tests' THEN '[]' || chr(10) ELSE '' END END AS content
  FROM (SELECT course_id, lesson_id, {mq.slug_sql('cid')} AS key, lang, unnest(['starter', 'solution', 'tests']) AS role,
          unnest([coalesce(starter, ''), coalesce(solution, ''), coalesce(tests, '')]) AS src FROM ch WHERE lang <> 'go')""", md.CTES)


def course_docs(s, sf):
    docs = documents.course_publish_documents(md.manifests(s, sf), publish.publish_meta(md.tables(s, sf)["courses"]))
    back = docs.select("course_id", F.from_json("text", "id STRING, modules ARRAY<STRUCT<key: STRING, title: STRING, lessons: ARRAY<STRING>>>").alias("d"))
    return (back.select("course_id", "d.id", F.posexplode("d.modules").alias("pos", "m"))
            .select("course_id", "id", F.col("pos").cast("bigint").alias("pos"), "m.key", "m.title", F.array_join("m.lessons", ",").alias("lessons")))


_MODULE_KEY = mq.slug_sql("replace(mods.id, 'module-', '')")
add("u04_course_documents", course_docs, f"""SELECT mods.course_id, regexp_replace(substr('course-' || {mq.slug_sql('mods.course_id')}, 1, 32), '-+$', '') AS id, m AS pos, {_MODULE_KEY} AS key,
    coalesce(mods.title, mods.id) AS title, coalesce(string_agg('lesson-' || {_prefix('mods')} || '-' || {mq.slug_sql('pos.id')}, ',' ORDER BY pos.pos) FILTER (pos.id IS NOT NULL), '') AS lessons
  FROM mods LEFT JOIN pos ON pos.d = mods.d AND pos.module = mods.id GROUP BY mods.course_id, mods.d, m, mods.id, mods.title""", md.CTES)


def written_flags(spark, sf):
    t = md.tables(spark, sf)
    return sinks.write_flags(mq.all_flags(t, spark, sf), t["courses"], fresh_path(spark, "gate"))


Q["k03_flags_and_verdict"] = written_flags
SQL["k03_flags_and_verdict"] = mq.SQL["m02_gate"]


def quiz_split(spark, sf):
    path, t = fresh_path(spark, "quizzes"), md.tables(spark, sf)
    quiz = t["lessons"].select("course_id", "lesson_id", F.col("brief.quiz_blocks").alias("quiz_blocks"), "mod_idx", "ord")
    named = flatten.stems(t["lessons"].select("*")).select("course_id", "lesson_id", F.col("quiz_stem").alias("stem")).distinct()
    sinks.write_quiz_split(quiz.join(named, ["course_id", "lesson_id"]).select("course_id", "stem", "lesson_id", "quiz_blocks"), path)
    back = sinks.read_quiz_split(spark, path, schemas.QUIZ_BLOCKS)
    return back.select("course_id", "stem", "lesson_id", F.size(F.get("quiz_blocks", F.lit(0))["questions"]).cast("bigint").alias("questions"))


add("k04_quiz_split", quiz_split, f"""SELECT a.course_id, b.stem, a.id AS lesson_id, CASE WHEN quiz = 'two' THEN 2 ELSE 0 END AS questions FROM pos a JOIN
  (SELECT DISTINCT course_id, id, {mq.stem_sql('id')} AS stem FROM pos) b ON b.course_id = a.course_id AND b.id = a.id WHERE quiz IN ('two', 'empty')""", md.CTES)


def facts_file(spark, sf):
    path = fresh_path(spark, "facts")
    sinks.write_facts(facts(spark, sf), path)
    return longs(sinks.read_facts(spark, path), "pos")


add("k05_facts_file", facts_file, f"SELECT course_id, stem, CAST(pos AS BIGINT) AS pos, fact FROM ({FACTS})")
