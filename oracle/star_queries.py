"""Queries over a catalog derived from the star schema: a customer is a course, an order a lesson.

Here one course may hold any share of the rows, unlike in manifests, where a course is one document.
"""
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lectern.operators import challenges, course, flatten, graph, publish, quiz, state
from lectern.operators.order import number_within
from lectern.session import fresh_path
from lectern.sources import tree_store
from oracle.shared import flag_sql, union_sql, with_ctes

H, A = "'HARD'", "'advisory'"
Q: dict = {}
SQL: dict = {}

CTES = {
    "o": """SELECT o_orderkey AS okey, o_custkey AS course_id, 'l' || o_orderkey AS lesson_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS mod_idx,
              date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS ord, o_orderkey AS array_pos, o_orderstatus AS status,
              CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders""",
    "pos": "SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY mod_idx, ord, okey) - 1 AS lesson_pos FROM o",
    "mods": """SELECT course_id, mod_idx, 'mod-' || mod_idx AS module_id, CASE WHEN count(*) % 7 = 0 THEN NULL ELSE CAST(sum(cents) // (count(*) * 6000000) AS BIGINT) END AS rung,
              CASE WHEN count(*) % 5 = 0 THEN NULL ELSE CAST(max(cents) // 10000000 AS BIGINT) END AS band FROM o GROUP BY course_id, mod_idx""",
    "li": """SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS k FROM lineitem""",
    "l4": "SELECT li.*, o.* FROM li JOIN o ON okey = l_orderkey",
    "tea": "SELECT course_id, mod_idx, 's' || l_partkey % 12 AS skill FROM l4",
    "first": "SELECT course_id, skill, min(mod_idx) AS seen_at FROM tea GROUP BY ALL",
    "node": "SELECT course_id, 's' || s AS node FROM (SELECT DISTINCT course_id FROM o), range(12) r(s) WHERE (course_id + s) % 13 <> 0",
    "edge": """SELECT DISTINCT course_id, 's' || CASE WHEN okey % 100 = 0 THEN a ELSE least(a, b) END AS src, 's' || CASE WHEN okey % 100 = 0 THEN b ELSE greatest(a, b) END AS dst
              FROM (SELECT a.course_id, a.okey, a.l_partkey % 12 AS a, b.l_partkey % 12 AS b FROM l4 a JOIN l4 b ON a.l_orderkey = b.l_orderkey AND b.k = a.k + 1) WHERE a <> b""",
    "anchor": "SELECT course_id AS ac, mod_idx AS am, max(okey) AS akey FROM o GROUP BY ALL",
    "pre": """SELECT course_id, lesson_id, mod_idx, ord, okey, 's' || l_partkey % 14 AS pre, 2 * k AS pre_pos FROM l4
              UNION ALL SELECT course_id, lesson_id, mod_idx, ord, okey, 'l' || akey, 2 * k + 1 FROM l4 JOIN anchor ON ac = course_id AND am = l_partkey % 5""",
    "pk": """SELECT pre.*, CASE WHEN pre LIKE 'l%' THEN 'lesson' WHEN n.node IS NOT NULL THEN 'skill' ELSE 'unknown' END AS kind
             FROM pre LEFT JOIN node n ON n.course_id = pre.course_id AND n.node = pre.pre""",
    "de": """SELECT edge.* FROM edge JOIN node a ON a.course_id = edge.course_id AND a.node = src JOIN node b ON b.course_id = edge.course_id AND b.node = dst""",
    "walk": """SELECT course_id, dst AS node, 1 AS len FROM de UNION
               SELECT w.course_id, e.dst, w.len + 1 FROM walk w JOIN de e ON e.course_id = w.course_id AND e.src = w.node WHERE w.len < 12""",
    "opt": """SELECT course_id, lesson_id, okey, status = 'P' AS multi, k, 'o' || CASE WHEN okey % 40 = 0 THEN 1 ELSE k END AS oid, p_name AS label,
               l_returnflag = 'R' AS correct, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'no' END AS feedback FROM l4 JOIN part ON p_partkey = l_partkey""",
    "qs": """SELECT course_id, lesson_id, okey, multi, 'q' || okey AS q_id, CASE WHEN okey % 50 = 0 THEN '' ELSE 'why' END AS prompt,
               CASE WHEN okey % 30 = 0 THEN NULL ELSE 'so' END AS explanation, list(oid ORDER BY k) AS oids, list(label ORDER BY k) AS labels,
               list(correct ORDER BY k) AS rights, list(feedback ORDER BY k) AS feeds FROM opt GROUP BY ALL""",
    "ans": """SELECT *, list_position(rights, true) AS slot, list_transform(labels, lambda v: length(v)) AS lens FROM qs
              WHERE NOT multi AND len(list_filter(rights, lambda r: r)) = 1""",
    "rep": """SELECT *, lens[slot] = list_max(lens) AS is_longest, list_reverse_sort(lens)[1] - list_reverse_sort(lens)[2] AS gap FROM ans WHERE len(lens) >= 2""",
}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lessons(spark, sf) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("okey"), F.col("o_custkey").alias("course_id"), F.expr("'l' || o_orderkey").alias("lesson_id"),
        (F.substring("o_orderpriority", 1, 1).cast("bigint") - 1).alias("mod_idx"),
        F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("bigint").alias("ord"), F.col("o_orderkey").alias("array_pos"),
        F.col("o_orderstatus").alias("status"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))


def ordered(spark, sf) -> DataFrame:
    """Lesson positions when one course may be huge."""
    return number_within(lessons(spark, sf), ["course_id"], ["mod_idx"], "ord", ["okey"], "lesson_pos")


def modules(spark, sf) -> DataFrame:
    n = F.count("*")
    return lessons(spark, sf).groupBy("course_id", "mod_idx").agg(
        F.when(n % 7 == 0, None).otherwise(F.expr("sum(cents) div (count(*) * 6000000)")).alias("rung"),
        F.when(n % 5 == 0, None).otherwise(F.expr("max(cents) div 10000000")).alias("band")).select(
        "course_id", "mod_idx", F.col("mod_idx").alias("pos"), F.expr("'mod-' || mod_idx").alias("module_id"), "rung", "band")


def lines(spark, sf) -> DataFrame:
    """All lines of each order, numbered."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    ranked = (read(spark, sf, "lineitem")
              .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_returnflag")
              .withColumn("k", F.row_number().over(order)))
    return ranked.join(lessons(spark, sf), F.col("okey") == F.col("l_orderkey"))


def teaches(spark, sf):
    return lines(spark, sf).select("course_id", "mod_idx", F.expr("'s' || l_partkey % 12").alias("skill"))


def nodes(spark, sf):
    courses = lessons(spark, sf).select("course_id").distinct()
    return (courses.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(11)))).filter("(course_id + s) % 13 <> 0")
            .select("course_id", F.expr("'s' || s").alias("node")))


def edges(spark, sf):
    skill = F.col("l_partkey") % 12
    per_order = (lines(spark, sf).groupBy("course_id", "okey")
                 .agg(F.transform(F.sort_array(F.collect_list(F.struct("k", skill.alias("s")))), lambda x: x["s"]).alias("s")))
    kept = F.col("okey") % 100 == 0  # one order in a hundred may lead backwards and close a cycle
    pairs = per_order.select("course_id", "okey", F.explode(F.zip_with(
        F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("e"))
    src, dst = F.when(kept, F.col("e.a")).otherwise(F.least("e.a", "e.b")), F.when(kept, F.col("e.b")).otherwise(F.greatest("e.a", "e.b"))
    return (pairs.filter("e.a <> e.b").select("course_id", F.concat(F.lit("s"), src).alias("src"), F.concat(F.lit("s"), dst).alias("dst")).distinct())


def prereqs(spark, sf) -> DataFrame:
    every = lines(spark, sf)
    place = ["course_id", "lesson_id", "mod_idx", "ord", "array_pos"]
    anchors = lessons(spark, sf).groupBy(F.col("course_id"), F.col("mod_idx").alias("am")).agg(F.max("okey").alias("akey"))
    skills = every.select(*place, F.expr("'s' || l_partkey % 14").alias("pre"), (2 * F.col("k")).alias("pre_pos"))
    on_lessons = (every.withColumn("am", F.col("l_partkey") % 5).join(anchors, ["course_id", "am"])
                  .select(*place, F.expr("'l' || akey").alias("pre"), (2 * F.col("k") + 1).alias("pre_pos")))
    return flatten.resolve_prereqs(skills.unionByName(on_lessons), lessons(spark, sf), nodes(spark, sf))


def questions(spark, sf) -> DataFrame:
    options = lines(spark, sf).join(read(spark, sf, "part").select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    option = F.struct("k", F.expr("'o' || CASE WHEN okey % 40 = 0 THEN 1 ELSE k END").alias("id"), F.col("p_name").alias("label"),
                      (F.col("l_returnflag") == "R").alias("correct"), F.when(F.col("l_linenumber") % 3 == 0, "").otherwise("no").alias("feedback"))
    grouped = options.groupBy("course_id", "lesson_id", "okey", "status").agg(F.sort_array(F.collect_list(option)).alias("o"))
    return grouped.select(
        "course_id", "lesson_id", F.lit(0).alias("block"), F.lit(0).alias("q_pos"), F.col("lesson_id").alias("question"),
        F.expr("'q' || okey").alias("q_id"), F.when(F.col("okey") % 50 == 0, "").otherwise("why").alias("prompt"),
        (F.col("status") == "P").alias("multi"), F.transform("o", lambda x: x.dropFields("k")).alias("options"),
        F.when(F.col("okey") % 30 != 0, "so").alias("explanation"))


def add(name, fn, sql=None):
    Q[name] = fn
    if sql:
        SQL[name] = with_ctes(CTES, sql)


add("p02_lesson_positions", lambda s, sf: ordered(s, sf).select("course_id", "lesson_id", "lesson_pos"),
    "SELECT course_id, lesson_id, lesson_pos FROM pos")
add("g02_dangling_edges", lambda s, sf: graph.dangling_edges(nodes(s, sf), edges(s, sf)),
    flag_sql("dag", "dangling_edge", H, "src || '->' || dst", "''", "FROM edge e WHERE src NOT IN (SELECT node FROM node n WHERE n.course_id = e.course_id) OR dst NOT IN (SELECT node FROM node n WHERE n.course_id = e.course_id)"))
add("g03_cycle_leftovers", lambda s, sf: graph.cycle_flags(nodes(s, sf), edges(s, sf)), flag_sql("dag", "cycle", H, "node", "''", "FROM walk WHERE len = 12"))
add("g04_topo_depth", lambda s, sf: graph.topo_depth(nodes(s, sf), edges(s, sf)),
    """SELECT n.course_id, n.node, coalesce(max(len), 0) AS depth FROM node n LEFT JOIN walk w ON w.course_id = n.course_id AND w.node = n.node
       GROUP BY ALL HAVING coalesce(max(len), 0) < 12""")
add("g08_forward_lesson_deps", lambda s, sf: graph.forward_lesson_deps(prereqs(s, sf), lessons(s, sf)),
    flag_sql("dag", "forward_lesson_dep", H, "lesson_id", "pre", """FROM (SELECT pk.*, a.lesson_pos AS own, b.lesson_pos AS theirs FROM pk JOIN pos a USING (course_id, lesson_id)
       JOIN pos b ON b.course_id = pk.course_id AND b.lesson_id = pk.pre) WHERE theirs >= own"""))
add("g09_untaught_skills", lambda s, sf: graph.untaught_skills(prereqs(s, sf), flatten.first_taught(teaches(s, sf))),
    flag_sql("dag", "untaught_skill", H, "lesson_id", "pre", "FROM pk WHERE kind = 'skill' AND (course_id, pre) NOT IN (SELECT (course_id, skill) FROM first)"))
add("g10_late_skills", lambda s, sf: graph.late_skills(prereqs(s, sf), flatten.first_taught(teaches(s, sf))),
    flag_sql("dag", "late_skill", H, "lesson_id", "pre", "FROM (SELECT pk.*, f.seen_at FROM pk JOIN first f ON f.course_id = pk.course_id AND f.skill = pre) WHERE kind = 'skill' AND seen_at > mod_idx"))
add("g11_unresolved_prereqs", lambda s, sf: graph.unresolved_prereqs(prereqs(s, sf)),
    flag_sql("dag", "unresolved_prereq", H, "lesson_id", "pre", "FROM pk WHERE kind = 'unknown'"))
_before = "OVER (PARTITION BY course_id ORDER BY mod_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
add("l02_ladder_backward", lambda s, sf: course.ladder_backward(modules(s, sf)),
    flag_sql("ladder", "ladder_backward", H, "module_id", "rung || '<' || top", f"FROM (SELECT *, max(rung) {_before} AS top FROM mods WHERE rung IS NOT NULL) WHERE rung < top"))
add("l03_band_dip", lambda s, sf: course.band_dip(modules(s, sf)),
    flag_sql("ladder", "band_dip", A, "module_id", "band || '<' || lb", f"FROM (SELECT *, coalesce(last_value(band IGNORE NULLS) {_before}, 0) AS lb FROM mods WHERE rung IS NOT NULL) WHERE band < lb"))

# ---- quiz ----------------------------------------------------------------------------------------

WHERE = "lesson_id || '#0#0'"
_n = "len(list_filter(rights, lambda r: r))"
add("q06_correctness_of_orders", lambda s, sf: quiz.bad_correctness(questions(s, sf)),
    flag_sql("briefs", "bad_correctness", H, WHERE, _n, f"FROM qs WHERE CASE WHEN multi THEN {_n} < 1 ELSE {_n} <> 1 END"))
add("q04_options_of_orders", lambda s, sf: quiz.few_options(questions(s, sf)),
    flag_sql("briefs", "few_options", "CASE WHEN len(oids) < 2 THEN 'HARD' ELSE 'advisory' END", WHERE, "len(oids)", "FROM qs WHERE len(oids) < 3"))
add("q08_slot_skew", lambda s, sf: quiz.slot_skew(questions(s, sf), min_n=3),
    flag_sql("briefs", "slot_skew", H, "'slot ' || slot", "n || '/' || total", """FROM (SELECT course_id, slot, count(*) AS n, sum(count(*)) OVER (PARTITION BY course_id) AS total
        FROM ans GROUP BY course_id, slot) WHERE total >= 3 AND n * 2 > total"""))
add("q08_slot_distribution", lambda s, sf: quiz.slot_distribution(questions(s, sf)), "SELECT course_id, slot, count(*) AS n FROM ans GROUP BY course_id, slot")
add("q09_longest_tell", lambda s, sf: quiz.longest_tell(questions(s, sf), min_n=3, share=0.5),
    flag_sql("briefs", "longest_tell", A, "course_id", "k || '/' || total", """FROM (SELECT course_id, count(*) AS total, count(*) FILTER (len(lens) >= 2 AND lens[slot] = list_max(lens)
        AND len(list_filter(lens, lambda v: v = list_max(lens))) = 1) AS k FROM ans GROUP BY course_id) WHERE total >= 3 AND k * 2 > total"""))
add("q10_quiz_report", lambda s, sf: quiz.quiz_report(questions(s, sf)),
    """SELECT course_id, CAST(sum(n) AS BIGINT) AS questions, CAST(sum(k) AS BIGINT) AS longest, string_agg(slot || ':' || n, ' ' ORDER BY slot) AS spread,
       CAST(round_even(100.0 * sum(k) / sum(n), 0) AS BIGINT) AS longest_pct
       FROM (SELECT course_id, slot, count(*) AS n, count(*) FILTER (is_longest) AS k FROM rep GROUP BY ALL) GROUP BY course_id""")
add("q11_widest_gaps", lambda s, sf: quiz.widest_gaps(questions(s, sf), k=3),
    """SELECT course_id, q_id, gap, rank FROM (SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY gap DESC, q_id DESC) AS rank FROM rep WHERE is_longest) WHERE rank <= 3""")


def quiz_edits(spark, sf):
    """Current blocks per lesson and an edited copy: new labels, some moved answers, some unknown lessons."""
    q = questions(spark, sf).withColumn("okey", F.substring("q_id", 2, 30).cast("bigint"))
    def block(options):
        return F.array(F.struct(F.lit("check").alias("key"), F.array(F.struct(F.col("q_id").alias("id"), options.alias("options"))).alias("questions")))
    current = q.select("course_id", "lesson_id", block(F.col("options")).alias("quiz_blocks"))
    moved = F.col("okey") % 97 == 0
    edited_options = F.transform("options", lambda o, i: F.struct(
        o["id"].alias("id"), F.concat(o["label"], F.lit("!")).alias("label"),
        F.when(moved & (i == 0), ~o["correct"]).otherwise(o["correct"]).alias("correct"), o["feedback"].alias("feedback")))
    sent = q.filter("okey % 4 = 0")
    new_id = F.when(F.col("okey") % 89 == 0, F.concat("lesson_id", F.lit("x"))).otherwise(F.col("lesson_id"))
    return current, sent.select("course_id", new_id.alias("lesson_id"), block(edited_options).alias("quiz_blocks"))


add("q12_merge_report", lambda s, sf: quiz.merge_quiz(*quiz_edits(s, sf))[2],
    """SELECT course_id, refused, CASE WHEN refused > 0 THEN 0 ELSE sent END AS merged, CASE WHEN refused > 0 THEN 0 ELSE sent END AS changed
       FROM (SELECT course_id, count(*) FILTER (okey % 4 = 0 AND (okey % 89 = 0 OR okey % 97 = 0)) AS refused, count(*) FILTER (okey % 4 = 0) AS sent FROM qs GROUP BY course_id)""")
add("q12_merged_labels", lambda s, sf: quiz.merge_quiz(*quiz_edits(s, sf))[0].select(
    "course_id", "lesson_id", F.array_join(F.transform(F.get("quiz_blocks", F.lit(0))["questions"][0]["options"], lambda o: o["label"]), "|").alias("labels")),
    """SELECT course_id, lesson_id, array_to_string(CASE WHEN okey % 4 = 0 AND refused = 0 THEN list_transform(labels, lambda v: v || '!') ELSE labels END, '|') AS labels
       FROM (SELECT *, count(*) FILTER (okey % 4 = 0 AND (okey % 89 = 0 OR okey % 97 = 0)) OVER (PARTITION BY course_id) AS refused FROM qs)""")
add("q12_refused", lambda s, sf: quiz.merge_quiz(*quiz_edits(s, sf))[1],
    """SELECT course_id, lesson_id || CASE WHEN okey % 89 = 0 THEN 'x' ELSE '' END AS lesson_id, CASE WHEN okey % 89 = 0 THEN 'unknown lesson' ELSE 'shape changed' END AS reason
       FROM qs WHERE okey % 4 = 0 AND (okey % 89 = 0 OR okey % 97 = 0)""")


def case_results(spark, sf):
    return read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("challenge"), F.when(F.col("l_linenumber") % 2 == 1, "solution").otherwise("starter").alias("role"),
        F.col("l_linenumber").alias("case_id"), (F.col("l_returnflag") != "R").alias("ok"))


add("c08_contract_verdict", lambda s, sf: challenges.contract_verdict(case_results(s, sf)),
    """SELECT challenge, CASE WHEN sol AND fails > 0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
         CASE WHEN NOT sol THEN 'solution does not pass all' WHEN fails = 0 THEN 'starter passes all' ELSE '' END AS why
       FROM (SELECT l_orderkey AS challenge, count(*) FILTER (l_linenumber % 2 = 1) > 0 AND count(*) FILTER (l_linenumber % 2 = 1 AND l_returnflag = 'R') = 0 AS sol,
         count(*) FILTER (l_linenumber % 2 = 0 AND l_returnflag = 'R') AS fails FROM lineitem GROUP BY l_orderkey)""")


def claims(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_shipdate")
    named = lessons(spark, sf).select("okey", "course_id", "lesson_id")
    return li.join(named, F.col("okey") == F.col("l_orderkey")).select(
        "course_id", "lesson_id", F.expr("'C' || l_linenumber").alias("claim_id"),
        F.when(F.col("l_linestatus") == "F", "verified").otherwise("gathering").alias("status"), F.col("l_returnflag").alias("surface"),
        F.when(F.col("l_returnflag") == "N", "onchain").otherwise("prose").alias("kind"), F.to_date("l_shipdate").alias("checked_on"))


add("r02_off_list_claims", lambda s, sf: course.off_list_claims(claims(s, sf), surfaces=("A", "N")),
    flag_sql("research", "off_list_claim", H, "lesson_id || '/C' || l_linenumber", "l_returnflag", "FROM lineitem JOIN o ON okey = l_orderkey WHERE l_linestatus = 'F' AND l_returnflag = 'R'"))


def policy(spark, sf):
    return lessons(spark, sf).filter("mod_idx = 0").select("course_id", "lesson_id", (30 + F.col("course_id") % 60).alias("days"))


add("t05_stale_claims", lambda s, sf: state.stale_claims(claims(s, sf), policy(s, sf), "1998-01-01"),
    flag_sql("research", "stale_claim", H, "lesson_id || '/C' || l_linenumber", "CAST(l_shipdate AS DATE)",
             """FROM lineitem JOIN o ON okey = l_orderkey WHERE mod_idx = 0 AND l_returnflag = 'N'
                AND CAST(l_shipdate AS DATE) + CAST(30 + course_id % 60 AS INT) < DATE '1998-01-01'"""))

# ---- state and publishing --------------------------------------------------------------------------


def ledger(spark, sf):
    ls = lessons(spark, sf).withColumn("research_verified", F.col("mod_idx") == 1)
    needs = prereqs(spark, sf).filter("kind = 'lesson'")
    drafted = lessons(spark, sf).filter("status = 'F'").select("course_id", "lesson_id")
    return state.state_ledger(ls, needs, drafted)


CTES["led"] = """SELECT o.*, CASE WHEN status = 'F' THEN 'drafted' WHEN mod_idx = 1 THEN 'researched' ELSE 'briefed' END AS step, coalesce(b.blocked, '') AS blocked
  FROM o LEFT JOIN (SELECT pk.course_id AS bc, pk.lesson_id AS bl, string_agg(pre, ',' ORDER BY pre_pos) AS blocked FROM pk JOIN o p ON p.course_id = pk.course_id AND p.lesson_id = pre
    WHERE p.status <> 'F' GROUP BY ALL) b ON bc = o.course_id AND bl = o.lesson_id"""
add("t02_state_ledger", lambda s, sf: ledger(s, sf).select("course_id", "lesson_id", "status", F.array_join("blocked_by", ",").alias("blocked_by")),
    "SELECT course_id, lesson_id, step AS status, blocked AS blocked_by FROM led")
add("t02_lifecycle_counts", lambda s, sf: state.lifecycle_counts(ledger(s, sf)),
    """SELECT course_id, count(*) AS total, count(*) FILTER (step = 'briefed') AS briefed, count(*) FILTER (step = 'researched') AS researched,
       count(*) FILTER (step = 'drafted') AS drafted, 0 AS verified, 0 AS published FROM led GROUP BY course_id""")
add("t03_next_lesson", lambda s, sf: state.next_lesson(ledger(s, sf)),
    "SELECT course_id, arg_min(lesson_id, lesson_pos) AS next_to_write FROM led JOIN pos USING (course_id, lesson_id) WHERE step <> 'drafted' AND blocked = '' GROUP BY course_id")


def syllabus(spark, sf):
    ls = ordered(spark, sf).select(
        "course_id", "lesson_id", F.expr("'mod-' || mod_idx").alias("module_id"), "lesson_pos", F.expr("'Lesson ' || okey").alias("title"),
        F.col("status").alias("job"), F.when(F.col("okey") % 9 != 0, F.col("okey") % 3 + 1).alias("difficulty"))
    return state.syllabus(ls, modules(spark, sf).withColumn("title", F.expr("'Module ' || mod_idx")))


add("t04_syllabus", syllabus, """SELECT course_id, lesson_pos + 1 AS no, 'Lesson ' || okey AS lesson, 'Module ' || mod_idx AS module, status AS job,
  CASE WHEN okey % 9 = 0 THEN '?' ELSE CAST(okey % 3 + 1 AS VARCHAR) END AS difficulty FROM pos""")
add("t04_cover_map", lambda s, sf: state.module_cover(modules(s, sf).withColumn("title", F.expr("'Module ' || mod_idx"))),
    "SELECT course_id, mod_idx + 1 AS no, 'Module ' || mod_idx AS title FROM mods")


def slots(spark, sf):
    public = F.expr("'lesson-c-' || lesson_id")
    current = number_within(lessons(spark, sf).filter("okey % 5 <> 0 and okey % 11 <> 0"), ["course_id"], ["mod_idx"], "ord", ["okey"], "lesson_pos")
    previous = lessons(spark, sf).filter("okey % 3 <> 0").select(
        "course_id", public.alias("publish_id"), (F.col("okey") % 1000).alias("slot"), (F.col("okey") % 11 == 0).alias("retired"))
    return publish.assign_slots(current.select("course_id", public.alias("publish_id"), "lesson_pos"), previous)


CTES["prev"] = "SELECT course_id, okey, 'lesson-c-' || lesson_id AS publish_id, okey % 1000 AS slot, okey % 11 = 0 AS retired FROM o WHERE okey % 3 <> 0"
add("u02_assign_slots", lambda s, sf: slots(s, sf)[0],
    """SELECT course_id, publish_id, slot FROM prev WHERE NOT retired AND okey % 5 <> 0 UNION ALL
       SELECT course_id, 'lesson-c-' || lesson_id, coalesce(top, -1) + row_number() OVER (PARTITION BY course_id ORDER BY mod_idx, ord, okey)
       FROM o LEFT JOIN (SELECT course_id, max(slot) AS top FROM prev GROUP BY course_id) USING (course_id) WHERE okey % 5 <> 0 AND okey % 11 <> 0 AND okey % 3 = 0""")
add("u02_retired_slots", lambda s, sf: slots(s, sf)[1], "SELECT course_id, slot FROM prev WHERE retired OR okey % 5 = 0")


def publish_rules(spark, sf):
    ls = lessons(spark, sf)
    courses = ls.groupBy("course_id").agg(F.count("*").alias("n_lessons")).select(
        "course_id", F.when(F.col("course_id") % 50 == 0, F.expr("'Course_' || course_id")).otherwise(F.expr("'course-' || course_id")).alias("publish_id"),
        (F.col("course_id") % 1100).alias("xp_per_lesson"), "n_lessons")
    capability = F.when(F.col("mod_idx") < 3, "funded").otherwise("deployed")
    rows = ls.select("course_id", F.when(F.col("okey") % 70 == 0, F.col("lesson_id")).otherwise(F.expr("'lesson-' || lesson_id")).alias("publish_id"),
                     F.col("mod_idx").alias("pos"), F.when(F.col("okey") % 4 == 0, F.array(capability)).alias("produces"),
                     F.when(F.col("okey") % 6 == 1, F.array(F.lit("funded"), F.lit("deployed"))).alias("consumes"))
    files = ls.select("course_id", F.expr("lesson_id || '/f' || okey % 7").alias("path"))
    refs = ls.filter("okey % 9 <> 0").select("course_id", F.expr("lesson_id || '/f' || okey % 7").alias("path"))
    return publish.publish_rules(courses, rows, files, refs)


CTES["pubc"] = """SELECT course_id, CASE WHEN course_id % 50 = 0 THEN 'Course_' ELSE 'course-' END || course_id AS publish_id, course_id % 1100 AS xp, count(*) AS n FROM o GROUP BY course_id"""
CTES["publ"] = "SELECT *, CASE WHEN okey % 70 = 0 THEN '' ELSE 'lesson-' END || lesson_id AS publish_id FROM o"
CTES["prod"] = "SELECT course_id, CASE WHEN mod_idx < 3 THEN 'funded' ELSE 'deployed' END AS cap, min(mod_idx) AS seen_at FROM o WHERE okey % 4 = 0 GROUP BY ALL"
add("u05_publish_rules", publish_rules, union_sql(
    flag_sql("publish", "bad_course_id", H, "publish_id", "''", "FROM pubc WHERE course_id % 50 = 0"),
    flag_sql("publish", "bad_lesson_id", H, "publish_id", "''", "FROM publ WHERE okey % 70 = 0"),
    flag_sql("publish", "xp_ceiling", H, "publish_id", "xp * n", "FROM pubc WHERE xp * n > 10000"),
    flag_sql("publish", "xp_range", H, "publish_id", "xp", "FROM pubc WHERE xp NOT BETWEEN 1 AND 100"),
    flag_sql("publish", "consumes_before_produces", H, "publish_id", "c", """FROM (SELECT publ.course_id, publish_id, mod_idx, c, seen_at FROM (SELECT *, unnest(['funded', 'deployed']) AS c FROM publ WHERE okey % 6 = 1) publ
        LEFT JOIN prod ON prod.course_id = publ.course_id AND cap = c) WHERE seen_at IS NULL OR seen_at >= mod_idx"""),
    flag_sql("publish", "orphan_file", H, "lesson_id || '/f' || okey % 7", "''", "FROM o WHERE okey % 9 = 0")))


def tree(spark, sf):
    """Planned files, files on disk and the lock of an earlier write."""
    ls = lessons(spark, sf).withColumn("path", F.expr("'briefs/' || lesson_id"))
    planned = ls.select("course_id", "path", F.expr("'v2 ' || okey").alias("content"))
    disk = ls.filter("okey % 3 <> 0").select("course_id", "path", F.expr("CASE WHEN okey % 5 = 0 THEN 'mine ' ELSE 'v1 ' END || okey").alias("content"))
    lock = ls.filter("okey % 4 <> 0").select("course_id", "path", F.sha2(F.expr("'v1 ' || okey"), 256).alias("sha256"))
    return planned, disk, lock


_edit = "okey % 3 <> 0 AND okey % 4 <> 0 AND okey % 5 = 0"
add("t01_hash_drift", lambda s, sf: state.drift(*tree(s, sf)),
    f"""SELECT course_id, 'briefs/' || lesson_id AS path, CASE WHEN {_edit} THEN 'skip' ELSE 'write' END AS action,
       sha256(CASE WHEN {_edit} THEN 'mine ' ELSE 'v2 ' END || okey) AS sha256, {_edit} AS edited_by_human FROM o""")


def applied(spark, sf):
    """A tree is written, edited by hand in places, planned anew and read back; the second plan is applied twice, as after a failure."""
    root, (planned, disk, lock) = fresh_path(spark, "tree"), tree(spark, sf)
    first = planned.join(lock, ["course_id", "path"], "left_semi").withColumn("content", F.replace("content", F.lit("v2"), F.lit("v1")))
    tree_store.apply_plan(first, root, "first")
    tree_store.apply_edits(disk.join(first, ["course_id", "path"], "left_semi").filter("content LIKE 'mine%'"), root, "by-hand")
    for _ in range(2):
        tree_store.apply_plan(planned, root, "second")
    files, lock = tree_store.read_tree(spark, root)
    return files.join(lock, ["course_id", "path"], "full").withColumn("course_id", F.col("course_id").cast("bigint"))


add("t01_applied_drift", applied, f"""SELECT course_id, 'briefs/' || lesson_id AS path, CASE WHEN {_edit} THEN 'mine ' ELSE 'v2 ' END || okey AS content,
    sha256(CASE WHEN {_edit} THEN 'mine ' ELSE 'v2 ' END || okey) AS sha256, {_edit} AS edited_by_human FROM o""")
add("t01_forced_write", lambda s, sf: state.drift(*tree(s, sf), force=True),
    "SELECT course_id, 'briefs/' || lesson_id AS path, 'write' AS action, sha256('v2 ' || okey) AS sha256, false AS edited_by_human FROM o")
