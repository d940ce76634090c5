"""Queries over drafts derived from `documents`, each with its DuckDB counterpart.

The library reads fences inside a row; the oracle explodes lines and counts fences with windows, so the two
share the rules but not the method.
"""
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern import vocab
from lectern.operators import code, corpus, drafts, publish, visuals
from lectern.plans.checks import draft_flags
from lectern.sources import files
from oracle import draft_data as dd
from oracle.shared import flag_sql, union_sql, with_ctes

H, A = "'HARD'", "'advisory'"
Q: dict = {}
SQL: dict = {}


def add(name, fn, sql=None):
    Q[name] = lambda spark, sf: fn(dd.drafts(spark, sf), spark, sf)
    if sql:
        SQL[name] = with_ctes(dd.CTES, sql)


def metrics_out(m: DataFrame) -> DataFrame:
    return m.withColumn("visual_types", F.array_join("visual_types", ","))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of each draft with the flags that rest on them."""
    rows = drafts.assessed(dd.drafts(spark, sf))
    wanted = F.filter("findings", lambda f: f["rule"].isin("prose_wall", "dash_policy", "depth_band"))
    found = rows.withColumn("wanted", wanted)
    return metrics_out(found).select(
        "course_id", "stem", *drafts.METRICS, F.array_join(F.array_sort(F.transform("wanted", lambda f: f["rule"])), ",").alias("rules"),
        F.size(F.filter("wanted", lambda f: f["severity"] == "HARD")).cast("bigint").alias("hard"))


METRICS = "course_id, stem, prose_words, longest_wall, wall_end_line, first_code_words, first_fence_words, visual_blocks, visual_valid, visual_types"
_flagged = "SELECT *, (longest_wall > 450) AS w, (dashes > 0) AS h, (prose_words < 2400 OR prose_words > 5500) AS b FROM m JOIN dc USING (d)"
add("d00_flagship", lambda t, s, sf: flagship(s, sf),
    f"""SELECT {METRICS}, concat_ws(',', CASE WHEN h THEN 'dash_policy' END, CASE WHEN b THEN 'depth_band' END, CASE WHEN w THEN 'prose_wall' END) AS rules,
      CAST(dashes > 2 AS BIGINT) + CAST(longest_wall > 700 AS BIGINT) AS hard FROM ({_flagged})""")
add("d01_lines", lambda t, s, sf: drafts.to_lines(t).withColumn("pos", F.col("pos").cast("bigint")), "SELECT course_id, stem, p - 1 AS pos, line FROM dl")
for _mode, _col in (("toggle", "toggles"), ("tagged", "tagged"), ("visual", "visuals")):
    add(f"d02_fences_{_mode}", lambda t, s, sf, mode=_mode: drafts.fence_state(t, mode).withColumn("fence_no", F.col("fence_no").cast("bigint")),
        f"""SELECT course_id, stem, CAST(fn - 1 AS BIGINT) AS fence_no, label, CASE substr({_col}, CAST(fn AS BIGINT), 1) WHEN 'o' THEN 'open' WHEN 'c' THEN 'close' ELSE 'ignored' END AS role
          FROM fen JOIN tok USING (d) JOIN dr USING (d)""")
add("d03_dash_count", lambda t, s, sf: drafts.dash_count(t), "SELECT course_id, stem, dashes FROM dr JOIN dc USING (d)")

_prose = "regexp_extract(line, '^( *)', 1) || "
_t = "ltrim(line, ' ')"
for _p, _r in ((" ?[—–] ?", ", "), (" -- ", ", "), (r"\A,\s*", ""), (" +,", ","), (r",\s*,", ", "), (r",\s*([.;:!?])", r"\1")):
    _t = f"regexp_replace({_t}, '{_p}', '{_r}', 'g')"
DEDASHED = f"""SELECT d, course_id, stem, string_agg(CASE WHEN is_f THEN line WHEN fn % 2 = 0 OR low = 'visual' THEN {_prose}{_t}
  ELSE regexp_replace(line, ' ?[—–] ?', ' - ', 'g') END, chr(10) ORDER BY p) AS md
  FROM (SELECT df.*, lower(label) AS low FROM df LEFT JOIN fen USING (d, fn)) GROUP BY ALL"""
add("d04_dedash", lambda t, s, sf: drafts.dedash(t).select("course_id", "stem", F.md5("md").alias("md5")), f"SELECT course_id, stem, md5(md) AS md5 FROM ({DEDASHED})")
add("d05_visual_specs", lambda t, s, sf: drafts.parse_visuals(t)[0].withColumn("n", F.col("n").cast("bigint")),
    "SELECT course_id, stem, n, v_type AS type, v_title AS title, v_purpose AS purpose, v_data AS data, v_prompt AS prompt, v_alt AS alt, valid FROM vv")
add("d05_visual_defects", lambda t, s, sf: drafts.visual_defects(t),
    flag_sql("drafts", "visual_defect", H, "stem", "n || ':' || CASE WHEN closer IS NULL THEN 'unclosed' ELSE 'glued' END",
             "FROM vis JOIN dr USING (d) WHERE closer IS NULL OR closer <> '```'"))
add("d06_draft_metrics", lambda t, s, sf: metrics_out(drafts.draft_metrics(t)), f"SELECT {METRICS} FROM m")

RULES: dict = {}


def rule(name, fn, *sqls):
    RULES[name] = sqls
    add(name, lambda t, s, sf: fn(t), union_sql(*sqls))


rule("d07_no_title", drafts.no_title,
     flag_sql("drafts", "no_title", H, "stem", "''", "FROM dr WHERE NOT starts_with((SELECT arg_min(line, p) FROM dl WHERE dl.d = dr.d AND dl.s <> ''), '# ')"))
rule("d08_visual_floor", lambda t: drafts.visual_floor(drafts.draft_metrics(t)),
     flag_sql("drafts", "visual_floor", H, "stem", "visual_valid || '/' || fl", "FROM (SELECT *, CAST(greatest(2, ceil(prose_words / 600)) AS BIGINT) AS fl FROM m) WHERE visual_valid < fl"))
_weak = f"{dd.words_sql('v_alt')} < 8 OR {dd.words_sql('v_alt')} > 30 OR lower(v_alt) = lower(v_title) OR regexp_matches(lower(v_alt), '^(image|diagram|visual|illustration) of')"
# Visual numbers count the valid ones, in order.
_valid = "(SELECT *, row_number() OVER (PARTITION BY d ORDER BY n) AS vn FROM vv WHERE valid)"
rule("d09_visual_quality", drafts.visual_quality,
     flag_sql("drafts", "one_visual_type", A, "stem", "visual_types", "FROM m WHERE visual_valid >= 2 AND NOT contains(visual_types, ',')"),
     flag_sql("drafts", "weak_alt", A, "stem", "vn", f"FROM {_valid} WHERE {_weak}"),
     flag_sql("drafts", "bracket_in_alt", H, "stem", "vn", f"FROM {_valid} WHERE regexp_matches(v_alt, '[\\[\\]]')"))
rule("d10_prose_wall", lambda t: drafts.prose_wall(drafts.draft_metrics(t)),
     flag_sql("drafts", "prose_wall", "CASE WHEN longest_wall > 700 THEN 'HARD' ELSE 'advisory' END", "stem", "longest_wall || '@' || wall_end_line", "FROM m WHERE longest_wall > 450"))


def stem_table(t: DataFrame) -> DataFrame:
    """Half of the courses have a manifest; a third of their lessons are concept lessons, one in seven an opener."""
    return t.filter("d % 5 <> 0 and substr(course_id, -1) in ('0', '1', '2', '3', '4')").select(
        "course_id", "stem", F.when(F.col("d") % 3 == 0, "concept").otherwise("build").alias("kind"), (F.col("d") % 7 == 0).alias("opener"))


add("d11_late_first_do", lambda t, s, sf: drafts.late_first_do(drafts.draft_metrics(t), stem_table(t)),
    flag_sql("drafts", "late_first_do", H, "stem", "coalesce(CAST(fd AS VARCHAR), 'none')", """FROM (SELECT *, d % 5 <> 0 AS known,
      CASE WHEN d % 5 <> 0 AND d % 3 = 0 THEN first_fence_words ELSE first_code_words END AS fd, CASE WHEN d % 5 <> 0 AND d % 7 = 0 THEN 150 ELSE 300 END AS budget
      FROM m WHERE substr(course_id, -1) IN ('0', '1', '2', '3', '4') AND course_id IN (SELECT course_id FROM dr WHERE d % 5 <> 0)) WHERE fd IS NULL OR fd > budget"""))


def phrases(spark: SparkSession, sf: str, n: int = 3) -> DataFrame:
    """All runs of n words of benchmark items: grows with the table."""
    words = F.split(F.regexp_replace("text", "\n", " "), " ", -1)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - n + 1)), lambda i: F.lower(F.array_join(F.slice(words, i, F.lit(n)), " ")))
    return (spark.read.parquet(f"{sf}/benchmark.parquet").select(F.explode(runs).alias("phrase")).filter(F.length("phrase") >= 4).distinct())


def phrases_sql(n: int = 3) -> str:
    return f"""(SELECT DISTINCT phrase FROM (SELECT lower(array_to_string(list_slice(w, i, i + {n - 1}), ' ')) AS phrase FROM
      (SELECT w, unnest(range(1, greatest(1, len(w) - {n - 1}) + 1)) AS i FROM (SELECT string_split(replace(text, chr(10), ' '), ' ') AS w FROM benchmark))) WHERE length(phrase) >= 4)"""


add("d12_draft_blocklist", lambda t, s, sf: corpus.draft_blocklist(t, phrases(s, sf)),
    flag_sql("drafts", "blocklist", H, "stem", "phrase", f"FROM dr, {phrases_sql()} WHERE contains(lower(md), phrase)"))
_tools = " ".join(f"WHEN regexp_matches(shell, '(?m)^[ \\t]*(?:[$#][ \\t]*)?(?:[A-Z_]+=\\S+[ \\t]+)*{tool}\\b') AND NOT contains(lower(md), '{ins}') THEN '{tool}'"
                  for tool, ins in vocab.TOOL_INSTALLERS)
rule("d13_tool_without_install", drafts.tool_without_install,
     flag_sql("drafts", "tool_without_install", A, "stem", "tool", f"""FROM (SELECT dr.course_id, dr.stem, CASE {_tools} END AS tool FROM dr JOIN
        (SELECT d, lower(string_agg(line, chr(10) ORDER BY p)) AS shell FROM dx WHERE inside AND low_label IN ('bash', 'sh', 'shell', 'console', 'zsh') GROUP BY d) USING (d)) WHERE tool IS NOT NULL"""))
rule("d14_dash_policy", lambda t: drafts.dash_policy(drafts.dash_count(t)),
     flag_sql("drafts", "dash_policy", "CASE WHEN dashes > 2 THEN 'HARD' ELSE 'advisory' END", "stem", "dashes", "FROM dr JOIN dc USING (d) WHERE dashes >= 1"))
rule("d15_depth_band", lambda t: drafts.depth_band(drafts.draft_metrics(t)),
     flag_sql("drafts", "depth_band", A, "stem", "prose_words", "FROM m WHERE prose_words < 2400 OR prose_words > 5500"))
_par = f"""(SELECT d, pid, string_agg(s, ' ' ORDER BY p) AS para FROM (SELECT *, sum(CASE WHEN s = '' THEN 1 ELSE 0 END) OVER (PARTITION BY d ORDER BY p) AS pid
  FROM dx WHERE NOT inside) WHERE s <> '' AND NOT regexp_matches(s, '^[#|>*1-9-]') GROUP BY d, pid)"""
_cnt = f"""(SELECT d, len(list_filter(regexp_split_to_array(para, '[.?][\\n{dd.SP}]'), lambda v: {dd.strip_sql('v')} <> '')) AS c FROM {_par} WHERE {dd.words_sql('para')} > 10)"""
rule("d16_paragraph_rhythm", drafts.paragraph_rhythm,
     flag_sql("drafts", "paragraph_rhythm", A, "stem", "found", f"""FROM (SELECT d, CASE WHEN max(c) < 4 THEN 'no_developed_paragraph' WHEN sum(c) < 1.8 * count(*) THEN 'staccato' END AS found
        FROM {_cnt} GROUP BY d) JOIN dr USING (d) WHERE found IS NOT NULL"""))
add("d19_metrics_table", lambda t, s, sf: drafts.metrics_table(drafts.draft_metrics(t)),
    """SELECT course_id, stem, prose_words, visual_valid, CASE WHEN visual_types = '' THEN 0 ELSE len(string_split(visual_types, ',')) END AS n_types, longest_wall,
       coalesce(CAST(first_code_words AS VARCHAR), '-') AS first_code FROM m""")


def default_phrases(spark):
    return spark.createDataFrame([(p,) for p in vocab.DEFAULT_BLOCKLIST], "phrase string")


ALL_RULES = [part for parts in RULES.values() for part in parts] + [SQL_DEFECTS := flag_sql(
    "drafts", "visual_defect", H, "stem", "n || ':' || CASE WHEN closer IS NULL THEN 'unclosed' ELSE 'glued' END", "FROM vis JOIN dr USING (d) WHERE closer IS NULL OR closer <> '```'")]
add("d26_all_draft_flags", lambda t, s, sf: draft_flags(t, default_phrases(s)), union_sql(*ALL_RULES))

# ---- comments and projection -------------------------------------------------------------------------



def _blank(c: str) -> str:
    return f"NOT regexp_matches({c}, '[^\\n{dd.SP}]')"


def _fence(c: str) -> str:
    return f"regexp_matches({c}, '^[{dd.SP}]*```')"


_cut = "regexp_replace(r.v, '<!--.*?-->', '', 'g')"
_open = f"strpos({_cut}, '<!--')"
_kept = f"CASE WHEN {_open} > 0 THEN substr({_cut}, 1, {_open} - 1) ELSE {_cut} END"
# State letter (n plain, f in a fence, c in a comment), then the text so far.
COMMENT_FOLD = f"""substr(list_reduce(lines, lambda acc, x: list_transform(list_transform([{{'s': substr(acc, 1, 1), 'o': substr(acc, 2), 'x': x}}],
    lambda q: CASE WHEN q.s = 'c' AND strpos(q.x, '-->') = 0 THEN {{'s': 'c', 'o': q.o, 'v': '', 'skip': true}}
                   WHEN q.s = 'c' AND {_blank("substr(q.x, strpos(q.x, '-->') + 3)")} THEN {{'s': 'n', 'o': q.o, 'v': '', 'skip': true}}
                   WHEN q.s = 'c' THEN {{'s': 'n', 'o': q.o, 'v': substr(q.x, strpos(q.x, '-->') + 3), 'skip': false}}
                   ELSE {{'s': q.s, 'o': q.o, 'v': q.x, 'skip': false}} END),
    lambda r: CASE WHEN r.skip THEN r.s || r.o
                   WHEN r.s = 'f' THEN CASE WHEN {_fence('r.v')} THEN 'n' ELSE 'f' END || r.o || chr(10) || r.v
                   WHEN {_fence('r.v')} THEN 'f' || r.o || chr(10) || r.v
                   WHEN ({_kept}) <> r.v AND {_blank(f'({_kept})')} THEN CASE WHEN {_open} > 0 THEN 'c' ELSE 'n' END || r.o
                   ELSE CASE WHEN {_open} > 0 THEN 'c' ELSE 'n' END || r.o || chr(10) || ({_kept}) END)[1], 'n'), 3)"""
dd.CTES["sc"] = f"SELECT d, course_id, stem, {COMMENT_FOLD} AS md FROM (SELECT *, string_split(md, chr(10)) AS lines FROM dr)"
add("d17_strip_comments", lambda t, s, sf: drafts.strip_comments(t).select("course_id", "stem", F.md5("md").alias("md5")), "SELECT course_id, stem, md5(md) AS md5 FROM sc")
add("d17_strip_page_comments", lambda t, s, sf: drafts.strip_comments(s.read.parquet(f"{sf}/pages.parquet"), "html").select("page_id", F.md5("html").alias("md5")),
    f"SELECT page_id, md5({COMMENT_FOLD}) AS md5 FROM (SELECT page_id, string_split(html, chr(10)) AS lines FROM pages)")


# Rendered files and strays of each draft: (condition, file, bytes).
ASSETS = [("d % 2 = 0", "'v01-chart.png'", "1000"), ("d % 3 = 0", "'v01-chart.webp'", "500"), ("d % 4 = 0", "'v02-flowchart.png'", "900"),
          ("d % 7 = 0", "'v01-another.png'", "10"), ("d % 5 = 0", "'v01-chart.html'", "20"), ("d % 5 = 1", "'v01-chart.__render.html'", "20"),
          ("d % 6 = 0", "'v01-chart.pdf'", "20"), ("d % 9 = 0", "'photo.JPG'", "70"), ("d % 10 = 0", "'banner.webp'", "d * 20000")]
dd.CTES["ast"] = union_sql(*[f"SELECT d, course_id, stem, {f} AS file, CAST({b} AS BIGINT) AS bytes FROM dr WHERE {c}" for c, f, b in ASSETS])
dd.CTES["pick"] = """SELECT d, course_id, stem, CAST(regexp_extract(file, '^v(\\d+)-', 1) AS INT) AS n, coalesce(max(file) FILTER (file LIKE '%.webp'), min(file) FILTER (file LIKE '%.png')) AS file
  FROM ast WHERE regexp_matches(file, '^v\\d+-.*\\.(png|webp)$') GROUP BY ALL"""


def listing(t: DataFrame) -> DataFrame:
    """The file listing of the catalog's asset folders, as paths and sizes."""
    rows = F.expr("filter(array(" + ", ".join(f"CASE WHEN {c} THEN named_struct('f', {f}, 'b', CAST({b} AS BIGINT)) END" for c, f, b in ASSETS) + "), a -> a IS NOT NULL)")
    return t.select("course_id", "stem", F.explode(rows).alias("a")).select(
        F.concat(F.lit("/catalog/"), "course_id", F.lit("/lessons/assets/"), "stem", F.lit("/"), "a.f").alias("path"), F.col("a.b").alias("length"))


def assets(t: DataFrame) -> DataFrame:
    return files.parse_assets(listing(t))


add("s05_assets", lambda t, s, sf: assets(t), """SELECT course_id, stem, file, bytes, CASE WHEN regexp_matches(file, '^v\\d+-.*\\.(png|webp|html)$')
  THEN CAST(regexp_extract(file, '^v(\\d+)-', 1) AS INT) END AS n FROM ast""")
add("u06_asset_choice", lambda t, s, sf: visuals.asset_choice(assets(t)), "SELECT course_id, stem, n, file FROM pick")
dd.CTES["pl"] = f"""SELECT *, {dd.strip_sql('line')} AS s FROM (SELECT d, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS p FROM sc)"""
dd.CTES["pr"] = """SELECT pl.*, substr(roles, p, 1) AS role FROM pl JOIN (SELECT d, list_reduce(list(CASE s WHEN '```visual' THEN 'v' WHEN '```' THEN 'b' ELSE '.' END ORDER BY p),
  lambda acc, t: acc || CASE WHEN right(acc, 1) IN ('o', 'i') THEN CASE WHEN t = 'b' THEN 'c' ELSE 'i' END WHEN t = 'v' THEN 'o' ELSE '-' END, '') AS roles FROM pl GROUP BY d) USING (d)"""
dd.CTES["pn"] = "SELECT *, sum(CASE WHEN role = 'o' THEN 1 ELSE 0 END) OVER (PARTITION BY d ORDER BY p) AS n FROM pr"
_f = {k: f"arg_max(trim(regexp_extract(line, '^\\s*{k}:(.*)$', 1)), p) FILTER (role = 'i' AND regexp_matches(line, '^\\s*{k}:'))" for k in ("title", "type", "alt")}
dd.CTES["ps"] = f"SELECT d, n, coalesce({_f['title']}, {_f['type']}, 'diagram') AS title, coalesce({_f['alt']}, '') AS alt FROM pn WHERE n > 0 GROUP BY d, n"
dd.CTES["pe"] = """SELECT d, p, CASE WHEN role = '-' THEN line WHEN file IS NOT NULL THEN '![' || coalesce(nullif(alt, ''), title) || '](assets/' || file || ')'
  ELSE '> **Visual — ' || title || '.**' || CASE WHEN alt <> '' THEN ' ' || alt ELSE '' END END AS line, role, file, n, title
  FROM pn LEFT JOIN ps USING (d, n) LEFT JOIN (SELECT d, n, file FROM pick) USING (d, n) WHERE role IN ('-', 'o')"""
dd.CTES["pz"] = f"SELECT d, regexp_replace(string_agg(line, chr(10) ORDER BY p), '[\\n{dd.SP}]+\\z', '') || chr(10) AS prose FROM pe GROUP BY d"
add("d18_project_prose", lambda t, s, sf: drafts.project_prose(t, visuals.asset_choice(assets(t)))[0].select("course_id", "stem", F.md5("prose").alias("md5")),
    "SELECT course_id, stem, md5(prose) AS md5 FROM pz JOIN dr USING (d)")
add("d18_projection_warnings", lambda t, s, sf: drafts.project_prose(t, visuals.asset_choice(assets(t)))[1].withColumn("n", F.col("n").cast("bigint")),
    "SELECT course_id, stem, CAST(n AS BIGINT) AS n, title FROM pe JOIN dr USING (d) WHERE role = 'o' AND file IS NULL")

# ---- visuals and assets --------------------------------------------------------------------------------

_vslug = "coalesce(nullif(trim(regexp_replace(lower(coalesce(nullif(v_type, ''), 'diagram')), '[^\\pL\\pN]+', '-', 'g'), '-'), ''), 'x')"
dd.CTES["wk"] = f"SELECT d, course_id, stem, n, v_type, v_title, printf('%s/v%02d-%s', stem, CAST(n AS INT), {_vslug}) AS asset_id FROM vv"
add("v01_visual_worklist", lambda t, s, sf: visuals.visual_worklist(t).withColumn("n", F.col("n").cast("bigint")),
    "SELECT course_id, stem, n, v_type AS type, v_title AS title, asset_id FROM wk")
add("v02_render_coverage", lambda t, s, sf: visuals.render_coverage(visuals.visual_worklist(t), assets(t)),
    "SELECT course_id, stem, count(*) AS total, count(*) FILTER (asset_id || '.png' IN (SELECT stem || '/' || file FROM ast)) AS rendered FROM wk GROUP BY course_id, stem")
add("v03_spec_render_mismatch", lambda t, s, sf: visuals.spec_render_mismatch(t, assets(t)),
    """SELECT course_id, stem, specs, rendered FROM (SELECT dr.d, course_id, stem, (SELECT count(*) FROM dl WHERE dl.d = dr.d AND s = '```visual') AS specs,
       (SELECT count(*) FROM pick WHERE pick.d = dr.d) AS rendered FROM dr) WHERE rendered > 0 AND specs <> rendered""")


def pages(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet")


ARTICLE = r"(?s)<article>(.*?)</article>"
LINT = ["margin:0", "box-shadow", "track(1", "ad 1", "<nav>"]
_lint = ", ".join(f"'{x}'" for x in LINT)
add("v04_css_lint", lambda t, s, sf: visuals.css_lint(pages(s, sf), LINT, pattern=None),
    f"SELECT page_id, css FROM (SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS h, unnest([{_lint}]) AS css FROM pages) WHERE contains(h, css)")
add("v04_card_lint", lambda t, s, sf: visuals.css_lint(pages(s, sf), ["<b>", "&amp;", "margin:0"], pattern=ARTICLE),
    "SELECT page_id, css FROM (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS h, unnest(['<b>', '&amp;', 'margin:0']) AS css FROM pages) WHERE contains(h, css)")
add("v05_density_class", lambda t, s, sf: visuals.density_class(pages(s, sf), ARTICLE),
    """SELECT page_id, length(h) AS chars, CASE WHEN length(h) > 600 THEN 1 WHEN length(h) < 345 THEN 3 ELSE 2 END AS density FROM (SELECT page_id,
       trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]+>', ' ', 'g'), '[ \\t\\n\\f\\r\\v]+', ' ', 'g')) AS h FROM pages)""")
dd.CTES["sh"] = """SELECT d, course_id, stem, file, bytes, CASE WHEN regexp_matches(lower(file), '\\.(png|jpg|jpeg|webp|gif)$') THEN 'raster'
    WHEN regexp_matches(file, '^v.*\\.html$') AND NOT regexp_matches(file, '\\.__[\\w-]+\\.html$') THEN 'source' END AS kind
  FROM ast WHERE NOT (file = 'v01-chart.png' AND d % 3 = 0)"""
add("u06_shipped_assets", lambda t, s, sf: publish.ship_assets(assets(t)), "SELECT course_id, stem, file, kind, bytes FROM sh WHERE kind IS NOT NULL")
add("u06_asset_balance", lambda t, s, sf: publish.asset_balance(publish.ship_assets(assets(t)), drafts.project_prose(t, visuals.asset_choice(assets(t)))[0]),
    """SELECT course_id, refs, copied, refs = copied AS match FROM (SELECT course_id, CAST(sum((length(prose) - length(replace(prose, '](assets/', ''))) / 9) AS BIGINT) AS refs
       FROM pz JOIN dr USING (d) GROUP BY course_id) LEFT JOIN (SELECT course_id, count(*) FILTER (kind = 'raster') AS copied FROM sh GROUP BY course_id) USING (course_id)""")
add("u06_oversize_banners", lambda t, s, sf: publish.oversize_banners(assets(t)),
    flag_sql("publish", "oversize_banner", A, "file", "bytes", "FROM ast WHERE file = 'banner.webp' AND bytes > 1048576"))

# ---- code blocks -----------------------------------------------------------------------------------------


def blocks(t: DataFrame) -> DataFrame:
    return code.extract_blocks(t)


def longs(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


add("x01_code_blocks", lambda t, s, sf: longs(blocks(t), "n", "n_all"), "SELECT course_id, stem, n_all, lang, n, info, code FROM bl")
_lines = "list_filter(string_split(code, chr(10)), lambda v: trim(v) <> '' AND NOT regexp_matches(v, '^\\s*(//|#\\[)'))"
_first = "ltrim(lines[1])"
dd.CTES["kd"] = f"""SELECT *, CASE WHEN lang = 'typescript' THEN CASE WHEN regexp_matches(code, '(,|\\+|&&|\\|\\||=>|\\(|\\[)\\s*$') THEN 'fragment'
      WHEN regexp_matches(code, '(?m)^\\s*(import|export)\\s') THEN 'standalone' ELSE 'fragment' END
    WHEN lang = 'rust' THEN CASE WHEN regexp_matches(code, '(?m)^\\s*(use\\s+anchor_lang|declare_id!|fn\\s+main\\s*\\()') THEN 'standalone' WHEN len(lines) = 0 THEN 'body'
      WHEN len(list_filter(lines, lambda v: NOT regexp_matches(v, '^\\s*(?:pub\\s+)?\\w+\\s*:\\s*[^;=]+,\\s*(?://.*)?$'))) = 0 THEN 'fields'
      WHEN len(list_filter(lines, lambda v: NOT regexp_matches(v, '^\\s*[A-Z]\\w*(\\s*\\((?:[^()]|\\([^()]*\\))*\\))?(\\s*\\{{[^{{}}]*\\}})?\\s*,\\s*(?://.*)?$'))) = 0 THEN 'variants'
      WHEN regexp_matches({_first}, '^(pub\\s+(struct|enum|fn|mod|const|static|type|trait|use)|struct\\s|enum\\s|impl\\s|trait\\s|fn\\s|mod\\s|use\\s|const\\s|static\\s|type\\s)')
        OR regexp_matches(code, '^\\s*#\\[') THEN CASE WHEN regexp_matches({_first}, '^(pub(\\([^)]*\\))?\\s+)?fn\\s') AND
          regexp_matches(code, 'fn\\s+\\w+\\s*(<[^>]*>)?\\s*\\([^)]*\\bself\\b') AND NOT regexp_matches(code, '\\bimpl\\b') THEN 'assoc' ELSE 'item' END
      WHEN regexp_matches(code, '\\bself\\b') THEN 'method' ELSE 'body' END END AS kind FROM (SELECT *, {_lines} AS lines FROM bl)"""
for _lang, _id in (("typescript", "x02_typescript_kinds"), ("rust", "x03_rust_kinds")):
    add(_id, lambda t, s, sf, lang=_lang: longs(code.classify(blocks(t).filter(F.col("lang") == lang)).select("course_id", "stem", "n", "kind"), "n"),
        f"SELECT course_id, stem, n, kind FROM kd WHERE lang = '{_lang}'")
_ct = lambda ch: f"(length(code) - length(replace(code, '{ch}', '')))"
add("x04_by_design_skip", lambda t, s, sf: longs(code.by_design_skip(blocks(t)), "n"),
    f"""SELECT course_id, stem, lang, n, reason FROM (SELECT *, CASE WHEN regexp_matches(code, '["''][^"''\n]*<[^"''>\n]+>[^"''\n]*["'']') THEN 'placeholder'
      WHEN regexp_matches(code, '[\\{{\\[]\\s*\\.\\.\\.\\s*[\\}}\\]]') THEN 'ellipsis' WHEN {_ct('{')} <> {_ct('}')} THEN 'braces' WHEN {_ct('(')} <> {_ct(')')} THEN 'parens'
      WHEN {_ct('[')} <> {_ct(']')} THEN 'brackets' END AS reason FROM bl) WHERE reason IS NOT NULL""")


def npm_pins(t):
    return code.harvest_pins(code.npm_specs(t), "npm")


def cargo_pins(t):
    return code.harvest_pins(code.cargo_specs(blocks(t)), "cargo")


dd.CTES["tail"] = """SELECT d, course_id, stem, unnest(ts) AS tail, generate_subscripts(ts, 1) AS t FROM (SELECT *, regexp_extract_all(md, '\\b(?:npm|pnpm|yarn)\\s+(?:i|install|add)\\b([^\n`]*)', 1) AS ts FROM dr)"""
dd.CTES["spec"] = """SELECT course_id, stem, t, unnest(ps) AS pkg, unnest(vs) AS ver, generate_subscripts(ps, 1) AS s FROM (SELECT *,
  regexp_extract_all(tail, '(@?[\\w.-]+(?:/[\\w.-]+)?)@(\\^?~?[\\w.\\-]+)', 1) AS ps, regexp_extract_all(tail, '(@?[\\w.-]+(?:/[\\w.-]+)?)@(\\^?~?[\\w.\\-]+)', 2) AS vs FROM tail)"""
dd.CTES["npm"] = """SELECT course_id, pkg, arg_min(ver, (-n, seen)) AS ver, count(*) AS versions FROM
  (SELECT course_id, pkg, ver, count(*) AS n, min((stem, t, s)) AS seen FROM spec WHERE ver <> 'latest' GROUP BY course_id, pkg, ver) GROUP BY course_id, pkg"""
_dep = '(?m)^\\s*([a-z][a-z0-9_-]*)\\s*=\\s*"([=^~]?\\d[\\w.\\-]*)"\\s*$'
_tab = '(?m)^\\s*([a-z][a-z0-9_-]*)\\s*=\\s*\\{[^}]*?version\\s*=\\s*"([=^~]?\\d[\\w.\\-]*)"'
dd.CTES["csp"] = union_sql(*[f"SELECT course_id, unnest(regexp_extract_all(code, '{x}', 1)) AS pkg, unnest(regexp_extract_all(code, '{x}', 2)) AS ver FROM bl WHERE lang = 'toml'" for x in (_dep, _tab)])
dd.CTES["cargo"] = """SELECT course_id, pkg, arg_max(ver, (n, list_transform(regexp_extract_all(ver, '\\d+')[1:4], lambda v: CAST(v AS BIGINT)), ver)) AS ver, count(*) AS versions FROM
  (SELECT course_id, pkg, ver, count(*) AS n FROM csp GROUP BY ALL) GROUP BY course_id, pkg"""
add("x05_npm_pins", lambda t, s, sf: npm_pins(t), "SELECT course_id, pkg, ver, versions FROM npm")
add("x05_cargo_pins", lambda t, s, sf: cargo_pins(t), "SELECT course_id, pkg, ver, versions FROM cargo")
add("x05_version_splits", lambda t, s, sf: code.version_splits(npm_pins(t)), "SELECT course_id, pkg, ver, versions FROM npm WHERE versions > 1")
_named = "import\\s+(?:type\\s+)?(?:[A-Za-z_$][\\w$]*\\s*,\\s*)?\\{([^}]*)\\}\\s*from\\s*[''\"]([^''\"]+)[''\"]"
_default = "import\\s+(?:type\\s+)?([A-Za-z_$][\\w$]*)\\s*(?:,\\s*\\{[^}]*\\})?\\s*from\\s*[''\"]([^''\"]+)[''\"]"
dd.CTES["sym"] = f"""SELECT DISTINCT course_id, module, symbol FROM (SELECT course_id, module, trim(split_part(regexp_replace(trim(s), '^type ', ''), ' as ', 1)) AS symbol FROM
  (SELECT course_id, module, unnest(string_split(names, ',')) AS s FROM (SELECT course_id, unnest(regexp_extract_all(code, '{_named}', 1)) AS names, unnest(regexp_extract_all(code, '{_named}', 2)) AS module
   FROM bl WHERE lang = 'typescript'))) WHERE regexp_matches(symbol, '^[A-Za-z_$][\\w$]*$')"""
dd.CTES["def"] = f"""SELECT course_id, symbol, arg_min(module, (stem, n_all, k)) AS module FROM (SELECT course_id, stem, n_all, unnest(regexp_extract_all(code, '{_default}', 1)) AS symbol,
   unnest(regexp_extract_all(code, '{_default}', 2)) AS module, generate_subscripts(regexp_extract_all(code, '{_default}', 1), 1) AS k FROM bl WHERE lang = 'typescript') GROUP BY course_id, symbol"""
add("x06_import_symbols", lambda t, s, sf: code.import_map(blocks(t))[0], "SELECT course_id, module, symbol FROM sym")
add("x06_default_imports", lambda t, s, sf: code.import_map(blocks(t))[1], "SELECT course_id, symbol, module FROM def")
_rust = lambda rx: f"SELECT DISTINCT course_id, unnest(regexp_extract_all(code, '{rx}', 1)) AS c FROM bl WHERE lang = 'rust'"
dd.CTES["cu"] = _rust("(?m)^\\s*use\\s+([a-z]\\w*)\\s*::")
dd.CTES["cp"] = _rust("(?:^|[^\\w:.])([a-z][a-z0-9_]{2,})::")
dd.CTES["cm"] = _rust("(?m)^\\s*(?:pub\\s+)?mod\\s+([a-z]\\w*)\\s*[;{]")
add("x07_needed_crates", lambda t, s, sf: code.needed_crates(blocks(t), cargo_pins(t)),
    """SELECT DISTINCT course_id, c AS crate FROM (SELECT course_id, c FROM cu UNION ALL SELECT course_id, pkg FROM cargo WHERE (course_id, replace(pkg, '-', '_')) IN (SELECT (course_id, c) FROM cp))
       WHERE c NOT IN ('crate', 'self', 'super', 'std', 'core', 'alloc') AND (course_id, c) NOT IN (SELECT (course_id, c) FROM cm) AND (course_id, c) NOT IN (SELECT (course_id, replace(c, '_', '-')) FROM cm)""")
_git = '(?m)^\\s*([a-z][a-z0-9_-]*)\\s*=\\s*\\{[^}]*?git\\s*=\\s*"([^"]+)"([^}]*)\\}'
add("x08_git_sources", lambda t, s, sf: code.harvest_sources(blocks(t), cargo_pins(t))[0],
    f"""SELECT course_id, crate, s.url AS url, s.branch AS branch, s.rev AS rev FROM (SELECT course_id, crate, arg_min({{'url': url, 'branch': branch, 'rev': rev}}, (stem, n_all, k)) AS s FROM
      (SELECT course_id, stem, n_all, k, replace(c, '-v2', '') AS crate, url, nullif(regexp_extract(rest, 'branch\\s*=\\s*"([^"]+)"', 1), '') AS branch,
        nullif(regexp_extract(rest, 'rev\\s*=\\s*"([^"]+)"', 1), '') AS rev FROM (SELECT course_id, stem, n_all, unnest(regexp_extract_all(code, '{_git}', 1)) AS c,
        unnest(regexp_extract_all(code, '{_git}', 2)) AS url, unnest(regexp_extract_all(code, '{_git}', 3)) AS rest, generate_subscripts(regexp_extract_all(code, '{_git}', 1), 1) AS k
        FROM bl WHERE lang = 'toml')) GROUP BY course_id, crate)""")
_tbl = "(?m)^\\s*([a-z][a-z0-9_-]*)\\s*=\\s*\\{([^}]*)\\}"
add("x08_crate_features", lambda t, s, sf: code.harvest_sources(blocks(t), cargo_pins(t))[1],
    f"""SELECT DISTINCT course_id, crate, feature FROM (SELECT course_id, crate, regexp_replace(trim(f), '^["'']+|["'']+$', '', 'g') AS feature FROM
      (SELECT t.course_id, crate, unnest(string_split(regexp_extract(body, 'features\\s*=\\s*\\[([^\\]]*)\\]', 1), ',')) AS f FROM
        (SELECT course_id, unnest(regexp_extract_all(code, '{_tbl}', 1)) AS crate, unnest(regexp_extract_all(code, '{_tbl}', 2)) AS body FROM bl WHERE lang = 'toml') t
        LEFT JOIN cargo c ON c.course_id = t.course_id AND c.pkg = crate
        WHERE c.ver IS NULL OR regexp_extract(body, 'version\\s*=\\s*"([=^~]?\\d[\\w.\\-]*)"', 1) IN ('', c.ver))) WHERE feature <> ''""")


def logs(t: DataFrame) -> DataFrame:
    """Package manager logs, one text per draft."""
    return t.select("course_id", F.expr("CASE WHEN d % 2 = 0 THEN 'cargo' ELSE 'npm' END").alias("tool"), F.expr(LOG_TEXT).alias("text"))


LOG_TEXT = """CASE d % 5 WHEN 0 THEN 'error: no matching package named `pkg-' || d % 40 || '` found' WHEN 1 THEN 'could not find `lib' || d % 30 || '` in registry'
  WHEN 2 THEN 'error: no matching package found' || chr(10) || 'searched package name: `serde-' || d % 20 || '`'
  WHEN 3 THEN 'npm ERR! 404  ' || chr(39) || '@a/p' || d % 20 || '@^1' || chr(39) || ' is not in this registry' ELSE
  'npm error 404  The requested resource ' || chr(39) || 'q' || d % 10 || chr(39) || ' could not be found' END"""
_pkg = """CASE WHEN d % 2 = 0 THEN CASE d % 5 WHEN 0 THEN 'pkg-' || d % 40 WHEN 1 THEN 'lib' || d % 30 WHEN 2 THEN 'serde-' || d % 20 END
  ELSE CASE d % 5 WHEN 3 THEN '@a/p' || d % 20 WHEN 4 THEN 'q' || d % 10 END END"""
add("x09_missing_packages", lambda t, s, sf: code.missing_packages(logs(t)),
    f"SELECT DISTINCT course_id, CASE WHEN d % 2 = 0 THEN 'cargo' ELSE 'npm' END AS tool, {_pkg} AS pkg FROM dr WHERE {_pkg} IS NOT NULL")
dd.CTES["frag"] = """SELECT course_id, stem, n, code, list_concat(regexp_extract_all(code, '\\b(?:const|let|var|function|class|type|interface|enum)\\s+([A-Za-z_$][\\w$]*)', 1),
  list_transform(flatten(list_transform(regexp_extract_all(code, 'import\\s*\\{([^}]*)\\}\\s*from', 1), lambda v: string_split(v, ','))), lambda v: trim(string_split(trim(v), ' as ')[-1]))) AS own
  FROM kd WHERE lang = 'typescript' AND kind = 'fragment'"""
add("x10_fragment_symbols", lambda t, s, sf: longs(code.fragment_symbols(blocks(t), *code.import_map(blocks(t))), "n"),
    """SELECT f.course_id, stem, n, f.symbol, coalesce(def.module, sm.module) AS module, def.module IS NOT NULL AS is_default FROM
       (SELECT DISTINCT course_id, stem, n, symbol FROM (SELECT course_id, stem, n, own, unnest(regexp_extract_all(code, '[A-Za-z_$][\\w$]*')) AS symbol FROM frag) WHERE NOT list_contains(own, symbol)) f
       LEFT JOIN def ON def.course_id = f.course_id AND def.symbol = f.symbol
       LEFT JOIN (SELECT course_id, symbol, min(module) AS module FROM sym GROUP BY ALL) sm ON sm.course_id = f.course_id AND sm.symbol = f.symbol
       WHERE def.module IS NOT NULL OR sm.module IS NOT NULL""")

# Compiler messages by (d, n, seq); 'none' is no message.
MSGS = ["none", "error TS2304: Cannot find name x", "error[E0433]: failed to resolve: y", "error TS1005: ; expected", "error[E0282]: type annotations needed",
        "error[E0308]: mismatched types — expected `__BlockErr`", "error TS7006: implicit any", "error[E0599]: no method", "none", "none"]
MSG = "CASE (d * 3 + n * 5 + seq * 7) % 10 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MSGS)) + " END"
REPLAY = "(d + n) % 3 = 0"
# Only blocks of this language are compiled again, behind the earlier ones of their draft.
RETRIED = "lang = 'typescript' AND n > 1"


def compiled(t: DataFrame) -> DataFrame:
    kinds = code.classify(blocks(t)).filter("kind is not null")
    return kinds.select("course_id", "stem", "lang", "n", "kind", F.expr("CAST(split_part(stem, '-l', 2) AS BIGINT)").alias("d"))


def diagnostics(t: DataFrame) -> DataFrame:
    rows = compiled(t).withColumn("seq", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("msg", F.expr(MSG))
    return rows.filter("msg <> 'none'").select("course_id", "stem", "lang", "n", "seq", "msg")


def verdicts(t: DataFrame) -> DataFrame:
    return code.triage(compiled(t), diagnostics(t))


def upgraded(t: DataFrame) -> DataFrame:
    return code.upgrade(verdicts(t), compiled(t).filter(RETRIED), compiled(t).filter(REPLAY))


def expected(t: DataFrame) -> DataFrame:
    return code.apply_expectations(upgraded(t), code.expectations(t))


_isx = "kind <> 'standalone'"
dd.CTES["cls"] = f"""SELECT *, CASE WHEN {_isx} AND msg LIKE '%TS1005%' THEN 'a' WHEN {_isx} AND msg LIKE '%E0282%' THEN 'f' WHEN msg LIKE '%\\_\\_Block%' ESCAPE '\\' THEN 'b'
    WHEN lang = 'typescript' AND msg LIKE '%TS2304%' OR lang = 'rust' AND msg LIKE '%E0433%' THEN 'e' WHEN lang = 'typescript' AND msg LIKE '%TS7006%' THEN 'd' ELSE 'c' END AS cls
  FROM (SELECT *, {MSG} AS msg FROM (SELECT kd.*, unnest([0, 1, 2]) AS seq FROM kd WHERE kind IS NOT NULL)) WHERE msg <> 'none'"""
dd.CTES["vd"] = """SELECT kd.d, kd.course_id, kd.stem, kd.lang, kd.n, kd.kind, CASE WHEN best IS NULL THEN 'PASS' WHEN best = 'c' THEN 'FAIL' WHEN best = 'd' THEN 'WARN' ELSE 'SKIP' END AS status,
    coalesce(msg, 'compiles') AS detail FROM kd LEFT JOIN (SELECT d, lang, n, min(cls) AS best, arg_min(msg, (cls, seq)) AS msg FROM cls GROUP BY ALL) v ON v.d = kd.d AND v.lang = kd.lang AND v.n = kd.n
  WHERE kind IS NOT NULL"""
dd.CTES["vu"] = f"""SELECT d, course_id, stem, lang, n, kind, CASE WHEN up THEN 'PASS' ELSE status END AS status, CASE WHEN up THEN 'compiles in replay' ELSE detail END AS detail
  FROM (SELECT *, status = 'SKIP' AND {RETRIED} AND NOT ({REPLAY}) AS up FROM vd)"""
add("x11_triage", lambda t, s, sf: longs(verdicts(t), "n"), "SELECT course_id, stem, lang, n, kind, status, detail FROM vd")
add("x12_replay_upgrade", lambda t, s, sf: longs(upgraded(t), "n"), "SELECT course_id, stem, lang, n, kind, status, detail FROM vu")
dd.CTES["mk"] = f"""SELECT *, lag(is_mark) OVER w AS marked, lag(reason) OVER w AS why FROM (SELECT d, course_id, stem, p, regexp_matches(s, '<!-- verify: expect-fail') AS is_mark,
    regexp_extract(s, 'expect-fail (.*?) -->', 1) AS reason, CASE lower({dd.strip_sql('substr(s, 4)')}) WHEN 'ts' THEN 'typescript' WHEN 'tsx' THEN 'typescript' WHEN 'rust' THEN 'rust' END AS lang
  FROM dl WHERE regexp_matches(s, '<!-- verify: expect-fail') OR (starts_with(s, '```') AND s <> '```')) WINDOW w AS (PARTITION BY d ORDER BY p)"""
dd.CTES["ex"] = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY d, lang ORDER BY p) AS n FROM mk WHERE lang IS NOT NULL AND NOT is_mark) WHERE marked"
dd.CTES["ve"] = """SELECT vu.course_id, vu.stem, vu.lang, vu.n, kind, CASE WHEN why IS NULL THEN status WHEN status = 'FAIL' THEN 'EXPECTED' WHEN status = 'PASS' THEN 'FAIL' ELSE status END AS status,
    CASE WHEN why IS NOT NULL AND status IN ('FAIL', 'PASS') THEN why ELSE detail END AS detail FROM vu LEFT JOIN ex ON ex.d = vu.d AND ex.lang = vu.lang AND ex.n = vu.n"""
add("x13_expectations", lambda t, s, sf: longs(code.expectations(t), "n"), "SELECT course_id, stem, lang, n, why AS reason FROM ex")
add("x13_applied", lambda t, s, sf: longs(expected(t), "n"), "SELECT * FROM ve")
add("x14_block_report", lambda t, s, sf: code.block_report(expected(t)),
    "SELECT lang, kind, " + ", ".join(f"count(*) FILTER (status = '{x}') AS \"{x}\"" for x in code.STATUSES) + " FROM ve GROUP BY lang, kind")
_fl = f"list_filter(string_split(code, chr(10)), lambda v: {dd.strip_sql('v')} <> '' AND NOT regexp_matches(v, '^[{dd.SP}]*#'))[1]"
add("x15_cheap_validity", lambda t, s, sf: longs(code.cheap_validity(blocks(t)), "n_all"),
    f"""SELECT course_id, stem, n_all, lang, CASE WHEN lang = 'json' THEN CASE WHEN code <> '' AND json_valid(code) THEN 'PASS' ELSE 'FAIL' END
      WHEN lang = 'python' AND (regexp_matches({_fl}, '^[ \\t]') OR regexp_replace(regexp_extract({_fl}, '(\\S+)', 1), ':+$', '') IN ('return', 'yield', 'elif', 'else', 'except', 'finally')) THEN 'SKIP'
      WHEN lang IN ('rust', 'typescript', 'javascript') THEN 'SKIP' ELSE 'CHECK' END AS status,
      CASE WHEN lang = 'bash' THEN regexp_replace(code, '<[A-Za-z][\\w./-]*>', 'PLACEHOLDER', 'g') ELSE code END AS code FROM bl""")
