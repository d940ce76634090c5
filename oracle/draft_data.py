"""Markdown drafts derived from `documents`: one draft per document.

LINE is scalar SQL over (d = doc_id, i = line number from 1, x = line, y = line before it, z = last line number) that both engines
read alike. All lines stay, as prose. A fence opens after every sixth one, its body takes the place where the next line would stand, and
that line follows once the fence is closed; remainders of d and of the
fence number g plant bad titles, comments, glued and missing closers, pins, imports and broken code.
"""
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.session import spread
from oracle.shared import staged

NL = "chr(10)"


def lit(text: str) -> str:
    """Text with line feeds as SQL. Quotes are doubled; both engines then read the same characters."""
    return f" || {NL} || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n"))


def case(selector: str, values: list[str]) -> str:
    body = " ".join(f"WHEN {n} THEN {v}" for n, v in enumerate(values[:-1]))
    return f"CASE {selector} {body} ELSE {values[-1]} END"


LABEL = case("(g + d) % 8", ["'bash'", "CASE WHEN d % 13 = 0 THEN 'Visual' ELSE 'visual' END", "'python'", "'rust'", "CASE WHEN g % 2 = 0 THEN 'ts' ELSE 'tsx' END",
                             "'toml'", "'json'", "'visual'"])
ALT = case("(d + g) % 5", ["'Image of it'", "x", "'short [x] alt text of some kind with enough words'", "'tiny'", "'A bar per stage shows how the total grows over the ten weeks'"])
VISUAL = (f"'type: ' || {case('(d + g) % 4', [lit('chart'), lit('flowchart'), lit('picture'), lit('chart')])} || {NL} || 'title: Part ' || g || {NL} || 'purpose: show ' "
          f"|| split_part(x, ' ', 1) || {NL} || {lit('data: | a, b')} || {NL} || '  c -- d' || {NL} || 'prompt: draw' || {NL} || 'alt: ' || {ALT}")
BASH = (f"'$ anvil --port ' || length(x) || {NL} || 'npm install @scope/kit@' || (d % 3) || '.' || (length(x) % 4) || ' express@latest left-pad@^1.' || (g % 2) || {NL} || "
        f"CASE WHEN d % 4 = 0 THEN 'foundryup' WHEN d % 4 = 1 THEN 'cargo new demo' ELSE '  # solana confirm <SIGNATURE>' END")
PYTHON = case("d % 4", [lit("def f():\n    return 1  # a — b"), lit("    indented = 1"), lit("# note\nelif x:"), lit("x = 1 – 2")])
RUST = case("(CAST(floor(d / 8) AS INT) + g) % 9", [
    lit("use anchor_lang::prelude::*;\n#[program]\nmod demo { }"), lit("pub owner: Address,\npub bump: u8, // b"), lit("Pending,\nBad(String),"),
    lit("fn check(&self) -> bool {\n    true\n}"), lit("self.count += 1;"), lit("let v = serde_json::to_string(&x)?;\nif v { ... }"),
    lit("use tokio::time;\nmod engine;\nuse engine::run;\npub fn start(a: u8) { }\nfn run_all() -> u8 { clap::get(1) }"), lit("let y = foo(a, {"),
    lit("// only a comment")])
TS = case("(CAST(floor(d / 8) AS INT) + g) % 8", [
    lit("import { address, type Rpc as R } from '@solana/kit';\nexport const a = address('x');"), lit("const b = address(1) + Rpc;\nexpress();"),
    lit("import express from 'express'\nconst list = [1,"), lit("function pay(amount) { return fetch(amount); } // URL"),
    lit("/* URL */\nexport interface A {}\nexport function go() {}"), lit('declare_id("<your key>")'), lit("import x from 'other';\nconst c = (a) => a"),
    lit("import type { Rpc } from 'rpc'\nlet Rpc2 = crypto // x")])
TOML = (f"'[dependencies]' || {NL} || 'clap = \"4.' || (d % 5) || '\"' || {NL} || CASE WHEN d % 3 = 0 THEN 'clap = \"2.33.1\"' ELSE '# none' END || {NL} || "
        f"'serde = {{ version = \"1.0\", features = [\"derive\", \"rc\"] }}' || {NL} || 'tokio = {{ version = \"1.' || (g % 3 + d % 2 * 10) || '\", features = [\"f' || (g % 3) || '\"] }}' || {NL} || "
        f"'anchor-lang-v2 = {{ git = \"https://example.org/' || (d % 3) || '.git\", branch = \"next\" }}'")
JSON = case("CAST(floor(d / 8) AS INT) % 3", [lit('{"a": [1, 2]}'), lit("{a: 1}"), lit("")])
BODY = case("(g + d) % 8", [BASH, VISUAL, PYTHON, RUST, TS, TOML, JSON, VISUAL])
MARK = f"CASE WHEN (g + d) % 8 IN (3, 4) AND g % 2 = 0 THEN '<!-- verify: expect-fail reason ' || g || ' -->' || {NL} ELSE '' END"
PROSE = (f"CASE WHEN (d + i) % 13 = 0 THEN '<!-- only a comment -->' || {NL} || x WHEN (d + i) % 13 = 5 THEN x || ' <!-- open' || {NL} || 'still -->' "
         f"WHEN (d + i) % 13 = 7 THEN x || ' <!-- c --> tail' ELSE CASE WHEN d % 5 = 1 AND i % 6 = 1 THEN '## ' ELSE '' END || replace(x, ', ', ' — ') END "
         f"|| CASE WHEN (d + i) % 3 = 0 THEN {NL} ELSE '' END")
LINE = (f"CASE WHEN i % 6 = 4 THEN x || {NL} || {MARK} || '```' || {LABEL} WHEN i % 6 = 5 THEN {BODY} || CASE WHEN i = z THEN {NL} || x ELSE '' END "
        f"WHEN i % 6 = 0 THEN CASE WHEN d % 17 = 0 AND (g - 1 + d) % 8 IN (1, 7) THEN '``` and so' || {NL} WHEN d % 19 = 3 AND i = 6 THEN '' ELSE '```' || {NL} END "
        f"|| y || {NL} || x ELSE {PROSE} END")
LINE = LINE.replace("(g - 1 + d)", "(CAST(floor((i - 1) / 6) AS INT) + d)")  # a closer belongs to the fence before it


def qualified(sql: str, prefix: str = "p.") -> str:
    """Prefix the names x, y, z, i and g outside string literals."""
    parts = sql.split("'")
    parts[::2] = [re.sub(r"\b([xyzig])\b", rf"{prefix}\1", part) for part in parts[::2]]
    return "'".join(parts)


TITLE = (f"CASE WHEN d % 23 = 5 THEN 'Here is the lesson:' || {NL} WHEN d % 23 = 6 THEN {NL} || '  ' || {NL} ELSE '' END || '# Doc ' || d || {NL}")
STEM = "'m' || lpad(CAST(d % 30 AS STRING), 2, '0') || '-l' || d"


def draft_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text"), "doc_id").select(
        F.col("doc_id").alias("d"), F.col("source").alias("course_id"), F.split("text", "\n", -1).alias("lines"))
    line = qualified(LINE)
    pieces = F.expr("transform(lines, (x, j) -> named_struct('x', x, 'y', coalesce(get(lines, j - 1), ''), 'z', size(lines), 'i', j + 1, 'g', CAST(floor((j + 1) / 6) AS INT)))")
    body = F.expr(f"array_join(transform(pieces, p -> {line}), chr(10))")
    named = docs.select("d", "course_id", pieces.alias("pieces"))
    return named.select("d", "course_id", F.expr(STEM).alias("stem"), F.concat(F.expr(TITLE), body).alias("md"))


def drafts(spark: SparkSession, sf: str) -> DataFrame:
    """drafts(d, course_id, stem, md), staged once per session."""
    return staged(spark, sf, "drafts", lambda: draft_rows(spark, sf))


# ---- the same in DuckDB: drafts, their lines, and three readings of the fences ----------------------

def _duck_line() -> str:
    parts = LINE.split("'")
    for name, value in (("g", "CAST(floor(i / 6) AS INT)"), ("y", "lines[i - 1]"), ("z", "len(lines)")):
        parts[::2] = [re.sub(rf"\b{name}\b", value, part) for part in parts[::2]]
    return "'".join(parts)


# Every space character but the line feed, as RE2 writes it.
SP = r"\t\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip_sql(c: str) -> str:
    return rf"regexp_replace({c}, '\A[\n{SP}]+|[\n{SP}]+\z', '', 'g')"


def words_sql(c: str) -> str:
    return rf"len(regexp_extract_all({c}, '[^\n{SP}]+'))"


def _roles(opens: str) -> str:
    """One letter per fence, found by walking the fences in order: o opens, c closes, - is ignored."""
    return f"list_reduce(kinds, lambda acc, t: acc || CASE WHEN ends_with(acc, 'o') THEN 'c' WHEN {opens} THEN 'o' ELSE '-' END, '')"


VISUAL_KINDS = "('flowchart', 'diagram', 'chart', 'table', 'comparison', 'annotated-code', 'timeline')"

CTES = {
    "dr": f"""SELECT d, course_id, {STEM} AS stem, {TITLE} || array_to_string(list_transform(lines, lambda x, i: {_duck_line()}), chr(10)) AS md
              FROM (SELECT doc_id AS d, source AS course_id, string_split(text, chr(10)) AS lines FROM documents)""",
    "dl": f"""SELECT *, {strip_sql('line')} AS s FROM (SELECT d, course_id, stem, unnest(string_split(md, chr(10))) AS line,
              generate_subscripts(string_split(md, chr(10)), 1) AS p FROM dr)""",
    "df": """SELECT *, starts_with(s, '```') AS is_f, sum(CASE WHEN starts_with(s, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY d ORDER BY p) AS fn FROM dl""",
    "fen": f"SELECT d, fn, s, {strip_sql('substr(s, 4)')} AS label FROM df WHERE is_f",
    "dx": "SELECT df.d, course_id, stem, line, p, df.s, fn, fn % 2 = 1 AS inside, lower(label) AS low_label FROM df LEFT JOIN fen USING (d, fn) WHERE NOT is_f",
    "tok": f"""SELECT d, {_roles("true")} AS toggles, {_roles("t <> '```'")} AS tagged, {_roles("t = '```visual'")} AS visuals
               FROM (SELECT d, list(s ORDER BY fn) AS kinds FROM fen GROUP BY d)""",
    "body": "SELECT d, fn, string_agg(line, chr(10) ORDER BY p) AS code FROM df WHERE NOT is_f GROUP BY ALL",
    "vis": """SELECT fen.d, fn, row_number() OVER (PARTITION BY fen.d ORDER BY fn) AS n, coalesce(code, '') AS code,
                (SELECT f2.s FROM fen f2 WHERE f2.d = fen.d AND f2.fn = fen.fn + 1) AS closer
              FROM fen JOIN tok USING (d) LEFT JOIN body USING (d, fn) WHERE substr(visuals, CAST(fn AS BIGINT), 1) = 'o'""",
    # A field line starts a field, the lines after it continue it; the last mention of a name counts.
    "vln": f"""SELECT d, n, p, {strip_sql('line')} AS s, regexp_extract(line, '^([a-z_]+):', 1) AS name, regexp_replace(line, '^[a-z_]+:', '') AS rest,
                sum(CASE WHEN regexp_matches(line, '^[a-z_]+:') THEN 1 ELSE 0 END) OVER (PARTITION BY d, n ORDER BY p) AS f
              FROM (SELECT d, n, unnest(string_split(code, chr(10))) AS line, generate_subscripts(string_split(code, chr(10)), 1) AS p FROM vis)""",
    "vfl": f"""SELECT d, n, f, max(name) AS name, {strip_sql("string_agg(v, ' ' ORDER BY p) FILTER (v <> '')")} AS value FROM
              (SELECT *, CASE WHEN name <> '' THEN {strip_sql("regexp_replace(" + strip_sql('rest') + ", '^[|]+', '')")} ELSE s END AS v FROM vln WHERE f > 0) GROUP BY d, n, f""",
    "vf": "SELECT d, n, " + ", ".join(f"coalesce(arg_max(value, f) FILTER (name = '{k}'), '') AS v_{k}" for k in ("type", "title", "purpose", "data", "prompt", "alt"))
          + " FROM (SELECT d, n FROM vis) LEFT JOIN vfl USING (d, n) GROUP BY d, n",
    "vv": f"""SELECT vf.*, dr.course_id, dr.stem, v_type IN {VISUAL_KINDS} AND v_title <> '' AND v_purpose <> '' AND v_data <> '' AND v_prompt <> '' AND v_alt <> '' AS valid
              FROM vf JOIN dr USING (d)""",
    "wl": f"SELECT d, fn, sum({words_sql('line')}) AS w, max(p) AS last_p FROM dx WHERE NOT inside GROUP BY d, fn",
    "wr": "SELECT *, sum(w) OVER (PARTITION BY d ORDER BY fn) AS upto FROM wl",
    "met": """SELECT dr.d, course_id, stem, CAST(coalesce(sum(w), 0) AS BIGINT) AS prose_words, CAST(coalesce(max(w), 0) AS BIGINT) AS longest_wall,
                coalesce(CASE WHEN max(w) > 0 THEN arg_max(last_p, (w, -fn)) END, 0) AS wall_end_line,
                CAST((SELECT coalesce(min(up), 0) FROM (SELECT f.fn, (SELECT coalesce(sum(b.w), 0) FROM wl b WHERE b.d = f.d AND b.fn < f.fn) AS up FROM fen f
                   WHERE f.d = dr.d AND f.fn % 2 = 1 AND f.label <> 'visual' ORDER BY f.fn LIMIT 1)) AS BIGINT) AS code0,
                EXISTS (SELECT 1 FROM fen f WHERE f.d = dr.d AND f.fn % 2 = 1 AND f.label <> 'visual') AS has_code,
                CAST((SELECT coalesce(sum(b.w), 0) FROM wl b WHERE b.d = dr.d AND b.fn = 0) AS BIGINT) AS fence0,
                EXISTS (SELECT 1 FROM fen f WHERE f.d = dr.d) AS has_fence
              FROM dr LEFT JOIN wl USING (d) GROUP BY dr.d, course_id, stem""",
    "vc": "SELECT d, count(*) AS blocks, count(*) FILTER (valid) AS valid, string_agg(DISTINCT v_type, ',' ORDER BY v_type) FILTER (valid) AS types FROM vv GROUP BY d",
    "m": """SELECT met.*, CASE WHEN has_code THEN code0 END AS first_code_words, CASE WHEN has_fence THEN fence0 END AS first_fence_words,
              coalesce(blocks, 0) AS visual_blocks, coalesce(valid, 0) AS visual_valid, coalesce(types, '') AS visual_types FROM met LEFT JOIN vc USING (d)""",
    "dc": """SELECT d, CAST(coalesce(sum(len(regexp_extract_all(line, '—|–| -- '))), 0) AS BIGINT) AS dashes FROM dr LEFT JOIN dx USING (d)
             WHERE inside IS NULL OR NOT inside OR low_label = 'visual' GROUP BY d""",
    "bl": """SELECT d, course_id, stem, info, code, lang, row_number() OVER (PARTITION BY d ORDER BY fn) AS n_all, row_number() OVER (PARTITION BY d, lang ORDER BY fn) AS n FROM (
               SELECT fen.d, fn, lower(label) AS info, coalesce(code, '') AS code, CASE WHEN lower(label) IN ('py', 'python') THEN 'python'
                 WHEN lower(label) IN ('sh', 'bash', 'shell', 'console') THEN 'bash' WHEN lower(label) IN ('rs', 'rust') THEN 'rust'
                 WHEN lower(label) IN ('ts', 'tsx', 'typescript') THEN 'typescript' WHEN lower(label) IN ('toml', 'json') THEN lower(label) END AS lang
               FROM fen JOIN tok USING (d) LEFT JOIN body USING (d, fn) WHERE substr(tagged, CAST(fn AS BIGINT), 1) = 'o') JOIN dr USING (d) WHERE lang IS NOT NULL""",
}
