"""Fenced code blocks: inventory, classification, dependency pins, imports, triage of compiler output."""
from pyspark.sql import Column, DataFrame, functions as F

from lectern import vocab
from lectern.functions import fences as fn
from lectern.functions.text import SPACE, is_blank, is_json, strip, version_key

BLOCK = ["course_id", "stem", "lang", "n"]


def extract_blocks(drafts: DataFrame) -> DataFrame:
    """blocks(course_id, stem, n_all, lang, n, info, code): n counts per language, n_all over all."""
    langs = F.create_map(*[F.lit(x) for pair in vocab.FENCE_LANGS.items() for x in pair])
    tagged = F.transform(fn.blocks(F.col("md"), fn.TAGGED_BLOCK), lambda b: F.struct(
        F.try_element_at(langs, b["info"]).alias("lang"), b["info"].alias("info"), b["body"].alias("code")))
    known = drafts.select("course_id", "stem", F.filter(tagged, lambda b: b["lang"].isNotNull()).alias("blocks"))
    numbered = F.transform("blocks", lambda b, i: F.struct(
        (i + 1).alias("n_all"), b["lang"].alias("lang"),
        F.size(F.filter(F.slice("blocks", 1, i + 1), lambda x: x["lang"] == b["lang"])).alias("n"),
        b["info"].alias("info"), b["code"].alias("code")))
    return known.select("course_id", "stem", F.explode_outer(numbered).alias("b")).filter("b is not null").select("course_id", "stem", "b.*")


# ---- classification ----------------------------------------------------------------------------

# What a block looks like.
TS_OPEN_END = r"(?:,|\+|&&|\|\||=>|\(|\[)\s*\z"
TS_MODULE = r"(?m)^\s*(import|export)\s"
RUST_STANDALONE = r"(?m)^\s*(use\s+anchor_lang|declare_id!|fn\s+main\s*\()"
RUST_FIELD = r"^\s*(?:pub\s+)?\w+\s*:\s*[^;=]+,\s*(?://.*)?$"
RUST_VARIANT = r"^\s*[A-Z]\w*(\s*\((?:[^()]|\([^()]*\))*\))?(\s*\{[^{}]*\})?\s*,\s*(?://.*)?$"
RUST_ITEM = (r"\A(pub\s+(struct|enum|fn|mod|const|static|type|trait|use)|struct\s|enum\s|impl\s"
             r"|trait\s|fn\s|mod\s|use\s|const\s|static\s|type\s)")
RUST_BARE_FN = r"\A(pub(\([^)]*\))?\s+)?fn\s"
RUST_SELF_FN = r"fn\s+\w+\s*(<[^>]*>)?\s*\([^)]*\bself\b"


def classify_ts(code: Column) -> Column:
    return (F.when(code.rlike(TS_OPEN_END), "fragment").when(code.rlike(TS_MODULE), "standalone")
            .otherwise("fragment"))


def classify_rust(code: Column) -> Column:
    lines = F.filter(F.split(code, "\n", -1), lambda x: ~is_blank(x) & ~x.rlike(r"^\s*(//|#\[)"))
    first = F.regexp_replace(F.get(lines, F.lit(0)), r"\A\s+", "")
    item = first.rlike(RUST_ITEM) | code.rlike(r"\A\s*#\[")
    orphan_method = first.rlike(RUST_BARE_FN) & code.rlike(RUST_SELF_FN) & ~code.rlike(r"\bimpl\b")
    return (F.when(code.rlike(RUST_STANDALONE), "standalone")
            .when(F.size(lines) == 0, "body")
            .when(F.forall(lines, lambda x: x.rlike(RUST_FIELD)), "fields")
            .when(F.forall(lines, lambda x: x.rlike(RUST_VARIANT)), "variants")
            .when(item & orphan_method, "assoc").when(item, "item")
            .when(code.rlike(r"\bself\b"), "method").otherwise("body"))


def classify(blocks: DataFrame) -> DataFrame:
    """kind for TypeScript and Rust blocks, null for other languages."""
    return blocks.withColumn("kind", F.when(F.col("lang") == "typescript", classify_ts(F.col("code")))
                             .when(F.col("lang") == "rust", classify_rust(F.col("code"))))


PLACEHOLDER = r"""["'][^"'\n]*<[^"'>\n]+>[^"'\n]*["']"""
ELLIPSIS_HOLE = r"[\{\[]\s*\.\.\.\s*[\}\]]"


def by_design_skip(blocks: DataFrame) -> DataFrame:
    """Blocks that cannot compile by design, with the first reason that applies."""
    code = F.col("code")

    def count(ch):
        return F.length(code) - F.length(F.replace(code, F.lit(ch), F.lit("")))

    reason = (F.when(code.rlike(PLACEHOLDER), "placeholder").when(code.rlike(ELLIPSIS_HOLE), "ellipsis")
              .when(count("{") != count("}"), "braces").when(count("(") != count(")"), "parens")
              .when(count("[") != count("]"), "brackets"))
    return blocks.select(*BLOCK, reason.alias("reason")).filter("reason is not null")


def cheap_validity(blocks: DataFrame) -> DataFrame:
    """Checks that need no toolchain: JSON parses, Python and Solidity fragments, shell placeholders."""
    code = F.col("code")
    first = F.get(F.filter(F.split(code, "\n", -1), lambda x: ~is_blank(x) & ~x.rlike(rf"^[{SPACE}]*#")), F.lit(0))
    word = F.regexp_replace(F.regexp_extract(first, r"(\S+)", 1), r":+\z", "")
    py_fragment = first.rlike(r"^[ \t]") | word.isin("return", "yield", "elif", "else", "except", "finally")
    lang = F.col("lang")
    status = (F.when(lang == "json", F.when(is_json(code), "PASS").otherwise("FAIL"))
              .when((lang == "python") & F.coalesce(py_fragment, F.lit(False)), "SKIP")
              .when((lang == "solidity") & ~code.rlike("contract |library |interface "), "SKIP")
              .when(lang.isin("rust", "typescript", "javascript"), "SKIP").otherwise("CHECK"))
    runnable = F.when(lang == "bash", F.regexp_replace(code, r"<[A-Za-z][\w./-]*>", "PLACEHOLDER")).otherwise(code)
    return blocks.select("course_id", "stem", "n_all", "lang", status.alias("status"), runnable.alias("code"))


# ---- dependency pins ----------------------------------------------------------------------------

# How versions are written.
NPM_INSTALL = r"\b(?:npm|pnpm|yarn)\s+(?:i|install|add)\b([^\n`]*)"
NPM_SPEC = r"(@?[\w.-]+(?:/[\w.-]+)?)@(\^?~?[\w.\-]+)"
CARGO_DEP = r"""(?m)^\s*([a-z][a-z0-9_-]*)\s*=\s*"([=^~]?\d[\w.\-]*)"\s*$"""
CARGO_DEP_TABLE = r"""(?m)^\s*([a-z][a-z0-9_-]*)\s*=\s*\{[^}]*?version\s*=\s*"([=^~]?\d[\w.\-]*)\""""
CARGO_GIT = r"""(?m)^\s*([a-z][a-z0-9_-]*)\s*=\s*\{[^}]*?git\s*=\s*"([^"]+)"([^}]*)\}"""
CARGO_TABLE = r"(?m)^\s*([a-z][a-z0-9_-]*)\s*=\s*\{([^}]*)\}"


def _pairs(text: Column, pattern: str, *names: str) -> Column:
    cols = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    return F.arrays_zip(*cols)


def npm_specs(drafts: DataFrame) -> DataFrame:
    """One row per spec typed after an install command, with its place in the course."""
    tails = F.regexp_extract_all("md", F.lit(NPM_INSTALL), F.lit(1))
    tailed = drafts.select("course_id", "stem", F.posexplode(tails).alias("t", "tail"))
    return (tailed.select("course_id", "stem", "t", F.posexplode(_pairs(F.col("tail"), NPM_SPEC, "pkg", "ver")).alias("s", "p"))
            .select("course_id", F.struct("stem", "t", "s").alias("seen"), "p.pkg", "p.ver").filter("ver <> 'latest'"))


def cargo_specs(blocks: DataFrame) -> DataFrame:
    toml = blocks.filter("lang = 'toml'")
    both = F.concat(_pairs(F.col("code"), CARGO_DEP, "pkg", "ver"), _pairs(F.col("code"), CARGO_DEP_TABLE, "pkg", "ver"))
    return toml.select("course_id", F.explode(both).alias("p")).select("course_id", "p.pkg", "p.ver")


def harvest_pins(specs: DataFrame, eco: str) -> DataFrame:
    """pins(course_id, pkg, ver, versions): the most taught version. Ties: npm first seen, cargo higher."""
    if eco == "npm":
        counted = specs.groupBy("course_id", "pkg", "ver").agg(F.count("*").alias("n"), F.min("seen").alias("seen"))
        best = F.min_by("ver", F.struct(-F.col("n"), F.col("seen")))
    else:
        counted = specs.groupBy("course_id", "pkg", "ver").agg(F.count("*").alias("n"))
        best = F.max_by("ver", F.struct(F.col("n"), version_key(F.col("ver")), F.col("ver")))
    return counted.groupBy("course_id", "pkg").agg(best.alias("ver"), F.count("*").alias("versions"))


def version_splits(pins: DataFrame) -> DataFrame:
    return pins.filter("versions > 1").select("course_id", "pkg", "ver", "versions")


def _seen():
    return F.struct("stem", "n_all", "i")


def harvest_sources(blocks: DataFrame, pins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """git(course_id, crate, url, branch, rev), first seen wins; features(course_id, crate, feature)."""
    toml = blocks.filter("lang = 'toml'")
    git = toml.select("course_id", "stem", "n_all", F.posexplode(_pairs(F.col("code"), CARGO_GIT, "crate", "url", "rest")).alias("i", "g"))

    def quoted(name):
        return F.nullif(F.regexp_extract("g.rest", rf'{name}\s*=\s*"([^"]+)"', 1), F.lit(""))

    sources = (git.select("course_id", F.replace("g.crate", F.lit("-v2"), F.lit("")).alias("crate"), _seen().alias("seen"),
                          F.struct("g.url", quoted("branch").alias("branch"), quoted("rev").alias("rev")).alias("src"))
               .groupBy("course_id", "crate").agg(F.min_by("src", "seen").alias("src")).select("course_id", "crate", "src.*"))
    tables = toml.select("course_id", F.explode(_pairs(F.col("code"), CARGO_TABLE, "crate", "body")).alias("t"))
    listed = tables.select(
        "course_id", F.col("t.crate").alias("crate"),
        F.nullif(F.regexp_extract("t.body", r'version\s*=\s*"([=^~]?\d[\w.\-]*)"', 1), F.lit("")).alias("said"),
        F.split(F.regexp_extract("t.body", r"features\s*=\s*\[([^\]]*)\]", 1), ",", -1).alias("names"))
    winning = listed.join(pins.select("course_id", F.col("pkg").alias("crate"), F.col("ver").alias("pinned")),
                          ["course_id", "crate"], "left").filter("pinned is null or said is null or said = pinned")
    feature = F.regexp_replace(strip(F.col("f")), r"""\A["']+|["']+\z""", "")
    features = (winning.select("course_id", "crate", F.explode("names").alias("f"))
                .filter(~F.startswith(strip(F.col("f")), F.lit("#")))
                .select("course_id", "crate", feature.alias("feature")).filter("feature <> ''").distinct())
    return sources, features


# ---- imports --------------------------------------------------------------------------------------

TS_NAMED_IMPORT = (r"import\s+(?:type\s+)?(?:[A-Za-z_$][\w$]*\s*,\s*)?\{([^}]*)\}\s*from\s*['\"]([^'\"]+)['\"]")
TS_DEFAULT_IMPORT = (r"import\s+(?:type\s+)?([A-Za-z_$][\w$]*)\s*(?:,\s*\{[^}]*\})?\s*from\s*['\"]([^'\"]+)['\"]")
TS_DECLARED = r"\b(?:const|let|var|function|class|type|interface|enum)\s+([A-Za-z_$][\w$]*)"
TS_NAME = r"[A-Za-z_$][\w$]*"


def import_map(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """symbols(course_id, module, symbol) and defaults(course_id, symbol, module), first seen wins."""
    ts = blocks.filter("lang = 'typescript'")
    named = ts.select("course_id", F.explode(_pairs(F.col("code"), TS_NAMED_IMPORT, "names", "module")).alias("p"))
    symbol = strip(F.split_part(F.regexp_replace(strip(F.col("s")), r"\Atype ", ""), F.lit(" as "), F.lit(1)))
    symbols = (named.select("course_id", "p.module", F.explode(F.split("p.names", ",", -1)).alias("s"))
               .select("course_id", "module", symbol.alias("symbol")).filter(F.col("symbol").rlike(rf"\A{TS_NAME}\n?\z"))
               .distinct())
    default = ts.select("course_id", "stem", "n_all", F.posexplode(_pairs(F.col("code"), TS_DEFAULT_IMPORT, "symbol", "module")).alias("i", "p"))
    defaults = (default.groupBy("course_id", F.col("p.symbol").alias("symbol"))
                .agg(F.min_by(F.col("p.module"), _seen()).alias("module")))
    return symbols, defaults


def fragment_symbols(blocks: DataFrame, symbols: DataFrame, defaults: DataFrame) -> DataFrame:
    """Names a TypeScript fragment uses without declaring or importing them, and where they come from."""
    fragments = classify(blocks.filter("lang = 'typescript'")).filter("kind = 'fragment'")
    imported = F.transform(F.flatten(F.transform(
        F.regexp_extract_all("code", F.lit(r"import\s*\{([^}]*)\}\s*from"), F.lit(1)), lambda s: F.split(s, ",", -1))),
        lambda s: strip(F.element_at(F.split(strip(s), " as ", -1), -1)))
    own = F.concat(F.regexp_extract_all("code", F.lit(TS_DECLARED), F.lit(1)), imported)
    used = F.array_except(F.regexp_extract_all("code", F.lit(TS_NAME), F.lit(0)), own)
    names = fragments.select("course_id", "stem", "n", F.explode(used).alias("symbol"))
    # A default import wins; else the first module by name.
    known = (defaults.select("course_id", "symbol", F.struct(F.lit(0).alias("rank"), "module").alias("origin"))
             .unionByName(symbols.select("course_id", "symbol", F.struct(F.lit(1).alias("rank"), "module").alias("origin")))
             .groupBy("course_id", "symbol").agg(F.min("origin").alias("origin")))
    return names.join(known, ["course_id", "symbol"]).select(
        "course_id", "stem", "n", "symbol", "origin.module", (F.col("origin.rank") == 0).alias("is_default"))


def needed_crates(blocks: DataFrame, pins: DataFrame) -> DataFrame:
    """Imported crates, and taught crates called by path, without std paths and the reader's own modules."""
    rust = blocks.filter("lang = 'rust'")

    def found(pattern):
        return (rust.select("course_id", F.explode(F.array_distinct(F.regexp_extract_all("code", F.lit(pattern), F.lit(1))))
                            .alias("crate")).distinct())

    used = found(r"(?m)^\s*use\s+([a-z]\w*)\s*::")
    paths = found(r"(?<![\w:.])([a-z][a-z0-9_]{2,})::").withColumnRenamed("crate", "path")
    local = found(r"(?m)^\s*(?:pub\s+)?mod\s+([a-z]\w*)\s*[;{]")
    taught = (pins.select("course_id", F.col("pkg").alias("crate"), F.replace("pkg", F.lit("-"), F.lit("_")).alias("path"))
              .join(paths, ["course_id", "path"], "left_semi").select("course_id", "crate"))
    own = local.unionByName(local.withColumn("crate", F.replace("crate", F.lit("_"), F.lit("-")))).distinct()
    return (used.unionByName(taught).distinct().filter(~F.col("crate").isin(vocab.RUST_NOT_CRATES))
            .join(own, ["course_id", "crate"], "left_anti"))


# How package managers name what they could not find.
MISSING_PATTERNS = {
    "cargo": [r"no matching package (?:named )?`([^`]+)`", r"could not find `([^`]+)` in registry",
              r"no matching package found\s*\n\s*searched package name:\s*`?([^`\s]+)`?"],
    "npm": [r"404\s+'(\S+)' is not in this registry", r"404\s+The requested resource '(\S+)' could not be found"],
}


def missing_packages(logs: DataFrame) -> DataFrame:
    """logs(course_id, tool, text) -> missing(course_id, tool, pkg); an npm spec loses its version."""
    rows = []
    for tool, patterns in MISSING_PATTERNS.items():
        names = F.flatten(F.array(*[F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in patterns]))
        rows.append(logs.filter(F.col("tool") == tool).select("course_id", "tool", F.explode(names).alias("pkg")))
    bare = F.regexp_replace("pkg", r"(?<=.)@[^@]*\z", "")
    both = rows[0].unionByName(rows[1].withColumn("pkg", bare))
    return both.filter("pkg <> ''").distinct()


# ---- verdicts: verdict(course_id, stem, lang, n, kind, status, detail) ----------------------------

def triage(blocks: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """blocks(…, kind), diagnostics(course_id, stem, lang, n, seq, msg).

    A block fails only on a message that is neither missing context, nor about the wrapper this kind of
    block was compiled in, nor a setting the course never claimed.
    """
    msg, standalone = F.col("msg"), F.col("kind") == "standalone"
    unresolved = F.when(F.col("lang") == "typescript", msg.rlike(vocab.TS_UNRESOLVED)).otherwise(msg.rlike(vocab.RUST_UNRESOLVED))
    advisory = (F.col("lang") == "typescript") & msg.rlike(vocab.TS_ADVISORY)
    marked = (diagnostics.join(blocks.select(*BLOCK, "kind"), BLOCK)
              .withColumn("cls", F.when(~standalone & msg.rlike(vocab.SYNTAX_ERROR), "syntax")
                          .when(~standalone & msg.rlike(vocab.WRAPPED_INFERENCE), "inference")
                          .when(F.contains("msg", F.lit(vocab.WRAPPER_NAME)), "wrapper")
                          .when(unresolved, "unresolved").when(advisory, "advisory").otherwise("real")))
    order = ["syntax", "wrapper", "real", "advisory", "unresolved", "inference"]
    first = {c: F.min_by(F.when(F.col("cls") == c, msg), F.when(F.col("cls") == c, F.col("seq"))).alias(c) for c in order}
    per_block = marked.groupBy(*BLOCK).agg(*first.values())
    status = (F.when(F.coalesce(*order).isNull(), "PASS").when(F.coalesce("syntax", "wrapper").isNotNull(), "SKIP")
              .when(F.col("real").isNotNull(), "FAIL").when(F.col("advisory").isNotNull(), "WARN").otherwise("SKIP"))
    return (blocks.select(*BLOCK, "kind").join(per_block, BLOCK, "left")
            .select(*BLOCK, "kind", status.alias("status"), F.coalesce(*order, F.lit("compiles")).alias("detail")))


def upgrade(verdicts: DataFrame, retried: DataFrame, diagnostics2: DataFrame) -> DataFrame:
    """Second pass with the draft's earlier blocks in front: a block of retried (course_id, stem, lang, n) that gave no message
    goes from SKIP to PASS. Nothing else moves; a block that was not compiled again, as in languages without replay, stays."""
    dirty = diagnostics2.select(*BLOCK).distinct()
    clean = retried.select(*BLOCK).distinct().join(dirty, BLOCK, "left_anti").withColumn("clean", F.lit(True))
    lifted = (F.col("status") == "SKIP") & F.col("clean").isNotNull()
    return (verdicts.join(clean, BLOCK, "left")
            .select(*BLOCK, "kind", F.when(lifted, "PASS").otherwise(F.col("status")).alias("status"),
                    F.when(lifted, "compiles in replay").otherwise(F.col("detail")).alias("detail")))


MARKER = r"(?i:<!--\s*verify:\s*expect-fail\s*([^\n]*?)\s*-->)"


def expectations(drafts: DataFrame, tags: dict[str, list[str]] | None = None) -> DataFrame:
    """expect(course_id, stem, lang, n, reason): a marker speaks for the next tagged fence only."""
    tags = tags or {"typescript": ["typescript", "ts", "tsx"], "rust": ["rust", "rs"]}
    token = rf"(?dm)^[^\n]*{MARKER}[^\n]*|^[{SPACE}]*```[^\n]*[^{SPACE}\n][^\n]*"
    tokens = F.transform(F.regexp_extract_all("md", F.lit(token), F.lit(0)), lambda t: F.struct(
        t.rlike(MARKER).alias("is_mark"), F.regexp_extract(t, MARKER, 1).alias("reason"),
        F.lower(fn.label(strip(t))).alias("info")))
    lang = F.create_map(*[F.lit(x) for l, infos in tags.items() for i in infos for x in (i, l)])
    typed = F.transform("tokens", lambda t: F.struct(
        t["is_mark"].alias("is_mark"), t["reason"].alias("reason"),
        F.when(~t["is_mark"], F.try_element_at(lang, t["info"])).alias("lang")))
    numbered = F.transform("typed", lambda t, i: F.struct(
        t["lang"].alias("lang"), F.size(F.filter(F.slice("typed", 1, i + 1), lambda x: x["lang"] == t["lang"])).alias("n"),
        F.when(i > 0, F.get("typed", i - 1)["is_mark"]).alias("marked"),
        F.when(i > 0, F.get("typed", i - 1)["reason"]).alias("reason")))
    rows = (drafts.select("course_id", "stem", tokens.alias("tokens")).select("course_id", "stem", typed.alias("typed"))
            .select("course_id", "stem", F.explode_outer(numbered).alias("x")).select("course_id", "stem", "x.*"))
    return (rows.filter("lang is not null and marked")
            .select(*BLOCK, F.coalesce(F.nullif("reason", F.lit("")), F.lit("declared expect-fail")).alias("reason")))


def apply_expectations(verdicts: DataFrame, expect: DataFrame) -> DataFrame:
    status = (F.when(F.col("reason").isNull(), F.col("status")).when(F.col("status") == "FAIL", "EXPECTED")
              .when(F.col("status") == "PASS", "FAIL").otherwise(F.col("status")))
    moved = F.col("reason").isNotNull() & F.col("status").isin("FAIL", "PASS")
    return (verdicts.join(expect, BLOCK, "left")
            .select(*BLOCK, "kind", status.alias("status"), F.when(moved, F.col("reason")).otherwise(F.col("detail")).alias("detail")))


STATUSES = ["PASS", "FAIL", "WARN", "SKIP", "EXPECTED"]


def block_report(verdicts: DataFrame) -> DataFrame:
    return (verdicts.groupBy("lang", "kind").pivot("status", STATUSES).count().na.fill(0, STATUSES))
