"""Coding challenges: challenges(course_id, lesson_id, pos, challenge_id, language, buildType, starter, …)."""
from pyspark.sql import DataFrame, functions as F

from lectern import vocab
from lectern.functions.text import KEBAB, is_blank, is_json, present, strip
from lectern.operators.flags import ADVISORY, HARD, emit, finding, flag, union

FILES = ["starter", "solution", "tests"]


def _where():
    return F.concat_ws("/", "lesson_id", F.coalesce(F.nullif(strip(F.col("challenge_id")), F.lit("")), F.col("pos").cast("string")))


def _identity():
    cid, build, lang = strip(F.coalesce("challenge_id", F.lit(""))), F.coalesce("buildType", F.lit("standard")), F.col("language")
    return [
        finding(cid == "", "challenge_without_id", HARD, _where()),
        finding((cid != "") & ~cid.rlike(KEBAB), "bad_challenge_id", HARD, _where()),
        finding(~F.coalesce(lang.isin(vocab.CHALLENGE_LANGS), F.lit(False)), "bad_language", HARD, _where(), lang),
        finding(~build.isin(vocab.BUILD_TYPES), "bad_build_type", HARD, _where(), build)]


def _gaps():
    not_rust = (F.col("buildType") == "buildable") & ~F.col("language").eqNullSafe("rust")
    no_criteria = F.coalesce(F.size("acceptance_criteria"), F.lit(0)) <= 0
    return [finding(not_rust, "buildable_not_rust", ADVISORY, _where(), F.col("language")),
            *[finding(is_blank(F.col(f)), "missing_reference", HARD, _where(), f) for f in FILES],
            finding(no_criteria, "no_acceptance_criteria", ADVISORY, _where())]


def duplicate_challenges(challenges: DataFrame) -> DataFrame:
    named = challenges.select("course_id", "lesson_id", strip(F.coalesce("challenge_id", F.lit(""))).alias("_id"))
    twice = (named.filter((F.col("_id") != "") & F.col("_id").rlike(KEBAB)).groupBy("course_id", "lesson_id", "_id")
             .agg(F.count("*").alias("n")).filter("n > 1"))
    return flag(twice, "briefs", "duplicate_challenge", HARD, F.concat_ws("/", "lesson_id", "_id"))


def bad_challenge(challenges: DataFrame) -> DataFrame:
    return union(emit(challenges, "briefs", *_identity()), duplicate_challenges(challenges))


def incomplete_challenge(challenges: DataFrame) -> DataFrame:
    return emit(challenges, "briefs", *_gaps())


def _references(challenges: DataFrame) -> DataFrame:
    refs = challenges.select("course_id", "lesson_id", "challenge_id", "pos", F.explode(F.array(*[
        F.struct(F.lit(f).alias("role"), strip(F.coalesce(F.col(f), F.lit(""))).alias("path")) for f in FILES])).alias("r"))
    return refs.select("course_id", "lesson_id", "challenge_id", "pos", "r.role", "r.path").filter("path <> ''")


def missing_files(challenges: DataFrame, files: DataFrame) -> DataFrame:
    """files(course_id, path), relative to the course."""
    lost = _references(challenges).join(files.select("course_id", "path").distinct(), ["course_id", "path"], "left_anti")
    return flag(lost, "challenges", "missing_file", HARD, _where(), F.concat_ws(":", "role", "path"))


def bad_tests(challenges: DataFrame, test_files: DataFrame) -> DataFrame:
    """test_files(course_id, path, value)"""
    cases = F.from_json("value", "ARRAY<MAP<STRING, STRING>>")
    is_array = F.col("value").rlike(r"\A\s*\[") & ~F.col("value").rlike(r"\A\s*\[\s*\]\s*\z")
    incomplete = F.exists("cases", lambda c: ~F.coalesce(
        F.map_contains_key(c, "id") & F.map_contains_key(c, "expectedOutput"), F.lit(False)))
    rule = (F.when(~is_json(F.col("value")), "tests_not_json").when(~is_array, "tests_not_array")
            .when(F.coalesce(incomplete, F.lit(True)), "test_incomplete"))
    judged = test_files.withColumn("cases", cases).withColumn("found", rule).filter("found is not null")
    used = _references(challenges).filter("role = 'tests'")
    return flag(used.join(judged, ["course_id", "path"]), "challenges", "bad_tests", HARD, _where(), F.col("found"))


def sandbox_lint(sources: DataFrame) -> DataFrame:
    """sources(course_id, source, code) -> first offence of each of two kinds: (…, kind, line, name)."""
    import_from = r"""^import\s*(?:\{[^}]+\}|\w+)\s*from\s*['"]([^'"]+)['"]"""

    def module_rule(raw, i):
        s = F.regexp_replace(raw, r"^\s+", "")
        module = F.regexp_extract(s, import_from, 1)
        value_export = F.startswith(s, F.lit("export ")) & ~s.rlike(r"^export\s+(interface|type)\b")
        foreign = F.startswith(s, F.lit("import")) & (module != vocab.SANDBOX_MODULE)
        return F.when(value_export, F.struct((i + 1).alias("line"), F.lit("export").alias("name"))).when(
            foreign, F.struct((i + 1).alias("line"), module.alias("name")))

    web_global = rf"\b({'|'.join(vocab.MISSING_GLOBALS)})\b"

    def global_rule(raw, i):
        name = F.regexp_extract(F.split_part(raw, F.lit("//"), F.lit(1)), web_global, 1)
        return F.when(name != "", F.struct((i + 1).alias("line"), name.alias("name")))

    def first(code, rule):
        return F.get(present(F.transform(F.split(code, "\n", -1), rule)), F.lit(0))

    bare = F.regexp_replace("code", r"(?s)/\*.*?\*/", "")
    found = sources.select("course_id", "source", F.explode(F.array(
        F.struct(F.lit("module").alias("kind"), first(F.col("code"), module_rule).alias("hit")),
        F.struct(F.lit("global").alias("kind"), first(bare, global_rule).alias("hit")))).alias("f"))
    return (found.filter("f.hit is not null")
            .select("course_id", "source", "f.kind", F.col("f.hit.line").cast("bigint").alias("line"),
                    F.col("f.hit.name").alias("name")))


def uncallable_inputs(test_cases: DataFrame) -> DataFrame:
    """test_cases(course_id, challenge, case_id, input) -> first fragment the grader cannot bind."""
    fragments = F.filter(F.transform(F.split(F.coalesce("input", F.lit("")), ",", -1), strip), lambda f: f != "")

    def callable_fragment(f):
        number = f.rlike(r"^\d") | f.rlike(r"^-?\d*\.?\d+$")
        literal = f.rlike(r"""^['"]""") | f.isin("true", "false", "null")
        return number | literal | f.isin(vocab.KNOWN_ARGS) | f.rlike(r"^[A-Za-z_$][\w$]*$")

    bad = F.get(F.filter(fragments, lambda f: ~callable_fragment(f)), F.lit(0))
    return (test_cases.select("course_id", "challenge", "case_id", bad.alias("fragment"))
            .filter("fragment is not null"))


# Where the runner looks for the function to call.
TS_ENTRY = r"(?:function\s+(\w+)\s*\(|(?:const|let|var)\s+(\w+)\s*=\s*(?:async\s*)?\()"
RUST_FREE_FN = r"(?m)^(?:pub(?:\([^)]*\))?\s+)?(?:async\s+)?fn\s+([A-Za-z_]\w*)\s*\(([^)]*)"
RUST_ANY_FN = r"\bfn\s+([A-Za-z_]\w*)\s*\("
RUST_SELF = r"\A\s*(?:&(?:'\w+\s+)?)?(?:mut\s+)?self\b"


def entry_function(sources: DataFrame) -> DataFrame:
    """sources(course_id, source, lang, code) -> (…, entry); null when TypeScript shows no function."""
    ts = F.coalesce(*[F.nullif(F.regexp_extract("code", TS_ENTRY, g), F.lit("")) for g in (1, 2)])
    free = F.filter(F.arrays_zip(F.regexp_extract_all("code", F.lit(RUST_FREE_FN), F.lit(1)).alias("name"),
                                 F.regexp_extract_all("code", F.lit(RUST_FREE_FN), F.lit(2)).alias("args")),
                    lambda f: ~f["args"].rlike(RUST_SELF))
    rust = F.coalesce(F.try_element_at(free, F.lit(-1))["name"],
                      F.nullif(F.regexp_extract("code", RUST_ANY_FN, 1), F.lit("")), F.lit("solution"))
    return sources.select("course_id", "source", F.when(F.col("lang") == "rust", rust).otherwise(ts).alias("entry"))


def contract_verdict(case_results: DataFrame) -> DataFrame:
    """case_results(challenge, role, case_id, ok): the solution passes all, the starter fails one."""
    def of(role):
        return F.col("role") == role
    roles = case_results.groupBy("challenge").agg(
        F.count_if(of("solution")).alias("solution_cases"), F.count_if(of("starter")).alias("starter_cases"),
        F.count_if(of("solution") & ~F.col("ok")).alias("solution_failed"),
        F.count_if(of("starter") & ~F.col("ok")).alias("starter_failed"))
    solved = (F.col("solution_cases") > 0) & (F.col("solution_failed") == 0)
    return roles.select("challenge", F.when(solved & (F.col("starter_failed") > 0), "PASS").otherwise("FAIL").alias("verdict"),
                        F.when(~solved, "solution does not pass all").when(F.col("starter_failed") == 0, "starter passes all")
                        .otherwise("").alias("why"))


def challenge_flags(t) -> DataFrame:
    return union(emit(t["challenges"], "briefs", *_identity(), *_gaps()), duplicate_challenges(t["challenges"]))
