"""Rules on lesson briefs: briefs(course_id, lesson_id, place, kind, declared_kind, raw, brief)."""
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lectern import vocab
from lectern.functions.text import NOT_SPACE, is_blank, present, strip
from lectern.operators import blocklist
from lectern.operators.flags import ADVISORY, HARD, emit, finding, flag, union
from lectern.operators.graph import duplicates
from lectern.operators.order import position_key

B = "brief."


def duplicate_lessons(lessons: DataFrame) -> DataFrame:
    return flag(duplicates(lessons, "lesson_id"), "briefs", "duplicate_lesson", HARD, F.col("lesson_id"))


def bad_opener(briefs: DataFrame) -> DataFrame:
    first = briefs.groupBy("course_id").agg(
        F.min_by(F.struct("lesson_id", F.col("brief.dominant_job").alias("job")), position_key()).alias("first"))
    return flag(first.filter(~F.col("first.job").eqNullSafe("motivate")), "briefs", "bad_opener", ADVISORY,
                F.col("first.lesson_id"), F.col("first.job"))


# ---- findings inside one brief ------------------------------------------------------------------

def _kind():
    return finding(~F.col("declared_kind").isin(vocab.LESSON_KINDS), "bad_kind", HARD, F.col("lesson_id"), F.col("declared_kind"))


def _missing(key: str) -> Column:
    """Null is missing, and so is blank text; an empty list is not."""
    col = F.col(B + key)
    if key in ("objectives", "prerequisites", "just_in_time"):
        return col.isNull()
    return is_blank(col)


def _keys():
    core = [F.when(_missing(k), F.lit(k)) for k in vocab.BRIEF_CORE_KEYS]
    build = [F.when((F.col("kind") == "build") & _missing(k), F.lit(k)) for k in vocab.BRIEF_BUILD_KEYS]
    missing = present(F.array(*core, *build))
    return finding(F.size(missing) > 0, "missing_keys", HARD, F.col("lesson_id"), F.array_join(missing, ","))


def _objectives():
    return finding(F.coalesce(F.size(B + "objectives"), F.lit(0)) <= 0, "no_objectives", HARD, F.col("lesson_id"))


def _job():
    job = F.col(B + "dominant_job")
    severity = F.when(F.coalesce(job.isin(vocab.GUEST_ONLY_JOBS), F.lit(False)), ADVISORY).otherwise(HARD)
    wrong = ~F.coalesce(job.isin(vocab.DOMINANT_JOBS), F.lit(False)) | job.isin(vocab.GUEST_ONLY_JOBS)
    return finding(wrong, "bad_job", severity, F.col("lesson_id"), job)


def gate_text(assessment: Column) -> Column:
    """`assessment` is text, or an object with a `gate`."""
    return F.when(F.startswith(assessment, F.lit("{")), F.get_json_object(assessment, "$.gate")).otherwise(assessment)


def _gate():
    gate = gate_text(F.col(B + "assessment"))
    rule = (F.when(is_blank(gate), "no_gate")
            .when(gate.rlike(vocab.PASSIVE_GATE) & ~gate.rlike(vocab.DOING_GATE), "passive_gate"))
    return finding(rule.isNotNull(), "gate", HARD, F.col("lesson_id"), rule)


def _verify():
    empty = F.coalesce(F.to_json(B + "verify"), F.lit("{}")) == "{}"
    return finding((F.col("kind") == "build") & empty, "no_verify", ADVISORY, F.col("lesson_id"))


def _difficulty():
    # Integers only: a quoted number is none. Only the raw text tells, and it is read where the parsed value alone does not settle it.
    good = F.coalesce(F.col(B + "difficulty").try_cast("bigint").between(1, 3), F.lit(False))
    bare = F.from_json(F.when(~good, F.col("raw")), "brief STRUCT<difficulty: BIGINT>")["brief"]["difficulty"]
    read = F.transform(F.array(bare), lambda v: finding(~v.between(1, 3), "bad_difficulty", ADVISORY, F.col("lesson_id"), v))
    return F.get(read, F.lit(0))


def _weak_verbs():
    """A substring test on purpose: `learn` is found in `learner`."""
    def weak(o):  # lower case is made once, not for each verb
        return F.exists(F.array(F.lower(o["statement"])), lambda low: reduce(Column.__or__, [F.contains(low, F.lit(v)) for v in vocab.WEAK_VERBS]))
    return present(F.transform(B + "objectives", lambda o, i: finding(weak(o), "weak_verb", ADVISORY, F.col("lesson_id"), i)))


def _target(min_words: int = vocab.LESSON_TARGET_MIN):
    numbers = F.transform(F.regexp_extract_all(B + "est_length", F.lit(r"[\d,]+"), F.lit(0)),
                          lambda n: F.replace(n, F.lit(","), F.lit("")).try_cast("bigint"))
    target = F.array_max(present(numbers))
    return finding((target > 0) & (target < min_words), "short_target", ADVISORY, F.col("lesson_id"), target)


def bad_kind(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", _kind())


def missing_keys(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", _keys())


def no_objectives(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", _objectives())


def bad_job(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", _job())


def passive_gate(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", _gate())


def no_verify(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", _verify())


def bad_difficulty(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", _difficulty())


def weak_verbs(briefs: DataFrame) -> DataFrame:
    return emit(briefs, "briefs", lists=(_weak_verbs(),))


def short_target(briefs: DataFrame, min_words: int = vocab.LESSON_TARGET_MIN) -> DataFrame:
    return emit(briefs, "briefs", _target(min_words))


def all_findings(briefs: DataFrame) -> DataFrame:
    """Every rule that one brief answers alone, in one pass."""
    return emit(briefs, "briefs", _kind(), _keys(), _objectives(), _job(), _gate(), _verify(), _difficulty(), _target(),
                lists=(_weak_verbs(),))


def blocklist_hits(briefs: DataFrame, phrases: DataFrame | blocklist.PhraseIndex) -> DataFrame:
    """A phrase inside any one of five fields."""
    fields = ["title", "hook", "concept_spec", "artifact_spec", "color"]
    # The separator cannot occur in a phrase, so no match crosses two fields.
    text = F.concat_ws("\n", *[F.col(B + f) for f in fields])
    texts = briefs.select("course_id", "lesson_id", "array_pos", text.alias("text"))
    return flag(blocklist.hits(texts, ["course_id", "lesson_id", "array_pos"], "text", phrases), "briefs", "blocklist", HARD, F.col("lesson_id"), F.col("phrase"))


# A command's words as a shell reads them: plain runs, escaped characters, quoted parts. Possessive, so linear and flat.
_PLAIN, _ESCAPED, _SINGLE, _DOUBLE = r"[^{}'\"\\]++", r"\\[\s\S]", r"'[^']*+'", r'"(?:[^"\\]++|\\[\s\S])*+"'
_WORD_PART = "|".join([_PLAIN.format(r"\x20\t\r\n"), _ESCAPED, _SINGLE, _DOUBLE])
_WHOLE = rf"\A(?:{'|'.join([_PLAIN.format(''), _ESCAPED, _SINGLE, _DOUBLE])})*+\z"


def first_shell_word(segment: Column) -> Column:
    """The first word without its quotes and escapes; null where a quote or an escape is left open."""
    def bare(part: Column) -> Column:
        inner = F.substring(part, F.lit(2), F.length(part) - 2)
        return (F.when(part.startswith("'"), inner).when(part.startswith('"'), F.regexp_replace(inner, r'\\(["\\])', "$1"))
                .otherwise(F.regexp_replace(part, r"\A\\([\s\S])\z", "$1")))
    parts = F.regexp_extract_all(F.regexp_extract(segment, rf"\A(?:{_WORD_PART})*+", 0), F.lit(f"({_WORD_PART})"), F.lit(1))
    return F.when(segment.rlike(_WHOLE), F.array_join(F.transform(parts, bare), ""))


def smoke_eligibility(briefs: DataFrame, allowlist=tuple(vocab.SMOKE_ALLOWLIST)) -> DataFrame:
    """Every pipe segment of the verify command starts with an allowed word (or wc), read as a shell reads it. As a bar cuts a command even
    inside quotes, a segment with an open quote is not eligible."""
    command = F.col(B + "verify.command")
    parts = F.filter(F.transform(F.split(command, r"\|", -1), lambda s: strip(s)), lambda s: s != "")
    ok = F.forall(parts, lambda s: F.coalesce(first_shell_word(s).isin([*allowlist, "wc"]), F.lit(False)))
    return (briefs.filter(F.coalesce(command, F.lit("")) != "")
            .select("course_id", "lesson_id", command.alias("command"), ok.alias("eligible")))


def brief_flags(t, phrases: DataFrame) -> DataFrame:
    return union(duplicate_lessons(t["lessons"]), bad_opener(t["briefs"]), all_findings(t["briefs"]),
                 blocklist_hits(t["briefs"], phrases))
