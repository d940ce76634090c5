"""Quiz rules and analytics.

questions(course_id, lesson_id, block, q_pos, question, q_id, prompt, multi, options, explanation) with
options array<struct<id, label, correct, feedback>> in slot order: a question is read in its own row,
and what leaves the row is one slot or one gap, summed per course before any shuffle.
"""
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.text import is_blank, present, strip
from lectern.operators.flags import ADVISORY, HARD, emit, finding, flag, union

MIN_QUESTIONS = 6


def not_a_list(lessons: DataFrame) -> DataFrame:
    """lessons(course_id, lesson_id, raw, brief): the raw text shows a wrong type that parsing would hide. It is read only where parsing gave no list and
    the field's name is in it, as it is or with escapes."""
    def text(name: str) -> Column:
        named = F.contains("raw", F.lit(f'"{name}"')) | F.contains("raw", F.lit("\\u"))
        return F.get_json_object(F.when(F.col(f"brief.{name}").isNull() & named, F.col("raw")), f"$.brief.{name}")

    fields = lessons.select("course_id", "lesson_id", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), text(f).alias("text")) for f in ("quiz_blocks", "coding_challenges")])).alias("f"))
    wrong = fields.filter(F.col("f.text").isNotNull() & ~F.startswith("f.text", F.lit("[")))
    return flag(wrong, "briefs", "not_a_list", HARD, F.col("lesson_id"), F.col("f.field"))


def empty_quiz(quiz_blocks: DataFrame) -> DataFrame:
    return flag(quiz_blocks.filter(F.coalesce(F.size("questions"), F.lit(0)) <= 0), "briefs", "empty_quiz", HARD,
                F.col("lesson_id"), F.col("block"))


def _where() -> Column:
    return F.concat_ws("#", "lesson_id", "block", "q_pos")


def _id(c) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def _no_id():
    return finding(_id(F.col("q_id")) == "", "question_without_id", HARD, _where())


def _no_prompt():
    return finding(is_blank(F.col("prompt")), "no_prompt", HARD, _where())


def _few_options():
    n = F.size("options")
    return finding(n < 3, "few_options", F.when(n < 2, HARD).otherwise(ADVISORY), _where(), n)


def _option_ids():
    ids = F.transform("options", lambda o: _id(o["id"]))
    return (finding(F.exists(ids, lambda i: i == ""), "option_without_id", HARD, _where()),
            finding(F.size(F.array_distinct(ids)) < F.size(ids), "duplicate_option", HARD, _where()))


def _correct(options) -> Column:
    return F.filter(options, lambda o: F.coalesce(o["correct"], F.lit(False)))


def _correctness():
    n = F.size(_correct("options"))
    return finding(F.when(F.col("multi"), n < 1).otherwise(n != 1), "bad_correctness", HARD, _where(), n)


def _no_feedback():
    """Only options explicitly marked wrong need feedback."""
    return present(F.transform("options", lambda o: finding(
        (o["correct"] == F.lit(False)) & is_blank(o["feedback"]), "no_feedback", ADVISORY, _where(), o["id"])))


def _no_explanation():
    return finding(is_blank(F.col("explanation")), "no_explanation", ADVISORY, _where())


def duplicate_questions(questions: DataFrame) -> DataFrame:
    twice = (questions.select("course_id", "lesson_id", "block", _id(F.col("q_id")).alias("_id")).filter("_id <> ''")
             .groupBy("course_id", "lesson_id", "block", "_id").agg(F.count("*").alias("n")).filter("n > 1"))
    return flag(twice, "briefs", "duplicate_question", HARD, F.concat_ws("#", "lesson_id", "block"), F.col("_id"))


def bad_questions(questions: DataFrame) -> DataFrame:
    return union(emit(questions, "briefs", _no_id(), _no_prompt()), duplicate_questions(questions))


def few_options(questions: DataFrame) -> DataFrame:
    return emit(questions, "briefs", _few_options())


def bad_option_ids(questions: DataFrame) -> DataFrame:
    return emit(questions, "briefs", *_option_ids())


def bad_correctness(questions: DataFrame) -> DataFrame:
    return emit(questions, "briefs", _correctness())


def missing_feedback(questions: DataFrame) -> DataFrame:
    return emit(questions, "briefs", _no_explanation(), lists=(_no_feedback(),))


def all_findings(questions: DataFrame) -> DataFrame:
    """Every rule that one question answers alone, in one pass."""
    return emit(questions, "briefs", _no_id(), _no_prompt(), _few_options(), *_option_ids(), _correctness(), _no_explanation(),
                lists=(_no_feedback(),))


# ---- analytics --------------------------------------------------------------------------------

def _lengths() -> Column:
    return F.transform("options", lambda o: F.length(F.coalesce(o["label"], F.lit(""))))


def answers(questions: DataFrame) -> DataFrame:
    """Single-select questions with exactly one correct option: slot (0-based) and label lengths."""
    right = F.transform("options", lambda o: F.coalesce(o["correct"], F.lit(False)))
    single = questions.filter((~F.col("multi")) & (F.size(F.filter(right, lambda c: c)) == 1))
    return single.select("course_id", "question", "q_id", F.array_position(right, F.lit(True)).alias("slot"),
                         _lengths().alias("lens"))


def _tallies(questions: DataFrame) -> DataFrame:
    """Per course and slot: questions, and how many have the unique longest label on the answer."""
    longest = F.array_max("lens")
    unique = (F.size("lens") >= 2) & (F.get("lens", (F.col("slot") - 1).cast("int")) == longest) & (
        F.size(F.filter("lens", lambda n: n == F.array_max("lens"))) == 1)
    return (answers(questions).groupBy("course_id", "slot")
            .agg(F.count("*").alias("n"), F.count_if(unique).alias("longest")))


def slot_skew(questions: DataFrame, min_n: int = MIN_QUESTIONS, share: float = 0.5) -> DataFrame:
    per_course = _tallies(questions).groupBy("course_id").agg(
        F.sum("n").alias("total"), F.max(F.struct("n", (-F.col("slot")).alias("back"))).alias("top"))
    skewed = per_course.filter((F.col("total") >= min_n) & (F.col("top.n") > share * F.col("total")))
    return flag(skewed, "briefs", "slot_skew", HARD, F.concat(F.lit("slot "), -F.col("top.back")),
                F.concat_ws("/", "top.n", "total"))


def slot_distribution(questions: DataFrame) -> DataFrame:
    return _tallies(questions).select("course_id", "slot", "n")


def longest_tell(questions: DataFrame, min_n: int = MIN_QUESTIONS, share: float = 0.7) -> DataFrame:
    per_course = _tallies(questions).groupBy("course_id").agg(
        F.sum("n").alias("total"), F.sum("longest").alias("longest"))
    told = per_course.filter((F.col("total") >= min_n) & (F.col("longest") > share * F.col("total")))
    return flag(told, "briefs", "longest_tell", ADVISORY, F.col("course_id"), F.concat_ws("/", "longest", "total"))


def _report_rows(questions: DataFrame) -> DataFrame:
    """The report's own rule: at least two options, and a tie for the longest label counts."""
    at_slot = F.get("lens", (F.col("slot") - 1).cast("int"))
    down = F.sort_array("lens", asc=False)
    return (answers(questions).filter(F.size("lens") >= 2)
            .withColumn("is_longest", at_slot == F.array_max("lens"))
            .withColumn("gap", F.get(down, F.lit(0)) - F.get(down, F.lit(1))))


def quiz_report(questions: DataFrame) -> DataFrame:
    slots = (_report_rows(questions).groupBy("course_id", "slot")
             .agg(F.count("*").alias("n"), F.count_if("is_longest").alias("longest")))
    spread = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("slot", "n"))),
                                      lambda s: F.concat_ws(":", s["slot"], s["n"])), " ")
    per_course = slots.groupBy("course_id").agg(
        F.sum("n").alias("questions"), F.sum("longest").alias("longest"), spread.alias("spread"))
    return per_course.withColumn("longest_pct", F.bround(100 * F.col("longest") / F.col("questions")).cast("bigint"))


def widest_gaps(questions: DataFrame, k: int = 8) -> DataFrame:
    """Top k per course; Spark keeps only k rows per course in every task before it shuffles them."""
    rank = F.row_number().over(Window.partitionBy("course_id").orderBy(F.desc("gap"), F.desc("q_id"), "question"))
    return (_report_rows(questions).filter("is_longest").withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("course_id", "q_id", F.col("gap").cast("bigint").alias("gap"), F.col("rank").cast("bigint").alias("rank")))


# ---- guarded merge ------------------------------------------------------------------------------

def _shape(blocks: Column) -> Column:
    """What an edit must not touch: question ids, option ids, correctness."""
    def question(q):
        opts = F.coalesce(q["options"], F.array().cast("array<struct<id:string,label:string,correct:boolean,feedback:string>>"))
        return F.struct(q["id"].alias("id"), F.transform(opts, lambda o: F.struct(
            o["id"].alias("id"), F.coalesce(o["correct"], F.lit(False)).alias("correct"))).alias("options"))
    return F.transform(blocks, lambda b: F.transform(b["questions"], question))


def merge_quiz(current: DataFrame, edited: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """current, edited (course_id, lesson_id, quiz_blocks) -> merged, refused, report.

    One refused file stops its whole course: the old blocks stay everywhere in it.
    """
    key = ["course_id", "lesson_id"]
    both = (current.withColumn("known", F.lit(True))
            .join(edited.withColumnRenamed("quiz_blocks", "new_blocks").withColumn("sent", F.lit(True)), key, "full"))
    judged = both.select(*key, "quiz_blocks", "new_blocks", "known", "sent", F.when(
        F.col("sent").isNotNull() & F.col("known").isNull(), "unknown lesson").when(
        F.col("sent").isNotNull() & ~_shape(F.col("quiz_blocks")).eqNullSafe(_shape(F.col("new_blocks"))),
        "shape changed").alias("reason"),
        (F.col("sent").isNotNull() & ~F.col("quiz_blocks").eqNullSafe(F.col("new_blocks"))).alias("differs"))
    per_course = judged.groupBy("course_id").agg(
        F.count_if(F.col("sent").isNotNull()).alias("sent"), F.count("reason").alias("refused"),
        F.count_if(F.col("differs") & F.col("reason").isNull()).alias("changed"))
    report = per_course.select("course_id", "refused", F.when(F.col("refused") > 0, 0).otherwise(F.col("sent"))
                               .cast("bigint").alias("merged"),
                               F.when(F.col("refused") > 0, 0).otherwise(F.col("changed")).cast("bigint").alias("changed"))
    clean = report.filter("refused = 0").select("course_id", F.lit(True).alias("clean"))
    merged = (judged.filter("known").join(clean, "course_id", "left")
              .select(*key, F.when(F.col("clean") & F.col("sent").isNotNull(), F.col("new_blocks"))
                      .otherwise(F.col("quiz_blocks")).alias("quiz_blocks")))
    return merged, judged.filter("reason is not null").select(*key, "reason"), report


def quiz_flags(t) -> DataFrame:
    q = t["questions"]
    return union(not_a_list(t["lessons"]), empty_quiz(t["quiz_blocks"]), all_findings(q), duplicate_questions(q),
                 slot_skew(q), longest_tell(q))
