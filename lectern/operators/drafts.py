"""Jobs on lesson drafts: drafts(course_id, stem, md). Each runs inside the row of its draft."""
from pyspark.sql import DataFrame, functions as F

from lectern import vocab
from lectern.functions import dashes, fences as fn
from lectern.functions.text import ANY_SPACE, SPACE, is_blank, present, strip, total, word_count
from lectern.operators.flags import ADVISORY, HARD, emit, exploded, finding, flag, gathered

KEY = ["course_id", "stem"]


def to_lines(drafts: DataFrame) -> DataFrame:
    return drafts.select(*KEY, F.posexplode(F.split("md", "\n", -1)).alias("pos", "line"))


def fence_state(drafts: DataFrame, mode: str) -> DataFrame:
    """One row per fence line: its number, label, and whether it opens or closes a block in `mode`.

    The fences of a draft become a string of one letter each (b bare, v visual, t other tag); the first
    letters of the leftmost matches of "opener, then its closer" are exactly the fences that open.
    """
    pairs = {"toggle": "([bvt])([bvt])", "tagged": "([vt])([bvt])", "visual": "(v)([bvt])"}[mode]
    last = {"toggle": "[bvt]$", "tagged": "[vt]$", "visual": "v$"}[mode]
    marks = drafts.select(*KEY, fn.fences(F.col("md")).alias("fences")).withColumn(
        "kinds", F.array_join(F.transform("fences", lambda f: F.when(f == "```", "b")
                                          .when(f == "```visual", "v").otherwise("t")), ""))
    roles = F.regexp_replace(F.regexp_replace("kinds", pairs, "OC"), last, "O")
    return (marks.withColumn("roles", roles)
            .select(*KEY, "roles", F.posexplode("fences").alias("fence_no", "fence"))
            .withColumn("role", F.substring(F.col("roles"), F.col("fence_no") + 1, F.lit(1)))
            .select(*KEY, "fence_no", fn.label(F.col("fence")).alias("label"),
                    F.when(F.col("role") == "O", "open").when(F.col("role") == "C", "close")
                    .otherwise("ignored").alias("role")))


def dash_count(drafts: DataFrame) -> DataFrame:
    return drafts.select(*KEY, dashes.count(F.col("md")).alias("dashes"))


def dedash(drafts: DataFrame) -> DataFrame:
    return drafts.withColumn("md", dashes.rewrite(F.col("md")))


def _with_visuals(drafts: DataFrame) -> DataFrame:
    specs = F.transform(fn.blocks(F.col("md"), fn.VISUAL_BLOCK), lambda b: F.struct(
        fn.visual_fields(b["body"], vocab.VISUAL_FIELDS).alias("spec"), b["close"].alias("close")))
    return drafts.withColumn("_specs", specs)


def _is_valid(spec):
    filled = [~is_blank(spec[f]) for f in vocab.VISUAL_FIELDS]
    ok = spec["type"].isin(vocab.VISUAL_TYPES)
    for f in filled:
        ok = ok & f
    return ok


def parse_visuals(drafts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """visuals(…, n, type, title, purpose, data, prompt, alt, valid), defects(…, n, defect)."""
    one = _with_visuals(drafts).select(*KEY, F.posexplode_outer("_specs").alias("n", "b")).filter("n is not null").withColumn("n", F.col("n") + 1)
    visuals = one.select(*KEY, "n", "b.spec.*", _is_valid(F.col("b.spec")).alias("valid"))
    defects = (one.withColumn("defect", F.when(F.col("b.close") == "", "unclosed")
                              .when(F.col("b.close") != "```", "glued"))
               .filter("defect is not null").select(*KEY, "n", "defect"))
    return visuals, defects


def _measured(drafts: DataFrame) -> DataFrame:
    """Every draft with its cuts and its numbers: the one reading all rules share."""
    cut = _with_visuals(drafts).select(
        *KEY, "md", "_specs", fn.segments(F.col("md")).alias("segs"), fn.fence_labels(fn.fences(F.col("md"))).alias("labels"))
    counted = cut.select(
        "*", _valid_specs().alias("_valid"),
        F.transform("segs", lambda s, i: F.when(i % 2 == 0, word_count(s)).otherwise(0).cast("bigint")).alias("run"),
        F.transform("segs", lambda s: fn.line_count(s).cast("bigint")).alias("feeds"),
        present(F.transform("labels", lambda x, i: F.when((i % 2 == 0) & (x != "visual"), i))).alias("code_openers"))
    walled = counted.select("*", F.array_max("run").alias("longest_wall"),
                            F.array_position("run", F.array_max("run")).cast("int").alias("wall_at"))
    upto_wall = total(F.slice("feeds", 1, F.col("wall_at")))
    return walled.select(
        "*", total(F.col("run")).alias("prose_words"),
        F.when(F.col("longest_wall") == 0, F.lit(0).cast("bigint")).when(F.col("wall_at") == F.size("run"), upto_wall + 1)
        .otherwise(upto_wall).alias("wall_end_line"),
        F.when(F.size("code_openers") > 0, total(F.slice("run", 1, F.get("code_openers", F.lit(0)) + 1))).alias("first_code_words"),
        F.when(F.size("labels") > 0, F.get("run", F.lit(0))).alias("first_fence_words"),
        F.size("_specs").cast("bigint").alias("visual_blocks"), F.size("_valid").cast("bigint").alias("visual_valid"),
        F.array_sort(F.array_distinct(F.transform("_valid", lambda v: v["type"]))).alias("visual_types"))


METRICS = ["prose_words", "longest_wall", "wall_end_line", "first_code_words", "first_fence_words", "visual_blocks",
           "visual_valid", "visual_types"]


def draft_metrics(drafts: DataFrame) -> DataFrame:
    """Words, longest prose wall and its last line, words before the first code / any fence, visuals."""
    return _measured(drafts).select(*KEY, *METRICS)


def assessed(drafts: DataFrame) -> DataFrame:
    """Metrics and findings of each draft in one row: one pass over the text and no shuffle."""
    read = _measured(drafts).withColumns({
        "dashes": dashes.count_in(F.col("segs"), F.col("labels")), "sentences": _sentence_counts(F.col("segs")),
        "tool": _unset_tool(F.col("segs"), F.col("labels"), vocab.TOOL_INSTALLERS)})
    found = gathered(_title_finding(), _floor_finding(), _one_type_finding(), _wall_finding(), _tool_finding(), _dash_finding(),
                     _depth_finding(), _rhythm_finding(), lists=(_defect_findings(), _alt_findings()))
    return read.select(*KEY, *METRICS, "dashes", found.alias("findings"))


def all_findings(drafts: DataFrame) -> DataFrame:
    """All rules that need the draft alone."""
    return exploded(assessed(drafts).select("course_id", "findings"), "drafts", F.col("findings"))


# ---- rules: each finding is a column, so that all of them can share one reading of the text ---------

def _title_finding():
    opens_on_title = F.col("md").rlike(rf"\A(?:[{ANY_SPACE}]*\n)?# ")
    return finding(~opens_on_title, "no_title", HARD, F.col("stem"))


def _floor_finding():
    floor = F.greatest(F.lit(vocab.VISUAL_MIN), F.ceil(F.col("prose_words") / vocab.VISUAL_WORDS_PER))
    return finding(F.col("visual_valid") < floor, "visual_floor", HARD, F.col("stem"),
                   F.concat_ws("/", F.col("visual_valid"), floor.cast("bigint")))


def _defect_findings():
    defect = lambda b: F.when(b["close"] == "", "unclosed").when(b["close"] != "```", "glued")
    return present(F.transform("_specs", lambda b, i: finding(
        defect(b).isNotNull(), "visual_defect", HARD, F.col("stem"), F.concat_ws(":", i + 1, defect(b)))))


def _valid_specs():
    return F.filter(F.transform("_specs", lambda b: b["spec"]), _is_valid)


def _one_type_finding():
    kinds = F.array_distinct(F.transform("_valid", lambda v: v["type"]))
    return finding((F.size("_valid") >= 2) & (F.size(kinds) < 2), "one_visual_type", ADVISORY, F.col("stem"), F.get(kinds, F.lit(0)))


def _weak_alt(v):
    size, low = word_count(v["alt"]), F.lower(v["alt"])
    weak = (size < 8) | (size > 30) | (low == F.lower(v["title"]))
    for prefix in vocab.WEAK_ALT_PREFIXES:
        weak = weak | F.startswith(low, F.lit(prefix))
    return weak


def _alt_findings():
    weak = F.transform("_valid", lambda v, i: finding(_weak_alt(v), "weak_alt", ADVISORY, F.col("stem"), i + 1))
    bracket = F.transform("_valid", lambda v, i: finding(
        v["alt"].rlike(r"[\[\]]"), "bracket_in_alt", HARD, F.col("stem"), i + 1))
    return present(F.concat(weak, bracket))


def _wall_finding():
    severity = F.when(F.col("longest_wall") > vocab.WALL_HARD, HARD).otherwise(ADVISORY)
    return finding(F.col("longest_wall") > vocab.WALL_ADVISORY, "prose_wall", severity, F.col("stem"),
                   F.concat_ws("@", "longest_wall", "wall_end_line"))


def _dash_finding():
    severity = F.when(F.col("dashes") > 2, HARD).otherwise(ADVISORY)
    return finding(F.col("dashes") >= 1, "dash_policy", severity, F.col("stem"), F.col("dashes"))


def _depth_finding():
    outside = (F.col("prose_words") < vocab.DEPTH_MIN) | (F.col("prose_words") > vocab.DEPTH_MAX)
    return finding(outside, "depth_band", ADVISORY, F.col("stem"), F.col("prose_words"))


def _tool_finding():
    return finding(F.col("tool").isNotNull(), "tool_without_install", ADVISORY, F.col("stem"), F.col("tool"))


def _rhythm_finding():
    developed = F.exists("sentences", lambda n: n >= 4)
    thin = total(F.col("sentences")) < 1.8 * F.size("sentences")
    rule = F.when(~developed, "no_developed_paragraph").when(thin, "staccato")
    return finding((F.size("sentences") > 0) & rule.isNotNull(), "paragraph_rhythm", ADVISORY, F.col("stem"), rule)


def no_title(drafts: DataFrame) -> DataFrame:
    return emit(drafts, "drafts", _title_finding())


def visual_floor(metrics: DataFrame) -> DataFrame:
    return emit(metrics, "drafts", _floor_finding())


def visual_defects(drafts: DataFrame) -> DataFrame:
    return emit(_with_visuals(drafts), "drafts", lists=(_defect_findings(),))


def visual_quality(drafts: DataFrame) -> DataFrame:
    """One type for all visuals, weak alt text, brackets in alt text."""
    read = _with_visuals(drafts).withColumn("_valid", _valid_specs())
    return emit(read, "drafts", _one_type_finding(), lists=(_alt_findings(),))


def prose_wall(metrics: DataFrame) -> DataFrame:
    return emit(metrics, "drafts", _wall_finding())


def late_first_do(metrics: DataFrame, stems: DataFrame) -> DataFrame:
    """stems(course_id, stem, kind, opener): applies only to courses that have a manifest."""
    courses = stems.select("course_id").distinct()
    joined = (metrics.join(courses, "course_id", "left_semi").join(stems, KEY, "left")
              .withColumn("kind", F.coalesce("kind", F.lit("build")))
              .withColumn("budget", F.when(F.coalesce("opener", F.lit(False)), vocab.FIRST_DO_WORDS_OPENER)
                          .otherwise(vocab.FIRST_DO_WORDS))
              .withColumn("first", F.when(F.col("kind") == "build", F.col("first_code_words"))
                          .otherwise(F.col("first_fence_words"))))
    late = F.col("first").isNull() | (F.col("first") > F.col("budget"))
    return flag(joined.filter(late), "drafts", "late_first_do", HARD, F.col("stem"),
                F.coalesce(F.col("first").cast("string"), F.lit("none")))


def _unset_tool(segs, labels, tools):
    """First tool, in list order, started in a shell fence while its installer is nowhere in the draft."""
    low, shell = F.lower("md"), F.lower(fn.fenced(segs, labels, vocab.SHELL_LABELS))
    return F.coalesce(*[F.when(shell.rlike(rf"(?m)^[ \t]*(?:[$#][ \t]*)?(?:[A-Z_]+=\S+[ \t]+)*\Q{tool}\E\b")
                               & ~F.contains(low, F.lit(installer)), F.lit(tool)) for tool, installer in tools])


def tool_without_install(drafts: DataFrame, tools=None) -> DataFrame:
    read = drafts.select(*KEY, "md", fn.segments(F.col("md")).alias("segs"), fn.fence_labels(fn.fences(F.col("md"))).alias("labels"))
    tool = _unset_tool(F.col("segs"), F.col("labels"), tools or vocab.TOOL_INSTALLERS)
    return emit(read.withColumn("tool", tool), "drafts", _tool_finding())


def dash_policy(counts: DataFrame) -> DataFrame:
    return emit(counts, "drafts", _dash_finding())


def depth_band(metrics: DataFrame) -> DataFrame:
    return emit(metrics, "drafts", _depth_finding())


def _sentence_counts(segs):
    """Sentences of each paragraph of more than ten words.

    Heading, list, quote, table and digit lines vanish without ending the paragraph around them.
    """
    kept = F.regexp_replace(fn.prose(segs), rf"(?dm)^[{SPACE}]*[#\-|>*1-9][^\n]*(?:\n|\z)", "")
    paras = F.split(F.regexp_replace(kept, rf"(?dm)^[{SPACE}]+$", ""), r"\n\n+", -1)
    flat = F.transform(paras, lambda p: strip(F.array_join(F.transform(F.split(p, "\n", -1), strip), " ")))
    long_ones = F.filter(flat, lambda p: word_count(p) > 10)
    return F.transform(long_ones, lambda p: F.size(
        F.filter(F.split(p, rf"[.?][{ANY_SPACE}]", -1), lambda s: ~is_blank(s))).cast("bigint"))


def paragraphs(drafts: DataFrame) -> DataFrame:
    """paras(course_id, stem, sentences array<bigint>)"""
    return drafts.select(*KEY, _sentence_counts(fn.segments(F.col("md"))).alias("sentences"))


def paragraph_rhythm(drafts: DataFrame) -> DataFrame:
    return emit(paragraphs(drafts), "drafts", _rhythm_finding())


def metrics_table(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        *KEY, "prose_words", "visual_valid", F.size("visual_types").cast("bigint").alias("n_types"), "longest_wall",
        F.coalesce(F.col("first_code_words").cast("string"), F.lit("-")).alias("first_code"))


# ---- comments and the prose projection -------------------------------------------------------

_MARK = "\ue000"  # private-use character: stands where a comment was


def strip_comments(texts: DataFrame, column: str = "md") -> DataFrame:
    """Drop HTML comments outside fences; a line that held only a comment goes away altogether.

    One ordered pass of alternatives: a fenced block is matched first and put back as it is, so a
    comment opener inside code is never seen. A comment may hold fence lines, and an unclosed one runs
    to the end. Marks tell lines emptied here from lines that were blank before.
    """
    def fence(end):
        return rf"(?<![^\n])[{SPACE}]*```[^\n]*(?:\n.*?(?:(?<=\n)[{SPACE}]*```[^\n]*|{end})|{end})"

    text_end = r"\z"
    comment = r"<!--[^\n]*?(?:-->|(\n).*?(?:-->|\z)|\z)"
    only_marks = rf"[{SPACE}]*{_MARK}[{SPACE}{_MARK}]*"
    marked = F.regexp_replace(column, rf"(?s)({fence(text_end)})|{comment}", f"$1{_MARK}$2{_MARK}")
    marked_end = rf"(?={_MARK}{_MARK}\z)"
    for pattern, to in [(rf"(?s)({fence(marked_end)}){_MARK}{_MARK}", "$1"), (rf"(?dm)^{only_marks}\n", ""),
                        (rf"(?:\A|\n){only_marks}\z", ""), (_MARK, "")]:
        marked = F.regexp_replace(marked, pattern, to)
    return texts.withColumn(column, marked)


PROJECTED_VISUAL = rf"(?dms)^[{SPACE}]*```visual[{SPACE}]*$(?:\n(.*?))??(?:\n[{SPACE}]*```[{SPACE}]*$|\z)"


def project_prose(drafts: DataFrame, assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nth visual spec becomes an image link, or a quoted placeholder and a warning.

    assets(course_id, stem, n, file): one shipped file per spec number.
    """
    per_stem = assets.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("n", "file"))).alias("files"))
    clean = strip_comments(drafts).join(per_stem, KEY, "left")
    names = ["type", "title", "purpose", "alt"]

    def field(body, name, default):
        hits = F.regexp_extract_all(body, F.lit(rf"(?dm)^[{ANY_SPACE}]*{name}:([^\n]*)$"), F.lit(1))
        return F.coalesce(strip(F.try_element_at(hits, F.lit(-1))), default)

    specs = F.transform(F.regexp_extract_all("md", F.lit(PROJECTED_VISUAL), F.lit(1)), lambda b, i: F.struct(
        field(b, "title", field(b, "type", F.lit("diagram"))).alias("title"),
        field(b, "alt", F.lit("")).alias("alt"),
        F.try_element_at("files", i + 1).alias("file")))
    gaps = F.split("md", PROJECTED_VISUAL, -1)

    def embed(s):
        link = F.concat(F.lit("!["), F.when(s["alt"] != "", s["alt"]).otherwise(s["title"]),
                        F.lit("](assets/"), s["file"], F.lit(")"))
        quote = F.concat(F.lit("> **Visual — "), s["title"], F.lit(".**"),
                         F.when(s["alt"] != "", F.concat(F.lit(" "), s["alt"])).otherwise(""))
        return F.when(s["file"].isNotNull(), link).otherwise(quote)

    laid = clean.select(*KEY, specs.alias("specs"), gaps.alias("gaps"))
    body = F.array_join(F.transform("gaps", lambda g, i: F.concat(
        g, F.coalesce(embed(F.get("specs", i)), F.lit("")))), "")
    text = F.concat(F.regexp_replace(body, rf"[{ANY_SPACE}]+\z", ""), F.lit("\n"))
    prose = laid.select(*KEY, text.alias("prose"))
    warnings = (laid.select(*KEY, F.posexplode_outer("specs").alias("n", "s")).filter("n is not null and s.file is null")
                .select(*KEY, (F.col("n") + 1).alias("n"), F.col("s.title").alias("title")))
    return prose, warnings


# ---- whole-catalog sweeps ---------------------------------------------------------------------

def dash_coverage(text_fields: DataFrame) -> DataFrame:
    """Dashes in every kind of text: text_fields(course_id, field, text)."""
    return (text_fields.withColumn("dashes", dashes.count(F.col("text"))).groupBy("field")
            .agg(F.count("*").alias("texts"), F.sum("dashes").alias("dashes")))
