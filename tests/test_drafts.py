import pytest

from lectern.operators import code, drafts, visuals
from lectern.functions import dashes
from pyspark.sql import functions as F

VISUAL = "```visual\ntype: chart\ntitle: T\npurpose: p\ndata: | a\n  b\nprompt: x\nalt: one two three four five six seven eight\n```"


@pytest.fixture
def draft(spark):
    return lambda *texts: spark.createDataFrame([("c", f"m00-l{i}-x", t) for i, t in enumerate(texts)], "course_id string, stem string, md string")


def rules(df):
    return {(r.rule, r.severity) for r in df.collect()}


def test_metrics_follow_the_toggle_reading(draft):
    md = "# T\none two three\n```bash\nnot prose\n```\nfour five\n\n```visual\ntype: chart\n```\nsix"
    m = drafts.draft_metrics(draft(md)).first()
    assert (m.prose_words, m.longest_wall, m.wall_end_line, m.first_code_words, m.first_fence_words) == (8, 5, 2, 5, 5)
    assert (m.visual_blocks, m.visual_valid) == (1, 0)


def test_last_run_ends_at_the_last_line(draft):
    m = drafts.draft_metrics(draft("a\n```sh\n```\nb c\nd")).first()
    assert (m.longest_wall, m.wall_end_line) == (3, 5)


def test_unclosed_fence_hides_the_rest(draft):
    m = drafts.draft_metrics(draft("a b\n```sh\nc d e f")).first()
    assert (m.prose_words, m.longest_wall, m.wall_end_line) == (2, 2, 1)


def test_unicode_space_separates_words(draft):
    assert drafts.draft_metrics(draft("a b　c\td")).first().prose_words == 4


def test_visual_fields_and_defects(draft):
    visuals_, defects = drafts.parse_visuals(draft(VISUAL + "\n```visual\ntype: chart\ntype: table\n``` and so\n```visual\ntype: x"))
    rows = visuals_.orderBy("n").collect()
    assert rows[0].valid and rows[0].data == "a b"
    assert [r.type for r in rows] == ["chart", "table", "x"]
    assert {(d.n, d.defect) for d in defects.collect()} == {(2, "glued"), (3, "unclosed")}


def test_three_readings_differ(draft):
    one = draft("```\na\n```rust\nb\n```\n```visual\nc\n```")
    opened = {m: [r.fence_no for r in drafts.fence_state(one, m).filter("role = 'open'").orderBy("fence_no").collect()] for m in ("toggle", "tagged", "visual")}
    assert opened == {"toggle": [0, 2, 4], "tagged": [1, 3], "visual": [3]}


@pytest.mark.parametrize("before, after", [
    ("a — b", "a, b"), ("a—b", "a, b"), ("— start", "start"), ("  keep — indent", "  keep, indent"), ("x -- y", "x, y"), ("end — .", "end."),
    ("```py\na — b\n```", "```py\na - b\n```"), ("```Visual\na — b\n```", "```Visual\na, b\n```"), ("a  b — c", "a  b, c")])
def test_dedash(draft, before, after):
    once = drafts.dedash(draft(before))
    assert once.first().md == after
    assert drafts.dedash(once).first().md == after


def test_dash_count_skips_code_only(draft):
    got = drafts.dash_count(draft("a — b\n```sh\nc — d\n```\n```VISUAL\ne – f -- g\n```")).first().dashes
    assert got == 3


@pytest.mark.parametrize("before, after", [
    ("a <!-- x --> b", "a  b"), ("a\n<!-- x -->\nb", "a\nb"), ("a\n\n<!-- x -->", "a\n"), ("a <!-- x\ny --> b", "a \n b"), ("<!-- x\ny -->\nb", "b"),
    ("```html\n<!-- keep -->\n```\n<!-- go -->", "```html\n<!-- keep -->\n```"), ("a <!-- never closed\nb", "a "), ("<!-- x\n```\n-->\nb", "b"), ("```js", "```js"),
    ("<!-- a -->", "")])
def test_strip_comments(draft, before, after):
    assert drafts.strip_comments(draft(before)).first().md == after


def test_projection(draft, spark):
    assets = spark.createDataFrame([("c", "m00-l0-x", 1, "v01-chart.webp")], "course_id string, stem string, n int, file string")
    prose, warnings = drafts.project_prose(draft("# T\n" + VISUAL + "\nmid\n" + VISUAL + "\n\n"), assets)
    assert prose.first().prose == ("# T\n![one two three four five six seven eight](assets/v01-chart.webp)\nmid\n"
                                   "> **Visual — T.** one two three four five six seven eight\n")
    assert [(w.n, w.title) for w in warnings.collect()] == [(2, "T")]


def test_single_pass_equals_separate_rules(draft):
    texts = draft("no title — here — now — x", "# T\n" + "word " * 800, VISUAL.replace("eight", "[eight]"), "# T\n```bash\nforge test\n```\n" + "One two three four five six seven eight nine ten eleven. " * 3)
    m = drafts.draft_metrics(texts)
    parts = [drafts.no_title(texts), drafts.visual_floor(m), drafts.visual_defects(texts), drafts.visual_quality(texts), drafts.prose_wall(m),
             drafts.tool_without_install(texts), drafts.dash_policy(drafts.dash_count(texts)), drafts.depth_band(m), drafts.paragraph_rhythm(texts)]
    separate = sorted(tuple(r) for p in parts for r in p.collect())
    assert sorted(tuple(r) for r in drafts.all_findings(texts).collect()) == separate
    assert {r[2] for r in separate} >= {"no_title", "dash_policy", "prose_wall", "bracket_in_alt", "tool_without_install", "paragraph_rhythm"}


def test_install_line_clears_the_tool(draft):
    assert drafts.tool_without_install(draft("```bash\n$ forge test\n```\nrun foundryup first", "the forge is hot", "```bash\nforgets\n```")).count() == 0


def test_rhythm_needs_a_developed_paragraph(draft):
    short = "One two three four five six seven eight nine ten eleven.\n\n" * 3
    long = "One two three. Four five six. Seven eight nine. Ten eleven twelve.\n\n"
    assert rules(drafts.paragraph_rhythm(draft(short))) == {("paragraph_rhythm", "advisory")}
    assert drafts.paragraph_rhythm(draft(long)).count() == 0
    # A list line does not end the paragraph around it.
    assert drafts.paragraphs(draft("One two three four. Five six\n- item\nseven eight nine ten eleven. Twelve.")).first().sentences == [3]


def test_code_blocks_and_kinds(draft):
    md = "```\nplain\n```\n```rust\npub a: u8,\n```\n```ts\nimport a from 'b'\n```\n```text\nx\n```\n```rs\nfn f(&self) {}\n```"
    rows = code.classify(code.extract_blocks(draft(md))).orderBy("n_all").collect()
    assert [(r.lang, r.n, r.kind) for r in rows] == [("rust", 1, "fields"), ("typescript", 1, "standalone"), ("rust", 2, "assoc")]


def test_long_bodies_do_not_exhaust_the_stack(draft):
    body = "\n".join(["x — y"] * 20000)
    one = draft(f"# T\n```visual\ntype: chart\n{body}\n```\n<!-- a\n{body}\n-->\n" + "\n" * 20000 + body)
    assert drafts.all_findings(one).count() > 0
    assert code.extract_blocks(one).count() == 0
    assert drafts.strip_comments(one).select(F.length("md")).first()[0] > 0


def test_worklist_numbers_specs(draft):
    assert visuals.visual_worklist(draft(VISUAL + "\n" + VISUAL)).orderBy("n").first().asset_id == "m00-l0-x/v01-chart"
