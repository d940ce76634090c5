"""Graph, quiz, state, publishing, code verdicts: small inputs with known answers, and brute force."""
import random
import time
from collections import Counter

import pytest

from lectern.operators import challenges, code, corpus, course, gate, graph, publish, quiz, state
from lectern.operators.order import number_within


def kahn(nodes, edges):
    """Depth per node that can be removed; the rest is left over."""
    nodes, edges = set(nodes), {(a, b) for a, b in edges if a in nodes and b in nodes}
    depth, level = {}, 0
    while True:
        free = {n for n in nodes - set(depth) if not any(b == n for _, b in edges)}
        if not free:
            return depth, nodes - set(depth)
        depth.update(dict.fromkeys(free, level))
        edges, level = {(a, b) for a, b in edges if a not in free}, level + 1


@pytest.mark.parametrize("limit", [1 << 16, 9, 0])
def test_peeling_matches_brute_force(spark, limit):
    rng = random.Random(3)
    nodes, edges, left, depth = [], [], set(), set()
    for c in range(12):
        ns = [f"n{i}" for i in range(rng.randint(2, 8))]
        es = [(rng.choice(ns), rng.choice(ns + ["ghost"])) for _ in range(rng.randint(0, 9))]
        d, rest = kahn(ns, es)
        nodes += [(c, n) for n in ns]
        edges += [(c, a, b) for a, b in es]
        left |= {(c, n) for n in rest}
        depth |= {(c, n, k) for n, k in d.items()}
    n, e = spark.createDataFrame(nodes, "course_id int, node string"), spark.createDataFrame(edges, "course_id int, src string, dst string")
    assert {tuple(r) for r in graph.cycle_leftovers(n, e, limit).collect()} == left
    assert {tuple(r) for r in graph.topo_depth(n, e, limit).collect()} == depth


def test_a_long_chain_and_the_order_of_a_queue(spark):
    chain = [f"n{i}" for i in range(200)]
    n = spark.createDataFrame([(1, x) for x in chain], "course_id int, node string")
    e = spark.createDataFrame([(1, a, b) for a, b in zip(chain, chain[1:])], "course_id int, src string, dst string")
    start = time.time()
    assert {r.node: r.depth for r in graph.topo_depth(n, e).collect()} == {x: i for i, x in enumerate(chain)}
    assert time.time() - start < 20
    rng = random.Random(9)
    for _ in range(200):
        nodes = [f"n{i}" for i in rng.sample(range(9), 7)] + ["n0"]
        edges = [(rng.choice(nodes), rng.choice([*nodes, "ghost"])) for _ in range(rng.randint(0, 9))]
        fed, queue, order = Counter(b for a, b in edges if a in nodes and b in nodes), [], []
        queue = [x for x in dict.fromkeys(nodes) if not fed[x]]
        while queue:
            order.append(queue[0])
            for a, b in edges:
                if a == queue[0] and b in nodes:
                    fed[b] -= 1
                    queue += [b] if not fed[b] else []
            queue = queue[1:]
        got = graph.settled(nodes, edges)
        assert [x for x, p, _ in sorted(got, key=lambda r: (r[1] is None, r[1])) if p is not None] == order
        assert {x: d for x, _, d in got if d is not None} == kahn(nodes, edges)[0]
    rows = spark.createDataFrame([("c", ["b", None, "a"], [["a", "b"], ["a"], None, [None, "b"], ["a", "x"]]), ("d", None, None)], "course_id string, nodes array<string>, edges array<array<string>>")
    assert sorted(map(tuple, graph.places(rows).collect())) == [("c", "a", 0, 0), ("c", "b", 1, 1)]


def test_no_edges_means_no_cycle(spark):
    n, e = spark.createDataFrame([(1, "a")], "course_id int, node string"), spark.createDataFrame([], "course_id int, src string, dst string")
    assert graph.cycle_leftovers(n, e).count() == 0
    assert [tuple(r) for r in graph.topo_depth(n, e).collect()] == [(1, "a", 0)]


def test_numbering_a_hot_course(spark):
    rng = random.Random(5)
    rows = [(0 if i % 3 else i, rng.randint(0, 2), rng.randint(-50, 400) if i % 5 else 7, i) for i in range(600)]
    got = number_within(spark.createDataFrame(rows, "course int, m int, o int, t int"), ["course"], ["m"], "o", ["t"], "pos").collect()
    want = {}
    for r in sorted(rows):
        want[r] = sum(1 for x in want if x[0] == r[0])
    assert {(r.course, r.m, r.o, r.t): r.pos for r in got} == want


def test_numbering_keeps_nulls_and_splits_a_hot_value(spark):
    rows = [(1, None, None, i) for i in range(50)] + [(None, 0, 3, i) for i in range(40)] + [(2, 1, 7, i) for i in range(2000)] + [(1, 0, None, 99)]
    df = spark.createDataFrame(rows, "course int, m int, o int, t int")
    got = number_within(df, ["course"], ["m"], "o", ["t"], "pos").collect()
    for course in (1, None, 2):
        own = sorted((r for r in got if r.course == course), key=lambda r: r.pos)
        assert [r.pos for r in own] == list(range(len(own)))
        assert [r.t for r in own if r.m == own[0].m] == sorted(r.t for r in own if r.m == own[0].m)
    assert len(got) == len(rows)


OPTION = "array<struct<id:string,label:string,correct:boolean,feedback:string>>"


def questions(spark, rows):
    return spark.createDataFrame(rows, f"course_id string, lesson_id string, block int, q_pos int, question string, q_id string, prompt string, multi boolean, options {OPTION}, explanation string")


def one(i, labels, right, multi=False):
    return ("c", "l", 0, i, f"l#{i}", f"q{i}", "why", multi, [(str(k), x, k in right, "no") for k, x in enumerate(labels)], "so")


def test_ties_count_only_in_the_report(spark):
    q = questions(spark, [one(i, ["aa", "aa", "b"], {0}) for i in range(6)] + [one(9, ["aaaa", "b"], {0}, multi=True)])
    assert quiz.longest_tell(q).count() == 0
    report = quiz.quiz_report(q).first()
    assert (report.questions, report.longest, report.longest_pct, report.spread) == (6, 6, 100, "1:6")
    skew = quiz.slot_skew(q).first()
    assert (skew.subject, skew.detail) == ("slot 1", "6/6")


def test_merge_refuses_a_moved_answer(spark):
    schema = f"course_id string, lesson_id string, quiz_blocks array<struct<key:string,questions:array<struct<id:string,options:{OPTION}>>>>"
    def blocks(label, right):
        return [("k", [("q", [("a", label, right, None), ("b", "y", not right, None)])])]
    current = spark.createDataFrame([("c", "l1", blocks("x", True)), ("c", "l2", blocks("x", True)), ("d", "l1", blocks("x", True))], schema)
    edited = spark.createDataFrame([("c", "l1", blocks("new", True)), ("c", "l2", blocks("x", False)), ("d", "l1", blocks("new", True))], schema)
    merged, refused, report = quiz.merge_quiz(current, edited)
    label = {(r.course_id, r.lesson_id): r.quiz_blocks[0].questions[0].options[0].label for r in merged.collect()}
    assert label == {("c", "l1"): "x", ("c", "l2"): "x", ("d", "l1"): "new"}
    assert [(r.course_id, r.lesson_id) for r in refused.collect()] == [("c", "l2")]
    assert {r.course_id: (r.refused, r.merged, r.changed) for r in report.collect()} == {"c": (1, 0, 0), "d": (0, 1, 1)}


def test_contract_needs_results(spark):
    rows = [("a", "solution", 1, True), ("a", "starter", 1, False), ("b", "solution", 1, True), ("b", "starter", 1, True), ("c", "starter", 1, False), ("d", "solution", 1, False), ("d", "starter", 1, False)]
    got = {r.challenge: r.verdict for r in challenges.contract_verdict(spark.createDataFrame(rows, "challenge string, role string, case_id int, ok boolean")).collect()}
    assert got == {"a": "PASS", "b": "FAIL", "c": "FAIL", "d": "FAIL"}


def test_slots_are_stable_and_never_reused(spark):
    lessons = lambda *ids: spark.createDataFrame([("c", x, i) for i, x in enumerate(ids)], "course_id string, publish_id string, lesson_pos int")
    none = spark.createDataFrame([], "course_id string, publish_id string, slot bigint, retired boolean")
    slots, retired = publish.assign_slots(lessons("a", "b", "c"), none)
    first = {r.publish_id: r.slot for r in slots.collect()}
    assert first == {"a": 0, "b": 1, "c": 2} and retired.count() == 0
    previous = spark.createDataFrame([("c", k, v, False) for k, v in first.items()], none.schema)
    slots, retired = publish.assign_slots(lessons("new", "a", "b"), previous)
    assert {r.publish_id: r.slot for r in slots.collect()} == {"a": 0, "b": 1, "new": 3}
    assert [r.slot for r in retired.collect()] == [2]
    again = spark.createDataFrame([("c", "a", 0, False), ("c", "b", 1, False), ("c", "new", 3, False), ("c", None, 2, True)], none.schema)
    slots, _ = publish.assign_slots(lessons("new", "a", "b", "late"), again)
    assert {r.publish_id: r.slot for r in slots.collect()} == {"a": 0, "b": 1, "new": 3, "late": 4}


def test_drift_is_idempotent(spark):
    files = lambda *rows: spark.createDataFrame(list(rows), "course_id string, path string, content string")
    planned = files(("c", "a", "1"), ("c", "b", "2"))
    lock = state.drift(planned, files(("x", "x", "x")), spark.createDataFrame([], "course_id string, path string, sha256 string"))
    assert {(r.path, r.action) for r in lock.collect()} == {("a", "write"), ("b", "write")}
    again = state.drift(planned, planned, lock)
    assert {(r.path, r.action, r.sha256) for r in again.collect()} == {(r.path, "write", r.sha256) for r in lock.collect()}
    edited = state.drift(planned, files(("c", "a", "mine"), ("c", "b", "2")), lock)
    assert {r.path: (r.action, r.edited_by_human) for r in edited.collect()} == {"a": ("skip", True), "b": ("write", False)}


def test_triage_order(spark):
    block = lambda n, kind, lang="rust": ("c", "s", lang, n, kind)
    blocks = spark.createDataFrame([block(1, "body"), block(2, "body"), block(3, "standalone"), block(4, "body"), block(5, "body"), block(6, "body"), block(1, "fragment", "typescript")],
                                   "course_id string, stem string, lang string, n int, kind string")
    msgs = [("rust", 2, 0, "error[E0282]: type annotations needed"), ("rust", 3, 0, "error[E0282]: type annotations needed"), ("rust", 4, 0, "error[E0282]: x"), ("rust", 4, 1, "error[E0308]: real"),
            ("rust", 5, 0, "error[E0599]: `__Block`"), ("rust", 6, 0, "error[E0433]: failed to resolve"), ("typescript", 1, 0, "error TS7006: any")]
    diags = spark.createDataFrame([("c", "s", *m) for m in msgs], "course_id string, stem string, lang string, n int, seq int, msg string")
    verdicts = code.triage(blocks, diags)
    got = {(r.lang, r.n): r.status for r in verdicts.collect()}
    assert got == {("rust", 1): "PASS", ("rust", 2): "SKIP", ("rust", 3): "FAIL", ("rust", 4): "FAIL", ("rust", 5): "SKIP", ("rust", 6): "SKIP", ("typescript", 1): "WARN"}
    lifted = {(r.lang, r.n): r.status for r in code.upgrade(verdicts, blocks.filter("n > 1 and n <> 2"), diags.filter("n = 5")).collect()}
    assert lifted[("rust", 6)] == "PASS" and lifted[("rust", 5)] == "SKIP" and lifted[("rust", 3)] == "FAIL" and lifted[("rust", 2)] == "SKIP"


def test_expectation_is_lost_to_another_fence(spark):
    md = "<!-- verify: expect-fail why -->\n```ts\na\n```\n<!-- verify: expect-fail -->\n```bash\nx\n```\n```ts\nb\n```\n<!-- VERIFY: expect-fail -->\n\n```rs\nc\n```"
    got = code.expectations(spark.createDataFrame([("c", "s", md)], "course_id string, stem string, md string")).collect()
    assert {(r.lang, r.n, r.reason) for r in got} == {("typescript", 1, "why"), ("rust", 1, "declared expect-fail")}


def test_cargo_ties_go_to_the_higher_version(spark):
    specs = spark.createDataFrame([("c", "clap", "2.33.1"), ("c", "clap", "4.6"), ("c", "x", "1.9"), ("c", "x", "1.10")], "course_id string, pkg string, ver string")
    assert {r.pkg: (r.ver, r.versions) for r in code.harvest_pins(specs, "cargo").collect()} == {"clap": ("4.6", 2), "x": ("1.10", 2)}


@pytest.mark.parametrize("ask, form", [("Write a blog post about fees", "explainer"), ("a thread on fees", "post"), ("Slides for my talk", "slides"), ("how do I build a vault", "tutorial"),
                                       ("why fees should rise", "essay"), ("post this", None), ("a curriculum", "course")])
def test_route(spark, ask, form):
    assert corpus.route_form(spark.createDataFrame([(ask,)], "ask string")).first().form == form


def test_gate_lists_clean_courses(spark):
    flags = spark.createDataFrame([("a", "x", "r", "HARD", "", ""), ("b", "x", "r", "advisory", "", "")], "course_id string, check_name string, rule string, severity string, subject string, detail string")
    got = {r.course_id: r.verdict for r in gate.gate(flags, spark.createDataFrame([("a",), ("b",), ("c",)], "course_id string")).collect()}
    assert got == {"a": "FAIL", "b": "PASS", "c": "PASS"}


def test_band_is_carried_over_unset_modules(spark):
    mods = spark.createDataFrame([("c", "a", 0, 1, 2), ("c", "b", 1, 2, None), ("c", "d", 2, None, 3), ("c", "e", 3, 1, 1)], "course_id string, module_id string, pos int, rung int, band int")
    assert [r.subject for r in course.band_dip(mods).collect()] == ["e"]
    assert [r.detail for r in course.ladder_backward(mods).collect()] == ["1<2"]


def test_catalog_table_and_list(spark):
    from lectern.sources.files import parse_catalog
    md = "# C\n\n1. **One** — Org — https://a.b/c — (2024) — Why it\n   matters — truly.\n\n| # | T | A | U | Y | W |\n|---|---|---|---|---|---|\n| 2 | Two | Org | https://d.e | 2023 | w |\n"
    rows = parse_catalog(spark.createDataFrame([("essays", md)], "form string, md string")).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [("essays", 1, "One", "Org", "https://a.b/c", 2024, "Why it matters — truly."), ("essays", 2, "Two", "Org", "https://d.e", 2023, "w")]
