import math
import random
import textwrap
import zlib

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import pq_dedup
from lectern.llm.license_scan import TEMPLATES, Scanner, scanned
from lectern.llm.pq_dedup import Index, near_duplicates
from lectern.llm.queries import Q
from lectern.llm.toxicity import Restorer, costs_of, fit, scorer, trigram_counts
from llm_kit import documents, union_find, vocabulary

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def _auc(points):
    points = sorted(points)
    ranks, i = {}, 0
    while i < len(points):
        j = i
        while j < len(points) and points[j][0] == points[i][0]:
            j += 1
        for k in range(i, j):
            ranks[k] = (i + j + 1) / 2
        i = j
    pos = [ranks[k] for k, p in enumerate(points) if p[1]]
    return (sum(pos) - len(pos) * (len(pos) + 1) / 2) / (len(pos) * (len(points) - len(pos)))


def test_held_out_toxicity(spark):
    rows = Q["op1_toxicity"](spark, LARGER).collect()
    labels = {x.doc_id: x.toxic for x in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and 0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in rows)
    held = [(x.score, labels[x.doc_id]) for x in rows if x.held_out and x.doc_id in labels]
    assert len(held) > 500 and _auc(held) > 0.97
    assert sum(x.predicted for x in rows if labels.get(x.doc_id) == 0) <= 5


def test_obfuscated_words_are_restored(spark):
    words = vocabulary(200, 3)
    r = random.Random(1)
    bad = ["stupid", "moron", "pathetic", "worthless", "disgusting", "idiot"]
    texts = [" ".join(r.choice(words + bad) for _ in range(60)) for _ in range(200)]
    read = Restorer(costs_of(trigram_counts(documents(spark, list(enumerate(texts))))))
    for shown, meant in [("m0r0n", "moron"), ("p4th3t1c", "pathetic"), ("5tup1d", "stupid"), ("w0rthl3ss", "worthless"), ("stuuuupid", "stupid"),
                         ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("d1sgust!ng", "disgusting"), ("STUPID!", "stupid")]:
        assert meant in read(f"so {shown} it is"), (shown, read(f"so {shown} it is"))
    for plain in ["123 456", "call 0800 1234", "no change here", "", "a b", "www"]:
        assert read(plain) in (plain, "w" if plain == "www" else plain, "ww" if plain == "www" else plain)
    assert len(read("a1" * 20000)) > 0


def test_counts_do_not_depend_on_the_split(spark):
    texts = ["a stupid " * 40 + str(i) for i in range(400)] + ["", None]
    one, many = (trigram_counts(documents(spark, list(enumerate(texts))).repartition(n)) for n in (1, 7))
    assert (one == many).all() and one.sum() == sum(len(t) + 2 for t in texts if t)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(1, 200)] + [(None, 0, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, [(i, f"plain words {'trash trash' if i % 2 == 0 else 'fine day'} number w{i}x") for i in range(1, 200)] +
                     [(500, None), (501, ""), (None, "trash"), (502, "tr4sh talk"), (2, "trash again"), (503, "x " * 100000)], extra=True)
    score = scorer(fit(docs, labels))
    got = {(x.doc_id, x.s) for x in docs.select("doc_id", score(F.col("text")).alias("s")).collect()} if "TEXT" not in docs.columns else \
        {(x[0], x[1]) for x in docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select("c0", score("c1")).collect()}
    scores = dict(got)
    assert scores[500] == scores[501] == scores[503] < 0.5 < min(scores[502], scores[None], scores[2])
    none = scorer(fit(docs, spark.createDataFrame([], labels.schema)))
    assert {x[0] for x in documents(spark, [(1, "trash"), (2, None)]).select(none("text")).collect()} == {0.0}
    assert documents(spark, []).select(score("text")).count() == 0


def _linked(rows):
    def unit(e):
        if not e or any(v is None or not math.isfinite(v) for v in e) or not any(e):
            return None
        x = np.array(e, float) / np.abs(np.array(e, float)).max()
        return x / np.sqrt(x @ x)
    x = [unit(e) if lab is not None else None for _, e, lab in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2]
             and len(x[i]) == len(x[j]) and x[i] @ x[j] >= 0.98]
    n = [0] * len(rows)
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    root = union_find({r[0] for r in rows if r[0] is not None}, [(rows[i][0], rows[j][0]) for i, j in pairs if None not in (rows[i][0], rows[j][0])])
    return sorted([(r[0], n[i], root.get(r[0]), r[0] is not None and root[r[0]] == r[0]) for i, r in enumerate(rows)], key=str)


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").select("*", F.lit(1).alias("h1"), F.lit(2).alias("VEC_ID"))


def test_embedding_links_match_brute_force(spark, monkeypatch):
    r = np.random.default_rng(2)
    rows = []
    for g in range(40):
        base = r.normal(size=20)
        for _ in range(r.integers(1, 12)):
            base = base + r.normal(size=20) * r.choice([0.0, 0.05, 0.14])
            rows.append((len(rows), [float(np.float32(v)) for v in base], int(g % 3)))
    rows += [(900, rows[0][1], 1), (901, [0.0] * 20, 0), (902, None, 0), (903, [], 0), (904, [None] + rows[0][1][1:], 0), (905, [float("nan")] * 20, 0),
             (906, [float("inf")] * 20, 0), (907, rows[0][1], None), (908, [2 * v for v in rows[0][1]], 0), (909, rows[0][1][:10], 0), (3, rows[3][1], rows[3][2]),
             (910, rows[0][1] + [0.0], 0)]
    want = _linked(rows)
    assert sorted(map(tuple, near_duplicates(_table(spark, rows)).collect()), key=str) == want
    monkeypatch.setattr(pq_dedup, "SLICE", 2)
    assert sorted(map(tuple, near_duplicates(_table(spark, rows)).collect()), key=str) == want
    assert near_duplicates(_table(spark, [])).count() == 0
    assert [tuple(x) for x in near_duplicates(_table(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]


def test_probes_are_sufficient():
    r = np.random.default_rng(5)
    x = r.normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = Index(x[:2000], 16)
    own, _, _ = index.encode(x)
    near = x + r.normal(size=x.shape) * 0.045
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    pairs = (x * near).sum(1) >= pq_dedup.THRESHOLD
    other, _, _ = index.encode(near)
    probes = index.probes(x, own)
    assert pairs.sum() > 500 and (other != own)[pairs].sum() > 20 and probes[np.arange(len(x)), other][pairs].all()
    assert probes.mean() < 0.9


def test_licenses_by_wording(spark):
    scanner = Scanner(TEMPLATES)
    for name, text in TEMPLATES.items():
        assert scanner.scan(text)[:2] == ("exact", name)
    assert scanner.scan("This work is licenced under the GNU General Public License, version 3.")[:2] == ("close", "GPL-3.0-notice")
    assert scanner.scan("Foo bar. Released under the MIT License. Thanks")[:2] == ("exact", "MIT-notice")
    assert scanner.scan("copyright of some other kind")[0] == "unknown"
    assert scanner.scan("Licensed under CC BY-NC 4.0.")[1] == "CC-BY-NC-4.0"
    docs = [(1, "Prose.\nReleased under the MIT License.\nmore\n\nLicensed under CC BY-NC 4.0."), (2, None), (3, ""), (4, "nothing here"),
            (None, "Released under the MIT License."), (1, "Released under the MIT License."), (5, "word " * 200000 + "\nReleased under the MIT License.")]
    got = sorted([(x.doc_id, x.block_no, x.license) for x in scanned(documents(spark, docs, extra=True)).collect()], key=str)
    assert got == sorted([(1, 0, "MIT-notice"), (1, 1, "CC-BY-NC-4.0"), (None, 0, "MIT-notice"), (1, 0, "MIT-notice"), (5, 0, "MIT-notice")], key=str)
    assert scanned(documents(spark, [])).count() == 0


def test_every_license_line_is_found(spark):
    """Brute force over whole texts: each notice that stands in a document is reported, and nothing else."""
    want = {(x.doc_id, name) for x in spark.read.parquet(f"{SF}/documents.parquet").collect() for name, t in TEMPLATES.items() if t in x.text.split("\n")}
    rows = Q["op5_license_scan"](spark, SF).collect()
    got = {(x.doc_id, x.license) for x in rows if x.status == "exact"}
    assert want and want <= got and all(x.status != "exact" or x.license for x in rows)


def test_wrapped_and_adjacent_licenses(spark):
    docs, want = [], []
    for name, text in TEMPLATES.items():
        for mark in ("", "# ", " * ", "REM "):
            wrapped = "\n".join(mark + line for line in textwrap.wrap(text, 60, break_on_hyphens=False))
            want.append((len(docs), 0, name))
            docs.append((len(docs), f"Some prose.\n\n{wrapped}\n\n" + "prose and code " * 300))
    n = len(docs)
    mit = textwrap.fill(TEMPLATES["MIT"].replace("merge, ", ""), 80).replace("The above", "\n\nThe above")
    docs += [(n, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."), (n + 1, "Released under the MIT License. Licensed under the Apache License, Version 2.0."),
             (n + 2, "\n".join(textwrap.wrap(TEMPLATES["GPL-3.0"], 80) + textwrap.wrap(TEMPLATES["LGPL-2.1"], 80))),
             (n + 3, f"Copyright (c) 2020 X\n\n{mit}\n\nprose"), (n + 4, "\n".join(["Released under the MIT style License."] * 200)),
             (n + 5, "Released\nin 2004, this tool came under many eyes, and the\nMIT saw it.\nNo license is given.")]
    want += [(n, 0, "MIT-notice"), (n, 0, "CC-BY-NC-4.0"), (n + 1, 0, "MIT-notice"), (n + 1, 0, "Apache-2.0-notice"), (n + 2, 0, "GPL-3.0"), (n + 2, 1, "LGPL-2.1"),
             (n + 3, 0, None), (n + 3, 1, "MIT"), *[(n + 4, 0, "MIT-notice")] * 200, (n + 5, 0, None)]
    rows = scanned(documents(spark, docs)).collect()
    assert sorted([(x.doc_id, x.block_no, x.license) for x in rows], key=str) == sorted(want, key=str)
    assert {x.status for x in rows if x.doc_id < n and x.doc_id % 4 < 3} == {"exact"} and {x.status for x in rows if x.doc_id == n + 4} == {"close"}


def test_a_notice_word_for_word_is_confirmed_by_compression():
    from lectern.llm.license_scan import words
    scanner, own, asked = Scanner(TEMPLATES), words("ours " + TEMPLATES["ISC"] + " end"), []
    scanner.saved = lambda part, name, real=scanner.saved: asked.append((len(part), name)) or real(part, name)
    (lo, hi, name, saved, changes), = scanner.exact(own, [1] * len(own))
    assert (lo, hi, name, changes) == (1, len(own) - 1, "ISC", []) and saved > 0 and (hi - lo, "ISC") in asked
    scanner.saved = lambda part, name: 0.0
    assert scanner.exact(own, [1] * len(own)) == []


def test_every_licence_line_of_a_block_is_in_a_row(spark):
    """Lines and parts of lines that speak of other licences than the notices beside them are rows too."""
    isc, bsd = TEMPLATES["ISC"], TEMPLATES["BSD"]
    docs = [(0, "Released under the MIT License.\nThe Foo License holds too.\nmore"), (1, "Copyright X\n# Foo licence 3\n" + isc + "\nThe BAZ license holds.\n\nprose"),
            (2, "Foo License 3. Released under the MIT License. See the Bar licence, too. Licensed under CC BY 4.0. Thanks"),
            (3, "Foo license.\nRedistributions\n" + bsd.removeprefix("Redistribution ")), (4, "x\nReleased under the MIT License. Thanks\ny")]
    got = {}
    for x in scanned(documents(spark, docs)).collect():
        got.setdefault(x.doc_id, []).append((x.block_no, x.license, x.block))
    assert got == {
        0: [(0, "MIT-notice", "Released under the MIT License."), (0, None, "The Foo License holds too.")],
        1: [(0, None, "Copyright X\n# Foo licence 3"), (0, "ISC", isc), (0, None, "The BAZ license holds.")],
        2: [(0, None, "Foo License 3. "), (0, "MIT-notice", "Released under the MIT License. "), (0, None, "See the Bar licence, too. "),
            (0, "CC-BY-4.0", "Licensed under CC BY 4.0. Thanks")],
        3: [(0, None, "Foo license."), (0, "BSD", "Redistributions\n" + bsd.removeprefix("Redistribution "))],
        4: [(0, "MIT-notice", "Released under the MIT License. Thanks")]}
    assert Scanner(TEMPLATES).scan("Foo license. Released under the MIT License.")[:2] == ("exact", "MIT-notice")


def test_damaged_copies_of_one_notice_are_told_apart():
    scanner, w = Scanner(TEMPLATES), TEMPLATES["GPL-3.0"].split()
    first, second = " ".join([*w[:22], "X", *w[23:]]), " ".join([*w[:20], "Y", *w[21:]])
    for a, b in ((first, second), (second, first)):
        for between in (" ", "\nwords between\n"):
            text = a + between + b
            rows = scanner.scan_text(text, [i for i, x in enumerate(text.split("\n")) if "License" in x])
            assert [(x[2], x[3], len(x[5])) for x in rows] == [("close", "GPL-3.0", 2)] * 2
    lone = "\n".join(f"REM {x}" for x in "one two three four five six seven eight nine ten aa bb cc dd ee ff gg hh ii License".split())
    assert Scanner({"L": lone.replace("REM ", "").replace("\n", " ")}).scan_text(lone.replace("nine", "nine of"), [19])[0][3] == "L"
