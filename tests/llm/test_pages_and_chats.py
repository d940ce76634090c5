import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.llm import url_tree
from lectern.llm.chat_events import final_messages, read_back, rendered, unescape
from lectern.llm.html_layout import extracted, html_text
from lectern.llm.page_queries import RULES
from lectern.llm.queries import Q
from lectern.llm.url_tree import host_and_path, judged

EVENT = "conv_id bigint, seq bigint, part int, kind string, message string, role string, text string"


def _host_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def _rule(host, path):
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len) if fits else None


def _judge(rows, labels):
    """(page_id, verdict, template) by the tree, branch point by branch point."""
    worst = {}
    for p, b in labels:
        if p is not None and b is not None:
            worst[p] = max(b, worst.get(p, 0))
    pages = [[p, *_host_path(u), worst.get(p), ""] for p, u in rows]
    for level in range(url_tree.DEPTH):
        part = {id(x): ([s for s in x[2].split("/") if s] + ["$"] * (level + 1))[level] if len([s for s in x[2].split("/") if s]) > level else "$" for x in pages}
        points: dict = {}
        for x in pages:
            points.setdefault((x[1], x[4]), {}).setdefault(part[id(x)], []).append(x[3])
        named = {}
        for point, kinds in points.items():
            every = [b for v in kinds.values() for b in v]
            lab = [b for b in every if b is not None]
            share = sum(lab) / len(lab) if lab else 0.0
            for k, v in kinds.items():
                own = [b for b in v if b is not None]
                variable = len(kinds) >= url_tree.VARIETY and len(every) < url_tree.REPEATS * len(kinds) and len(v) < url_tree.SHARE * len(every)
                similar = len(own) < url_tree.LABELS or abs(sum(own) / len(own) - share) <= url_tree.Z * (share * (1 - share) / len(own)) ** 0.5
                named[point, k] = "*" if len(kinds) > 1 and k != "$" and (variable or similar) else k
        for x in pages:
            k = named[(x[1], x[4]), part[id(x)]]
            x[4] += "" if k == "$" else "/" + k
    for x in pages:
        if len([s for s in x[2].split("/") if s]) > url_tree.DEPTH:
            x[4] += "/**"
    smooth = lambda bad, prior: (len(bad) - sum(bad) + url_tree.SMOOTH * prior) / (len(bad) + url_tree.SMOOTH)
    labelled = lambda keep: [x[3] for x in pages if x[3] is not None and keep(x)]
    every = smooth(labelled(lambda x: True), 1.0)
    out = []
    for p, host, path, _, template in pages:
        prior = smooth(labelled(lambda x: x[1] == host), every)
        purity = smooth(labelled(lambda x: (x[1], x[4]) == (host, template)), prior)
        rule = _rule(host, path)
        out.append((p, host, path, rule, RULES[rule] if rule else "block" if purity < url_tree.PURITY else "allow", template))
    return sorted(out, key=str)


def test_urls_match_brute_force(spark):
    r = random.Random(4)
    hosts = ["a.example.com", "B.example.org", "example.org", "hot.net", "hot.net", "hot.net", "org", "notorg"]
    rows = [(i, f"https://{r.choice(hosts)}{r.choice(['', '/en', '/fr', '/spam', '/es/x', '/de', '/u'])}/{r.randrange(40)}{r.choice(['', '.html', '/', '/a/b/c', '?q=/x', '#/f'])}")
            for i in range(900)]
    rows += [(1000, None), (1001, ""), (1002, "no scheme/en"), (1003, "https://"), (1004, "x://H?q"), (1005, "x://h#a/b://c"), (None, "http://hot.net/en/1"),
             (3, rows[3][1]), (1006, "http://example.org/en/17"), (1007, "http://sub.org/"), (1008, "http://org?x"), (1009, "s://h/" + "long/" * 5000)]
    labels = [(i, 1 if "/spam" in (u or "") and r.random() < 0.95 else int(r.random() < 0.05)) for i, u in rows if i and i % 2] + [(None, 1), (5, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").select("*", F.lit(0).alias("URL"), F.lit("h").alias("host"), F.lit(1).alias("n"))
    got = judged(pages, spark.createDataFrame(labels, "page_id bigint, bad int"), RULES)
    got = sorted([tuple(x)[:6] for x in got.collect()], key=str)
    assert got == _judge(rows, labels)
    assert any(v == "block" and rule is None for _, _, _, rule, v, _ in got)
    none = spark.createDataFrame([], "page_id bigint, bad int")
    assert {x.verdict for x in judged(pages, none, {}).collect()} == {"allow"}
    assert judged(spark.createDataFrame([], "page_id bigint, url string"), none, RULES).count() == 0


def test_url_query_reads_rules(spark):
    rows = Q["op3_url_filter"](spark, "/root/testdata/sf0.01").collect()
    urls = {x.page_id: x.url for x in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()}
    assert len(rows) == len(urls)
    for x in rows:
        assert (x.host, x.path) == _host_path(urls[x.page_id]) and x.rule == _rule(x.host, x.path) and (x.rule is None or x.verdict == RULES[x.rule])


def test_host_of_odd_urls(spark):
    df = spark.createDataFrame([("HTTP://ÄB.Com:80/P?q",)], "u string")
    assert tuple(df.select(*host_and_path(F.col("u"))).first()) == ("Äb.com:80", "/P")


def _events(spark, rows):
    return spark.createDataFrame(rows, EVENT).select("*", F.lit(1).alias("turn"), F.lit("x").alias("ROLE"))


def test_events_fold_into_messages(spark):
    rows = [(1, 0, 0, "start", "a", "user", "Hel"), (1, 1, 0, "delta", "a", None, "lo"), (1, 2, 0, "start", "b", "assistant", None), (1, 3, 0, "delta", "b", None, "wrong"),
            (1, 4, 0, "start", "c", "user", "so?"), (1, 5, 0, "regenerate", "b", None, None), (1, 6, 0, "delta", "b", None, "right"), (1, 7, 0, "edit", "a", None, "Bye"),
            (1, 8, 0, "start", "d", "user", "gone"), (1, 9, 0, "delete", "d", None, None), (1, 10, 0, "delta", "nobody", None, "lost"), (1, 11, 0, "edit", "nobody", "user", "lost"),
            (2, 5, 0, "delta", "z", "system", "made by delta"), (None, 1, 0, "start", "q", None, None), (3, 0, 0, "start", "m", "user", "x"), (3, 0, 0, "start", "m", "user", "x"),
            (4, 0, 0, "delete", "x", None, None)]
    got = sorted([tuple(x) for x in final_messages(_events(spark, rows)).collect()], key=str)
    assert got == sorted([(1, 0, "user", "Bye"), (1, 1, "assistant", "right"), (2, 0, "system", "made by delta"), (None, 0, "", ""), (3, 0, "user", "x")], key=str)
    assert final_messages(_events(spark, [])).count() == 0


def test_hostile_texts_round_trip(spark):
    r = random.Random(9)
    bits = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "\n", "a", "é", "😀", "<\\|im_end|>", "assistant"]
    messages = [(c, t, r.choice(["user", "assistant", "system", "as\\sis\ntant", "<|im_end|>\n", ""]), "".join(r.choice(bits) for _ in range(r.randrange(12))))
                for c in range(60) for t in range(r.randint(1, 6))] + [(99, 0, "assistant", "z<|" * 100000), (98, 0, None, None)]
    shown = rendered(spark.createDataFrame(messages, "conv_id bigint, turn bigint, role string, text string"))
    got = {x.conv_id: x for x in read_back(shown).collect()}
    for c in {m[0] for m in messages}:
        own = sorted(m for m in messages if m[0] == c)
        turns = "".join(f"{m[2] or ''}\n{m[3] or ''}\n" for m in own)
        loss = "".join(m[3] for m in own if m[2] == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert all("<|" not in x.chunk[len("<|im_start|>"):-len("<|im_end|>\n")] for x in shown.collect())
    assert unescape("<\\\\|") == "<\\|" and unescape("<\\a") == "<\\a"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("a < b & c &amp; d", "a < b & c & d"), ("<p>One<p>Two", "One\n\nTwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("x<!-- y <p> -->z<script>var t='</p>';</script>w", "xzw"), ("<title>t</title><style>p{}</style><body>b", "b"),
    ("<p>a  \n b<br>c</p>", "a b\nc"), ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e", "- a\n- b\n  3. c\n  4. d\n\ne"),
    ("<table><tr><th>Name<th>N<tr><td>x<td>10<tr><td>long one</table>", "Name     | N\nx        | 10\nlong one"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide  | z\na | b | c"),
    ("a<span hidden>no</span><i style='display: none'>no</i><b style='visibility:hidden'>no<u style='visibility:visible'>yes</u></b>", "ayes"),
    ("</p>x</div></b>y", "xy"), ("<b>un<p>closed", "un\n\nclosed"), ("<a href='>'>q</a>", "q"), ("<", "<"), ("<p", ""), ("<td>cell</td> after", "cell after"),
    ("<h1>H</h1>t<hr>u", "H\n\nt\n\nu"), ("<select><option>a<option>b</select>", "a\nb"), ("<textarea><b>x</textarea>", "<b>x"),
    ("<head><meta x><p>in body", "in body"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"), ("<table><tr><td>a<table><tr><td>i</table></table>", "a i")])
def test_layout(html, text):
    assert html_text(html) == text


def test_pages_keep_all_visible_text(spark):
    """A plain reader's words (no tags, no hidden elements) are those of the layout, in order, for every page."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    got = {x.page_id: x.text for x in Q["op8_html_text"](spark, "/root/testdata/sf0.01").collect()}
    import html as entities
    for p in pages:
        body = re.sub(r"(?is)<!--.*?-->|<(script|style|title|noscript|template)\b.*?</\1\s*>", "", p.html or "")
        plain = entities.unescape(re.sub(r"(?s)<[/!a-zA-Z][^>]*>", " ", body))
        shown = re.sub(r"(?m)^\s*(- |\d+\. )", "", got[p.page_id]).replace(" | ", " ")
        squeeze = lambda s: re.sub(r"\s+|- |\|", "", s)
        assert squeeze(shown).replace("-", "") == squeeze(plain).replace("-", ""), p.page_id
    deep = "<div>" * 20000 + "x" + "<b>" * 20000
    rows = spark.createDataFrame([(1, None), (2, ""), (None, "<p>a"), (2, ""), (3, deep), (4, "<p>y " * 30000)], "page_id bigint, html string")
    assert sorted([(x.page_id, len(x.text)) for x in extracted(rows.select("*", F.lit(1).alias("HTML"), F.lit(2).alias("text"))).collect()], key=str)[:2] == [(1, 0), (2, 0)]
    assert extracted(rows.limit(0)).count() == 0
