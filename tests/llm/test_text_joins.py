import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import jaccard_trie
from lectern.llm.bits import key_bits, maybe_in
from lectern.llm.components import components
from lectern.llm.decontaminate import contamination
from lectern.llm.words import ALPHANUMERIC, BLANK_SEPARATED, hash_words, text_blocks
from llm_kit import documents, lower, union_find, vocabulary


@pytest.mark.parametrize("table, pattern", [(BLANK_SEPARATED, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_those_of_the_pattern(table, pattern):
    texts = ["Ab cd\x0bEf", "", None, " x", "é-ß1 É", "a" * 5000, "\x1f\x00ab", "same same SAME", "tail "]
    for lo, hi, data, bounds in text_blocks(pa.array(["cut", *texts], pa.string()).slice(1)):
        hashes, first = hash_words(data, bounds, table)
        expected = [re.findall(pattern, lower(t)) for t in texts[lo:hi]]
        assert np.diff(first).tolist() == [len(w) for w in expected]
        flat = [w for ws in expected for w in ws]
        assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_components_match_union_find(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)] + [(7, None), (None, None), (9, 9)]
    got = {x.id: x.component for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    whole = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = union_find({n for x in whole for n in x}, whole)
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_filter_never_misses_a_key(spark):
    keys = spark.range(0, 5000, 3).withColumnRenamed("id", "k")
    rows = spark.range(5000).selectExpr("id AS k").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = {x.k: x._maybe for x in maybe_in(rows, "k", key_bits(keys, "k")).collect()}
    assert len(got) == 5001 and all(got[k] for k in range(0, 5000, 3)) and sum(got.values()) < 2000


def _contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    out = []
    for doc, text, *_ in docs:
        own, hit, met = words(text), set(), set()
        for item, other in items:
            theirs = words(other)
            n = min(13, len(theirs))
            if item is None or not n:
                continue
            windows = {tuple(theirs[i:i + n]) for i in range(len(theirs) - n + 1)}
            for i in range(len(own) - n + 1):
                if tuple(own[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    met.add(str(item))
        ids = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(met), ids, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


def test_decontamination_matches_brute_force(spark):
    r, vocab = random.Random(5), vocabulary(60)
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(r.randint(1, 40)))) for i in range(30)]
    items += [(100, items[3][1]), (101, None), (102, ""), (None, items[5][1]), (3, "another text of the same item id with more than thirteen words in it all told"),
              (104, "na " * 30), (105, vocab[0])]
    docs = []
    for i in range(150):
        words = say(r.randint(0, 80))
        if i % 2:
            theirs = (r.choice(items)[1] or "").split()
            a = r.randrange(max(1, len(theirs)))
            at = r.randrange(len(words) + 1)
            words[at:at] = theirs[a:a + r.randint(10, 20)]
        docs.append((i, (", " if i % 3 else " ").join(words).title()))
    docs += [(1000, None), (1001, ""), (7, docs[7][1]), (7, docs[9][1]), (None, docs[9][1]), (1002, "na " * 50), (1003, "x " * 3000 + items[0][1] + " y" * 3000),
             (1004, items[3][1])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    from pyspark.sql import functions as F
    got = contamination(documents(spark, docs, extra=True), table).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256), "contaminated")
    assert sorted(map(tuple, got.collect()), key=str) == _contamination(docs, items)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {tuple(x)[1:4] for x in contamination(documents(spark, docs[:3]), none).drop("item_ids").collect()} == {(len(re.findall(r"\w+", d[1])), 0, 0) for d in docs[:3]}
    assert contamination(documents(spark, []), table).count() == 0


def _similar(docs):
    sets = {}
    for i, (doc, text, *_) in enumerate(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[i] = {tuple(w[j:j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
    links = [(docs[a][0], docs[b][0]) for a in sets for b in sets if a < b and sets[a] and None not in (docs[a][0], docs[b][0])
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = union_find({d[0] for d in docs if d[0] is not None}, links)
    return sorted([(d[0], len(sets[i]), root.get(d[0])) for i, d in enumerate(docs)], key=str)


def _copies(seed, groups, most):
    """Groups of texts that differ in a few words, chained so that some members are similar through others only."""
    r, vocab, docs = random.Random(seed), vocabulary(400), []
    passage = [r.choice(vocab) for _ in range(60)]
    for g in range(groups):
        words = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 4, 5, 20, 60, 200, 700]))]
        for _ in range(r.randint(1, most)):
            docs.append((r.randrange(10 ** 9), " ".join(words)))
            for _ in range(r.choice([0, 1, 1, 3])):
                words[r.randrange(len(words))] = r.choice(vocab)
        docs.append((r.randrange(10 ** 9), " ".join(words[:30] + passage + words[30:])))
    return docs


def test_similarity_join_matches_brute_force(spark):
    docs = _copies(11, 25, 8)
    docs += [(5, None), (6, ""), (8, " \n"), (9, docs[0][1].upper()), (9, docs[0][1].upper()), (9, docs[40][1]), (None, docs[0][1]), (10, "one two"), (12, "ONE\ttwo")]
    got = jaccard_trie.similar_components(documents(spark, docs, extra=True))
    assert sorted(map(tuple, got.collect()), key=str) == _similar(docs)
    assert jaccard_trie.similar_components(documents(spark, [])).count() == 0


def test_sliced_centres_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_trie, "SLICE", 3)
    docs = _copies(12, 6, 25)
    got = jaccard_trie.similar_components(documents(spark, docs))
    assert sorted(map(tuple, got.collect()), key=str) == _similar(docs)


def test_trie_and_bins_keep_every_similar_pair():
    r = np.random.default_rng(4)
    for _ in range(30):
        base = np.unique(r.integers(0, 1 << 60, r.integers(1, 900), dtype=np.uint64))
        sets = []
        for _ in range(25):
            keep = base[r.random(len(base)) > r.choice([0.0, 0.03, 0.08, 0.16])]
            sets.append(np.unique(np.concatenate((keep, r.integers(0, 1 << 60, r.integers(0, 1 + len(base) // 10), dtype=np.uint64)))))
        sets = [s for s in sets if len(s)]
        links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))]
        ids = list(range(len(sets)))
        assert union_find(ids, jaccard_trie.spanning_links(ids, sets, ids)) == union_find(ids, links)
        group = jaccard_trie.possible_groups(np.array([len(s) for s in sets]), [jaccard_trie.binned(s) for s in sets])
        assert all(group[i] == group[j] for i, j in links)


def test_memory_in_work_is_bounded_by_the_block():
    import tracemalloc
    r = random.Random(2)
    column = pa.array([" ".join(str(r.randrange(10 ** 6)) for _ in range(300)) for _ in range(3000)])
    tracemalloc.start()
    n = sum(int(bounds[-1]) for _, _, _, bounds in jaccard_trie._shingled(column))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 3000 * 297 and most < 32_000_000  # 72 MB with blocks of 2 MB
