"""Packing, source audit and conversation trie against plain versions."""
import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lectern.llm import conversation_trie, source_audit
from lectern.llm.conversation_trie import DoubleArray, pack, prefix_trie, turn_paths, walk
from lectern.llm.harmonic_packing import cut_plan, encoder, packed_pieces, sequences
from lectern.llm.structure_queries import rebuilt
from llm_kit import lower, vocabulary

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string"
CLASH = {"TEXT": "1", "n": "2", "_part": "'x'", "term": "'y'", "_doc": "0", "path": "3"}
CLASH = [f"{v} AS {k}" for k, v in CLASH.items()]


# -- packing

def _check_packing(rows, texts, capacity, slack):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for x in rows:
        by_doc[x.doc_id].append(x)
        by_sequence[x.sequence_id].append(x)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids, at = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for x in sorted(by_doc[doc], key=lambda x: x.start):
            assert x.start == at and x.doc_tokens == len(ids) and bytes(x.ids) == ids[at:at + x.length].tobytes()
            at += x.length
        assert at == len(ids)
    whole = padding = 0
    for own in by_sequence.values():
        at = 0
        for x in sorted(own, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert 0 < at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
        whole += at
    assert padding * capacity <= slack * (whole + padding)


@pytest.mark.parametrize("slack", [0, 16])
def test_packing_holds_every_token_once(spark, slack):
    r, vocab = random.Random(1), vocabulary(500)
    texts = {i: " ".join(r.choice(vocab) for _ in range(r.choice([1, 7, 60, 900, 3000]))) for i in range(150)}
    texts |= {900: None, 901: "", 902: " " * 5000, 903: "a" * 200000, 904: "x<|endoftext|>y", 905: "né " * 60000, 906: " \n end   x "}
    df = spark.createDataFrame([(k, v, "en", "s") for k, v in texts.items()], DOCS).repartition(3).selectExpr("*", *CLASH)
    pieces = packed_pieces(df, slack=slack).cache()
    _check_packing(pieces.collect(), texts, 2048, slack)
    for x in sequences(pieces).collect():
        assert len(x.ids) == 4 * (x.length if x.length & (x.length - 1) == 0 else 2048)
    pieces.unpersist()


def test_packing_of_null_ids_repeated_rows_and_no_rows(spark):
    rows = [(None, "one two", "en", "s"), (1, "same", "en", "s"), (1, "same", "en", "s")]
    got = packed_pieces(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(x.doc_id for x in got if x.start == 0) == {None: 1, 1: 2}
    assert packed_pieces(spark.createDataFrame([], DOCS)).count() == 0


def test_cuts_use_open_classes_and_few_pieces():
    for slack in (0, 16, 100):
        plan = cut_plan(2048, slack)
        assert all(2048 % plan[n] <= slack and plan[n] <= n for n in range(1, 2049))
    assert [n for n in range(1, 2049) if cut_plan(2048, 0)[n] & (cut_plan(2048, 0)[n] - 1)] == []


def test_ids_are_those_of_the_tokenizers_library(tmp_path):
    from tokenizers import Tokenizer
    tokenizer, r = Tokenizer.from_file(TOKENIZER), random.Random(2)
    encode = encoder(TOKENIZER)
    parts = ["a", "é", " ", " ", "  ", "\n", "'s", "'LL", "1", "½", "-", " b", "\u3000", "\xa0", " \u2028", "don't", "語", "\u0301", "🙂", "\x00", "<|endoftext|>", "\xad", "ĠĊ"]
    for _ in range(400):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 200)))
        assert encode(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    spec = json.load(open(TOKENIZER))
    spec["model"]["merges"].reverse()
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        encoder(str(tmp_path / "t.json"))


# -- source audit

def _audit(rows, top):
    docs = [(x[2] or "", x[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(x[1]))) for x in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in held.items() if n >= 3}
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        whole, shares = share(sum(counts.values(), Counter())), {s: share(c) for s, c in counts.items()}
        for s, p in shares.items():
            pairs = {o: sum((p[t] - q[t]) ** 2 // q[t] for t in kept) for o, q in shares.items() if o != s}
            terms = {t: (p[t] - whole[t]) ** 2 // whole[t] for t in kept if counts[s][t] and p[t] > whole[t]}
            for part, values, limit in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(values, key=lambda i: (-values[i], i.encode()))[:limit]
                out += [(lang, s, part, i, values[i], k + 1) for k, i in enumerate(order)]
    return sorted(out)


def test_audit_matches_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "TILE", 3)
    monkeypatch.setattr(source_audit, "BUCKET_TERMS", 7)
    monkeypatch.setattr(source_audit, "BLOCK_BYTES", 300)
    r, vocab = random.Random(5), vocabulary(60)
    say = lambda n: r.choice(["", " "]) + "".join(r.choice(vocab) + r.choice([" ", ", ", "/", "\n", " 7 ", "'"]) for _ in range(n))
    rows = [(i, say(r.randint(1, 40)), r.choice(["en", "en", "de", None]), f"s{r.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, 7])}") for i in range(120)]
    rows += [(200, None, "en", "silent"), (201, "", "en", None), (202, "12 34", "xx", "a"), (203, "zz zz", "xx", "b"), (None, "Éa éa ÉA", "en", "s1")]
    rows += [(300, "rare one", "en", "s1"), (300, "rare one", "en", "s1"), (300, "rare,one", "en", "s1"), (301, "x" * 3000 + " pair", "en", "s2"), (302, "pair. pair! pair", "en", "s2")]
    df = spark.createDataFrame(rows, DOCS).repartition(4).selectExpr("*", *CLASH)
    got = sorted(tuple(x) for x in source_audit.source_audit(df, top=9).collect())
    assert got == _audit(rows, 9)


def test_audit_of_no_rows(spark):
    assert source_audit.source_audit(spark.createDataFrame([], DOCS)).count() == 0


# -- conversation trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def _trie(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        full[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[:len(path)] == path]
        parents = {p[:-1] for p in members if p}
        ends = ",".join(str(c) for c in sorted(ids) if len(full[c]) == len(path))
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        out.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), sum(len(p) == len(path) + 1 for p in below),
                    sum(p not in parents for p in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1, 7, 40, 1 << 17])
def test_trie_matches_a_plain_version(spark, block):
    r = random.Random(block)
    rows = []
    for c in range(0, 130):
        n = r.choice([0, 1, 2, 3, 5, 6])
        rows += [(c, t, r.choice(["user", "assistant"]) if t > 2 else "user", r.choice(["hi", "hi there", "a b c"]) if t else "start here") for t in range(n)]
    rows += [(500 + i, t, "user", f"same {t}") for i in range(60) for t in range(4)]
    rows += [(600, None, None, None), (600, -1, "user", "x"), (600, 1, "user", ""), (None, 0, "user", "lost"), (601, 0, "", "1:x"), (602, 0, "1", ":x"), (601, 0, "", "1:x")]
    rows += [(700, t, "user", f"word {t}") for t in range(300)]
    df = spark.createDataFrame(rows, TURNS).repartition(4).selectExpr("*", *CLASH)
    got = prefix_trie(rebuilt(turn_paths(df)), block_units=block).collect()
    assert sorted([tuple(x) for x in got], key=str) == _trie([x for x in rows if x[1] is not None] + [x for x in rows if x[1] is None])


def test_trie_of_paths_without_rebuilding_and_of_no_rows(spark):
    rows = [(-3, 0, "user", "a"), (4, 0, "user", "a"), (4, 1, "user", "b"), (9, 0, "user", "z")]
    got = prefix_trie(turn_paths(spark.createDataFrame(rows, TURNS)), block_units=1).collect()
    assert sorted([tuple(x) for x in got], key=str) == _trie(rows, rebuild=False)
    assert prefix_trie(turn_paths(spark.createDataFrame([], TURNS))).count() == 0


def test_double_array_finds_all_children_and_no_others():
    r = random.Random(4)
    paths = [[r.randrange(40) for _ in range(r.randint(0, 6))] for _ in range(700)] + [[i] for i in range(40)]
    lengths, turns = np.array([len(p) for p in paths]), np.array([t for p in paths for t in p])
    trie = pack(turns, lengths, 40)
    nodes, at, seen = walk(trie, turns, lengths), 0, {}
    for p in paths:
        for d in range(len(p) + 1):
            assert seen.setdefault(tuple(p[:d]), int(nodes[at + d])) == nodes[at + d]
        at += len(p) + 1
    assert len(set(seen.values())) == len(seen) == int((trie.check >= 0).sum())
    for path, state in list(seen.items())[:300]:
        got = trie.step(np.full(40, state), np.arange(40))
        assert [(int(s) if s >= 0 else None) for s in got] == [seen.get((*path, t)) for t in range(40)]
    assert DoubleArray(3).step(np.array([0]), np.array([2])).tolist() == [-1]
    assert conversation_trie.NO_ENDS == hashlib.sha256(b"").hexdigest()
