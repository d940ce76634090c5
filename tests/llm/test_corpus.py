import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import mix, training_order
from lectern.llm.queries import Q
from llm_kit import documents, vocabulary

WORD = mix.WORD


def _corpus(n=300, seed=2):
    r, vocab = random.Random(seed), vocabulary(300)
    docs = [(i, r.choice(["", "  "]) + r.choice([" ", "\n"]).join(r.choice(vocab) for _ in range(r.randint(1, 300))), r.choice("aaaaabcdé")) for i in range(n)]
    return docs + [(n, None, "b"), (n + 1, "", "b"), (n + 2, "no source", None), (n + 3, " \t", "empty"), (None, "no id at all", "c")]


def _targets(sizes):
    """Waterfall by hand: raise all by weight, hold what reaches three times its size, and share the rest again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        share = {s: (total - sum(held.values())) * weight[s] / sum(weight[x] for x in free) for s in free} if free else {}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**held, **share}
        held.update({s: 3 * sizes[s] for s in over})


def test_mix_meets_targets(spark):
    docs = _corpus() + [(5000, "tiny", "z"), (5001, "x " * 20000, "big")]
    df = documents(spark, docs, extra=True)
    rows = mix.taken_words(df).join(df.select("doc_id", "source"), "doc_id", "left").collect()
    assert len(rows) == len(docs)
    sizes: dict = {}
    for d in docs:
        sizes[d[2]] = sizes.get(d[2], 0) + len((d[1] or "").split())
    want = _targets(sizes)
    taken: dict = {}
    for x in rows:
        assert 0 <= x.taken <= 3 * x.size
        if x.doc_id is not None:
            assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source])
        taken[x.source if x.doc_id is not None else "c"] = taken.get(x.source if x.doc_id is not None else "c", 0) + x.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2 * mix.BLOCK, 0.01 * t), s
    again = mix.taken_words(df.repartition(7)).select("doc_id", "taken")
    assert sorted(map(tuple, again.collect()), key=str) == sorted([(x.doc_id, x.taken) for x in rows], key=str)


def test_mixed_documents_hold_the_taken_words(spark):
    docs = documents(spark, _corpus(), extra=True)
    out = mix.mixed_documents(docs)
    assert out.columns == docs.columns
    words = {x[0]: x[1] for x in out.toDF(*[f"c{i}" for i in range(len(out.columns))]).selectExpr("c0 AS doc_id", "c1 AS text")
             .groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(WORD)))).collect()}
    assert {x.doc_id: x.taken for x in mix.taken_words(docs).collect() if x.taken} == words
    plain = mix.mixed_documents(documents(spark, _corpus()))
    assert plain.filter("length(text) <> n_chars").count() == 0


def test_shards_draw_from_all_sources(spark):
    _, sources, _, slots = mix._plan(documents(spark, _corpus(600)))
    counts = {(x.shard, x.source_no): x.n for x in mix.shard_counts(slots).collect()}
    want = {x.source_no: x.slots for x in sources.collect()}
    assert {s: sum(n for (_, k), n in counts.items() if k == s) for s in {k for _, k in counts}} == {s: n for s, n in want.items() if n}
    places = slots.select("shard", "place").collect()
    assert len(set(places)) == len(places) == sum(want.values())


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 10, 1000, 1023):
        df = spark.range(n).selectExpr("id AS x", f"CAST({n} AS BIGINT) AS n", "1 AS key")
        got = [r.x for r in mix.permuted(df, "x", "n", "key").collect()]
        assert sorted(got) == list(range(n)) and (n < 10 or got != list(range(n)))
        assert sorted(training_order.feistel(np.arange(n), n, 3).tolist()) == list(range(n))


def test_empty_mix(spark):
    assert mix.taken_words(documents(spark, [])).count() == 0
    assert mix.mixed_documents(documents(spark, [(1, None), (2, "")])).count() == 0


def _decoded(tokens):
    import base64

    import tiktoken
    with open(training_order.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("t", pat_str=training_order.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.decode(np.frombuffer(tokens, "<u2")[:-1].tolist())


def test_shards_round_trip_and_resume(spark, tmp_path):
    docs = _corpus(120) + [(7, "again"), (7, "again"), (900, "ab " * 30000)]
    df = documents(spark, docs, extra=True)
    folder = str(tmp_path / "out")
    index = training_order.write_shards(df.coalesce(1), folder, stride=64, per_shard=50)
    got = training_order.read_sequences(index, folder, stride=64).collect()
    assert sorted((x.doc_id, _decoded(x.tokens)) for x in got if x.doc_id is not None) == sorted((d[0], d[1] or "") for d in docs if d[0] is not None)
    assert sorted(x.slot for x in got) == list(range(len(docs))) and all(x.shard == x.slot // 50 for x in got)
    assert [x.slot for x in sorted(got, key=lambda x: (x.shard, x.start))] == list(range(len(docs)))
    for shard in {x.shard for x in got}:
        whole = list(training_order.read_records(folder, shard, 0, 64))
        assert all(len(r) == 64 for r in whole)
        assert [r.tolist() for r in training_order.read_records(folder, shard, 3, 64)] == [r.tolist() for r in whole[3:]]
        own = sorted((x for x in got if x.shard == shard), key=lambda x: x.start)
        assert b"".join(x.tokens for x in own) == np.concatenate(whole).tobytes()[:2 * sum(x.n_tokens for x in own)]
    second = training_order.write_shards(df.coalesce(1), str(tmp_path / "again"), stride=64, per_shard=50)
    assert sorted(map(tuple, second.collect()), key=str) == sorted(map(tuple, index.collect()), key=str)


def test_no_documents_no_shards(spark, tmp_path):
    assert training_order.write_shards(documents(spark, []), str(tmp_path / "none")).count() == 0


def test_queries_keep_every_document(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert Q["op6_mix_sources"](spark, sf).count() == n
    assert Q["op7_training_order"](spark, sf).count() == n
