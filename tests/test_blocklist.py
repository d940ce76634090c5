import random
import time

import pytest

from lectern.operators import blocklist


@pytest.mark.parametrize("size", [0, 20, 150])
def test_hits_match_brute_force(spark, size):
    rng = random.Random(7)
    texts = [(i, "".join(rng.choice("abAB  é") for _ in range(rng.randint(0, 60)))) for i in range(120)]
    phrases = sorted({"".join(rng.choice("ab é") for _ in range(rng.randint(1, 12))) for _ in range(150)})[:size]
    want = sorted((i, p) for i, t in texts for p in phrases if p in t.lower())
    got = blocklist.hits(spark.createDataFrame(texts, "id int, text string"), ["id"], "text",
                         spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    assert sorted((r.id, r.phrase) for r in got.collect()) == want
    assert len(want) > 50 or size < 150


def test_a_mixed_list_splits_by_length(spark):
    phrases = [(f"long phrase {i}",) for i in range(6)] + [("ab",), ("cd",)]
    got = blocklist.hits(spark.createDataFrame([(1, "AB then long phrase 3"), (2, "nothing")], "id int, text string"), ["id"], "text",
                         spark.createDataFrame(phrases, "phrase string"))
    assert sorted(r.phrase for r in got.collect()) == ["ab", "long phrase 3"]


def test_time_grows_with_the_text_only(spark):
    rng = random.Random(1)
    phrases = spark.createDataFrame([("".join(rng.choice("abcdefgh") for _ in range(12)),) for _ in range(300)], "phrase string")
    took = []
    for n in (2_000, 20_000, 200_000):
        text = "".join(rng.choice("abcdefgh ") for _ in range(n))
        start = time.time()
        blocklist.hits(spark.createDataFrame([(1, text)], "id int, text string"), ["id"], "text", phrases).count()
        took.append(time.time() - start)
    assert took[2] < 20


def test_common_beginnings_and_repeated_keys(spark):
    """Every text holds the beginning of every phrase; only the rare part decides. Rows of one key are rows of their own."""
    phrases = [(f"the same long beginning of all {i:03d} ends",) for i in range(200)]
    texts = [(1, f"The same long beginning of all ... The Same long beginning of all {i:03d} ends" + " x" * i) for i in range(0, 400, 3)] + [(1, None), (1, "")]
    index = blocklist.PhraseIndex(spark.createDataFrame(phrases, "phrase string"), spark.createDataFrame(texts, "id int, text string"))
    got = blocklist.hits(spark.createDataFrame(texts, "id int, text string").repartition(3), ["id"], "text", index)
    assert sorted(r.phrase for r in got.collect()) == [p for p, in phrases[::3]]
    assert index.anchors.filter("at < 20").count() == 0  # no phrase is anchored where all are alike


def test_a_phrase_across_two_rows_is_none(spark):
    texts = [(1, "ends with a phr"), (2, "ase here"), (3, "a phrase"), (4, "é" * 50 + "phrase"), (5, "phras" * 1000 + "e")]
    got = blocklist.hits(spark.createDataFrame(texts, "id int, text string").coalesce(1), ["id"], "text", spark.createDataFrame([("phrase",), ("é",), ("a phrase",)], "phrase string"))
    assert sorted((r.id, r.phrase) for r in got.collect()) == [(3, "a phrase"), (3, "phrase"), (4, "phrase"), (4, "é"), (5, "phrase")]
