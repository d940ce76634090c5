"""Every stage against a plain answer on its own input, and the whole run on the small tables."""
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm.mix import taken_words
from llm_kit import documents, vocabulary
from test_text_joins import _contamination, _similar

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r, vocab = random.Random(8), vocabulary(300, 5)
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, say(30)) for i in range(10)]
    rows = [(i, say(r.randint(5, 120)), r.choice("abc")) for i in range(240)]
    rows += [(1000 + i, f"{say(20)} moron {say(10)} stup1d" if i % 2 else f"{say(9)} moron stupid", "a") for i in range(60)]
    rows += [(2000 + i, rows[i][1] + (" extra" if i % 2 else ""), "b") for i in range(40)]
    rows += [(3000 + i, say(10) + " " + items[i % 10][1] + " " + say(10), "c") for i in range(30)]
    rows += [(4000, None, "a"), (4001, "", None), (None, "no id " + say(30), "b"), (5, rows[5][1], "a"), (4002, "w " * 60000, "c")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(x[0], 1, int(1000 <= x[0] < 1060)) for x in rows if x[0] is not None and x[0] < 1050]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def _ids(df):
    return sorted([x.doc_id for x in df.select("doc_id").collect()], key=str)


def test_toxic_documents_go_and_others_stay(spark, corpus):
    folder, rows = corpus
    out = corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert out.columns == COLUMNS
    assert _ids(out) == sorted([x[0] for x in rows if x[0] is None or not 1000 <= x[0] < 1060], key=str)


def test_one_document_of_each_group_stays(spark, corpus):
    folder, rows = corpus
    out = corpus_pipeline.drop_similar(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert out.columns == COLUMNS
    assert _ids(out) == sorted({d for d, _, c in _similar(rows) if d == c}, key=str)  # one row per group, also of equal rows


def test_contaminated_documents_go(spark, corpus):
    folder, rows = corpus
    items = [tuple(x) for x in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    out = corpus_pipeline.drop_contaminated(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    want = sorted([x[0] for x in _contamination(rows, items) if not x[5] or x[0] is None], key=str)
    assert out.columns == COLUMNS and _ids(out) == want and len(want) < len(rows) - 20


def test_mix_and_tokens(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").dropDuplicates(["doc_id", "text"])
    docs.write.parquet(f"{folder}/once")
    docs = spark.read.parquet(f"{folder}/once")
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    words = {x.doc_id: x.n for x in mixed.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    assert mixed.columns == COLUMNS and words == {x.doc_id: x.taken for x in taken_words(docs).collect() if x.taken}
    mixed.write.parquet(f"{folder}/mixed")
    out = corpus_pipeline.write_tokens(spark, spark.read.parquet(f"{folder}/mixed"), folder).collect()
    assert sorted(x.slot for x in out) == list(range(spark.read.parquet(f"{folder}/mixed").count()))


def test_extra_columns_stay(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(50).select("*", F.lit(1).alias("TEXT"), F.lit(2).alias("_row"), F.lit(3).alias("_word"))
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_similar, corpus_pipeline.drop_contaminated, corpus_pipeline.mix_sources):
        assert stage(spark, docs, folder).columns == docs.columns


def test_whole_run(spark):
    sf = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {x.doc_id for x in rows} <= {x.doc_id for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "mix_sources", "token_output"]


def test_null_and_repeated_ids_are_judged_by_row(spark, tmp_path):
    r, vocab = random.Random(21), vocabulary(400, 7)
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    item, copy, lone = say(30), say(60), say(60)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, say(40)), (1, say(40)), (2, say(40))]
    rows = clean + [(None, f"{say(5)} {item}"), (1, f"{say(5)} {item} x"), (3, f"{item} {say(5)}")]
    out = corpus_pipeline.drop_contaminated(spark, documents(spark, rows), str(tmp_path))
    assert sorted([(x.doc_id, x.text) for x in out.collect()], key=str) == sorted(clean, key=str)
    clean = [(8, copy), (9, say(60)), (None, say(60))]
    out = corpus_pipeline.drop_similar(spark, documents(spark, clean + [(None, copy), (None, copy), (9, copy), (None, lone), (None, lone)]), str(tmp_path)).collect()
    assert sorted([(x.doc_id, x.text) for x in out], key=str) == sorted([*clean, (None, lone)], key=str)


def test_repeated_rows_are_drawn_one_by_one(spark):
    r, vocab = random.Random(22), vocabulary(300, 6)
    long = " ".join(r.choice(vocab) for _ in range(3000))
    rows = [(1, long, "a")] * 5 + [(1, long, "b")] + [(None, long, "c")] * 2 + [(10 + i, " ".join(r.choice(vocab) for _ in range(40)), r.choice("abc")) for i in range(90)]
    spark_rows = documents(spark, rows)
    drawn = {(x.doc_id, x.source): x.n for x in mixed_words(corpus_pipeline.mix_sources(spark, spark_rows, ""))}
    plan = taken_by_source(spark_rows)
    assert {s: sum(n for (_, source), n in drawn.items() if source == s) for s in "abc"} == plan


def mixed_words(mixed):
    return mixed.groupBy("doc_id", "source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()


def taken_by_source(docs):
    """Words drawn of each source; sources are told apart by their size."""
    size = {x.source: x.n for x in docs.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    taken = {x.source_size: x.n for x in taken_words(docs).groupBy("source_size").agg(F.sum("taken").alias("n")).collect()}
    assert len(set(size.values())) == len(size)
    return {s: taken[n] for s, n in size.items()}
