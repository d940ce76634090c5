"""Queries op9 and op10, and their SQL."""
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.decontaminate import contamination
from lectern.llm.jaccard_trie import similar_components


def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    return (contamination(docs, items)
            .select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated"))


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf}/documents.parquet"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op9_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM i WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, n WHERE len(w) >= n)),
m AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
      FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op10_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g
      FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(c) AS component_id
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY ALL""",
}
Q = {f.__name__: f for f in (op9_decontaminate, op10_jaccard_join)}
