"""Queries op11 to op13, and the SQL of op12 and op13."""
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.conversation_trie import UNIT, prefix_trie, turn_paths
from lectern.llm.harmonic_packing import packed_pieces
from lectern.llm.source_audit import source_audit


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    return (packed_pieces(spark.read.parquet(f"{sf}/documents.parquet"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))


def op12_source_audit(spark: SparkSession, sf: str) -> DataFrame:
    return source_audit(spark.read.parquet(f"{sf}/documents.parquet"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Fixed rule of the query: conversation c starts with the first crc32(c) % 4 turns of conversation c - c % 20, its own turns follow from there on."""
    heads = paths.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("_base"), F.expr(f"left(path, {3 * UNIT})").alias("_head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return (paths.withColumn("_h", h.cast("int")).join(heads, F.expr("conv_id - conv_id % 20") == F.col("_base"), "left")
            .select("conv_id", F.concat(F.expr(f"left(coalesce(_head, ''), _h * {UNIT})"), F.expr(f"substring(path, _h * {UNIT} + 1)")).alias("path")))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_paths(spark.read.parquet(f"{sf}/conversations.parquet"))))


SQL = {
    "op12_source_audit": r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
           FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 3),
l AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(gn.total, 0) + l.v) AS BIGINT) AS p,
             CAST(1 + (CAST(1000000000 AS HUGEINT) * (kept.n + 1)) // (l.total + l.v) AS BIGINT) AS q
      FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
      LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200""",
    "op13_prefix_trie": r"""
WITH RECURSIVE o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM o GROUP BY c),
crc AS (SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS r FROM own
        UNION ALL SELECT c, s, i + 1, list_reduce(range(0, 8), lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(r, ascii(s[i + 1])))
        FROM crc WHERE i < length(s)),
h AS (SELECT c, xor(r, 4294967295) % 4 AS h FROM crc WHERE i = length(s)),
full_ AS (SELECT a.c, list_concat(coalesce(b.turns, [])[1:h], a.turns[h + 1:]) AS turns FROM own a JOIN h USING (c) LEFT JOIN own b ON b.c = a.c - a.c % 20),
m AS (SELECT c, d, turns[1:d] AS path, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM full_)),
n AS (SELECT path, d, count(*) AS n_convs, min(c) AS conv_id, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends) AS ids FROM m GROUP BY ALL),
k AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(path[d].t, '[^\x20\x09-\x0D]+')) END AS saved
      FROM n LEFT JOIN k USING (path)),
u AS (SELECT path[1:j] AS path, sum(saved) AS saved_tokens, sum(CAST(n_children = 0 AS INT)) AS n_leaves
      FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM w) GROUP BY ALL)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
       CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(w.ids, '')) AS ends_sha256
FROM w JOIN u USING (path) LEFT JOIN n p ON w.d > 0 AND p.path = w.path[1:w.d - 1]""",
}
Q = {f.__name__: f for f in (op11_packing, op12_source_audit, op13_prefix_trie)}
