"""Small inputs and brute-force answers for the operators' tests."""
import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows, extra=False):
    """rows of (doc_id, text[, source]); extra adds columns whose names clash with helpers and, but for case, with real ones."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", F.lit(1).alias("TEXT"), F.lit(2).alias("id"), F.lit("x").alias("_row"), F.lit("y").alias("_word"), F.lit(0).alias("n"))
    return df


def vocabulary(n, seed=1):
    r = random.Random(seed)
    return sorted({"".join(r.choice("abcdefgéß") for _ in range(r.randint(2, 7))) for _ in range(n)})


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
