"""A set-membership filter of fixed size, as a table: 2^17 words of 64 bits at most, whatever the number of keys (2 MB broadcast).

It says "no" only where that is certain, so it may spare a shuffle but never decides anything: what it lets pass still goes
through an exact join. With many keys it fills up and spares less.
"""
from pyspark.sql import Column, DataFrame, functions as F

WORDS = 1 << 17


def _word(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(WORDS)).cast("int")


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(key, F.lit(7)), F.lit(64)).cast("int"))


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """(_word, _bits) of all keys that are not null."""
    k = F.col(key)
    return (keys.filter(k.isNotNull()).select(_word(k).alias("_word"), _bit(k).alias("_bit"))
            .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))


def maybe_in(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """df with boolean `_maybe`: false if the key is surely none of the keys. Adds no row and drops none."""
    k = F.col(key)
    hit = k.isNotNull() & (F.col("_bits").bitwiseAND(_bit(k)) != 0)
    return (df.withColumn("_word", _word(k)).join(F.broadcast(bits), "_word", "left")
            .withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_word", "_bits"))
