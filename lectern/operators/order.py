"""Numbering rows inside a key when one key may hold a large share of all rows.

Rows are range-partitioned by key, order and ties, so a hot key, or a hot sort value, is spread over tasks. Rows are numbered inside
their partition, and the counts of a key's earlier partitions are added: one row per key and partition it touches.
"""
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.session import cut_lineage


def number_within(df: DataFrame, keys: list[str], lead: list[str], sort_col: str, ties: list[str], out: str) -> DataFrame:
    """0-based position of each row in its key, ordered by lead, then sort_col, then ties; nulls come first, also as keys."""
    order = [*keys, *lead, sort_col, *ties]
    # The ranges are drawn from a sample, so they are fixed in the shared folder before two readers rely on them.
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright("_at", 33)))
    parts = placed.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_first",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (placed.join(starts, same).withColumn(out, (F.col("_before") + F.col("_at") - F.col("_first")).cast("bigint"))
            .drop("_at", "_part", "_p", "_first", "_before", *[f"_k{i}" for i in range(len(keys))]))


def position_key(mod_idx="mod_idx", order="ord", array_pos="array_pos") -> Column:
    """Sort key of a lesson in its course: comparing keys says "before" without numbering anything."""
    return F.struct(F.col(mod_idx).cast("bigint").alias("m"), F.col(order).cast("bigint").alias("o"),
                    F.col(array_pos).cast("bigint").alias("p"))
