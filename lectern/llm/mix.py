"""Mixing sources to target weights, with DataFrame functions only.

1. The words of a source are laid end to end (documents in a keyed order) and cut into blocks of BLOCK words.
2. Targets: sources by code point, null last, weigh WEIGHTS in turn and share all words; none exceeds CAP times its own words.
3. A source gets as many output slots as its target has blocks. A keyed permutation over all slots deals them to output
   shards of SHARD slots, which draws each shard's source counts from the multinomial with the mix's totals held fixed (plain draws
   would miss the targets by chance and could pass CAP).
4. The k-th slot of a source takes block P(k mod n) of its n blocks, P a keyed permutation of its own for each pass over them, so
   no block is used twice before all are used once.
5. Slots and blocks meet in an equi-join on (source, block).

Positions come from running sums in 4,096 buckets of a source and a sum of bucket totals, so a hot source is
spread over many tasks. Permutations are swap-or-not networks (Hoang, Morris, Rogaway, 2012), exact for every size. All keys are
fixed, so reruns agree.

Defined results: a null or empty text has no words and is never taken; a null source is a source; repeated rows are rows
of their own; an empty table gives no rows.
"""
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.frames import field, keyed, pick
from lectern.session import fresh_path

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 64
SHARD = 4096
BUCKETS = 4096
ROUNDS = 12
WORD = r"[^\x20\x09-\x0D]+"


def permuted(df: DataFrame, column: str, size: str, *key: str) -> DataFrame:
    """`column`, a number from 0 to size - 1, through a permutation of that range; one permutation for each value of key."""
    k = [F.col(c) for c in key]

    def swapped(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(101), r, *k), F.col(size)) - x, F.col(size))
        return F.when(F.xxhash64(F.lit(102), r, *k, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 0, x).otherwise(partner)

    return df.withColumn(column, F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.col(column).cast("bigint"), swapped))


def sized(docs: DataFrame) -> DataFrame:
    """A row for each row of docs, with its `_key` if it has one."""
    key = [n for n in docs.columns if n == "_key"]
    return pick(docs, "doc_id", "source", "text", *key).select(
        "doc_id", "source", *key, F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))


def target_table(sizes: DataFrame) -> DataFrame:
    """One row per source: (source, source_no, source_size, target). The only windows over the whole table hold a row per source.

    Sources above their cap keep CAP times their size and the rest share what is left by weight. In order of cap / weight the capped
    ones come first, and the level of the rest is the first one that the source it starts with can still take.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(place, F.lit(len(WEIGHTS))) + 1).cast("int"))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    earlier, later = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (rows.select("source", "source_size", place.cast("bigint").alias("source_no"), weight.cast("bigint").alias("weight"))
            .withColumn("_left", F.sum("source_size").over(everything) - CAP * F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))
            .withColumn("_weights", F.sum("weight").over(later)))
    fits = F.col("_left") * F.col("weight") <= CAP * F.col("source_size") * F.col("_weights")
    level = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("weight"), F.col("source_no"), F.col("_left").alias("l"),
                                        F.col("_weights").alias("w")))).over(everything)
    return (rows.withColumn("_level", level)
            .select("source", "source_no", "source_size",
                    F.least((CAP * F.col("source_size")).cast("double"),
                            (F.col("_level.l") * F.col("weight")).cast("double") / F.col("_level.w")).alias("target")))


def with_blocks(sources: DataFrame) -> DataFrame:
    """Adds blocks of the source, its slots, and the slots before it."""
    blocks = F.ceil(F.col("source_size") / BLOCK)
    slots = F.when(F.col("source_size") > 0, F.least(CAP * blocks, F.round(F.col("target") * blocks / F.col("source_size")))).otherwise(F.lit(0))
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    return (sources.withColumn("blocks", blocks.cast("bigint")).withColumn("slots", slots.cast("bigint"))
            .withColumn("slots_before", F.coalesce(F.sum("slots").over(before), F.lit(0)))
            .withColumn("all_slots", F.sum("slots").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))


def slot_table(sources: DataFrame) -> DataFrame:
    """Every output slot: (shard, place, source_no, pass, block)."""
    # A number of partitions is given because few rows become many here, which adaptive execution does not foresee.
    chunk, tasks = 1 << 14, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = (sources.filter("slots > 0").select("source_no", "blocks", "slots", "slots_before", "all_slots",
                                                 F.explode(F.expr(f"sequence(0L, slots - 1, {chunk}L)")).alias("_from")).repartition(tasks, "source_no", "_from"))
    draws = starts.select("source_no", "blocks", "slots_before", "all_slots",
                          F.explode(F.expr(f"sequence(_from, least(_from + {chunk}, slots) - 1)")).alias("k"))
    draws = draws.select("source_no", "blocks", "all_slots", F.expr("slots_before + k").alias("position"), F.expr("k div blocks").alias("pass"),
                         F.expr("k % blocks").alias("block"))
    draws = permuted(permuted(draws, "block", "blocks", "source_no", "pass"), "position", "all_slots")
    return draws.select(F.expr(f"position div {SHARD}").alias("shard"), F.expr(f"position % {SHARD}").alias("place"), "source_no", "pass", "block")


def shard_counts(slots: DataFrame) -> DataFrame:
    """How many blocks of each source a shard has drawn."""
    return slots.groupBy("shard", "source_no").agg(F.count("*").alias("n"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with words, with the position of their first word in their source."""
    rows = (sizes.filter("size > 0").join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("_order", F.xxhash64(F.lit(103), "doc_id", "text_hash")).withColumn("_bucket", F.pmod("_order", F.lit(BUCKETS))))
    totals = rows.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source_no", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("source_no", "_bucket").orderBy("_order", "doc_id", "text_hash", *[n for n in sizes.columns if n == "_key"]).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["source_no", "_bucket"])
            .withColumn("offset", F.col("_start") + F.col("_within")).drop("_start", "_within", "_bucket", "_order"))


def pieces(rows: DataFrame) -> DataFrame:
    """A row for each block that a document reaches into, with the words lo <= word < hi of the document that are there."""
    return (rows.withColumn("block", F.explode(F.expr(f"sequence(offset div {BLOCK}, (offset + size - 1) div {BLOCK})")))
            .withColumn("lo", F.greatest(F.lit(0), F.col("block") * BLOCK - F.col("offset")))
            .withColumn("hi", F.least("size", (F.col("block") + 1) * BLOCK - F.col("offset"))))


def _plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sizes, sources, placed documents (the first three staged, without texts) and slots."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "mix")
    sized(docs).write.parquet(f"{path}/sizes")
    sizes = spark.read.parquet(f"{path}/sizes")
    with_blocks(target_table(sizes)).write.parquet(f"{path}/sources")
    sources = spark.read.parquet(f"{path}/sources")
    placed(sizes, sources).write.parquet(f"{path}/placed")
    return sizes, sources, spark.read.parquet(f"{path}/placed"), slot_table(sources)


def taken_words(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of docs."""
    sizes, sources, rows, slots = _plan(docs)
    # Slots come from a handful of rows, so their number is not foreseen; the hint keeps them from being broadcast.
    met = pieces(rows).join(slots.select("source_no", "block").hint("merge"), ["source_no", "block"])
    drawn = met.groupBy("source_no", "offset").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    full = (rows.join(drawn, ["source_no", "offset"], "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))
    empty = (sizes.filter("size = 0").join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
             .select("doc_id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken")))
    return full.union(empty)


def _drawn_text(text: Column, spans: Column) -> Column:
    """The words of the spans (lo, hi), each with the blanks after it."""
    words = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    # One-element array: the text is split once, not once for each span.
    return F.get(F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform(
        spans, lambda s: F.slice(w, (s["lo"] + 1).cast("int"), (s["hi"] - s["lo"]).cast("int")))), "")), F.lit(0))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each whole pass over a document, and one with the words drawn in the last pass, if any.

    All columns stay; text and n_chars (if there) become those of the drawn words. Every row is drawn by itself, repeated ones too.
    """
    every = keyed(docs)
    _, _, rows, slots = _plan(every.select(*[field(docs, n) for n in ("doc_id", "source", "text")], "_key"))
    last = slots.groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    whole = F.floor(F.col("slots") / F.col("blocks"))
    met = (pieces(rows).join(last.hint("merge"), ["source_no", "block"], "left").withColumn("whole", whole)
           .groupBy("_key", "size", "whole")
           .agg(F.array_sort(F.collect_list(F.when(F.coalesce("uses", F.lit(0)) > F.col("whole"), F.struct("lo", "hi")))).alias("spans")))
    plan = (met.withColumn("extra", F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["hi"] - x["lo"]))
            .select("_key", F.col("whole").alias("_whole"), F.col("size").alias("_size"), F.col("spans").alias("_spans"), F.col("extra").alias("_extra"))
            .filter("_whole > 0 OR _extra > 0"))
    passes = F.concat(F.array_repeat(F.lit(True), (F.col("_whole") + F.when(F.col("_extra") == F.col("_size"), 1).otherwise(0)).cast("int")),
                      F.array_repeat(F.lit(False), F.when((F.col("_extra") > 0) & (F.col("_extra") < F.col("_size")), 1).otherwise(0)))
    out = (every.select("_row", "_key", field(docs, "text")).join(plan, "_key")
           .withColumn("_all", F.explode(passes))
           .withColumn("_text", F.when(F.col("_all"), F.col("text")).otherwise(_drawn_text(F.col("text"), F.col("_spans")))))
    fields = [F.col("_text") if n == "text" else F.length("_text").cast(t) if n == "n_chars" else F.col(f"_row._c{i}")
              for i, (n, t) in enumerate(docs.dtypes)]
    return out.select(*fields).toDF(*docs.columns)
