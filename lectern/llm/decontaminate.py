"""Benchmark decontamination by winnowing (Schleimer, Wilkerson, Aiken, 2003).

Of every SPAN - K + 1 consecutive K-grams of words the ones with the smallest hash are kept, so two texts that share SPAN words in a
row keep a K-gram inside that span. Fingerprints of documents and items are joined, and every match is extended word by word:
a document word is hit if it lies in SPAN consecutive words that an item has too. An item of fewer words is one window by itself;
those are matched by the hash of their whole sequence, at each length that occurs.

Only fingerprints that pass a filter of fixed size (built from the items' fingerprints, 1 MB) leave the scan of the documents, with
the words around them. Documents of equal words are judged once.

Defined results: null or empty texts have no words and are never hit; an item without id or words matches nothing; rows
are judged one by one, repeated doc_ids too; several items of one id count once.
"""
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.frames import pick
from lectern.llm.memory import tidy
from lectern.llm.words import ALPHANUMERIC, grams, hash_words, mixed, pack_lists, sequence_hash, text_blocks
from lectern.session import fresh_path

SPAN, K = 13, 5
REACH = SPAN - K  # a span that holds a K-gram reaches at most so many words to either side
FILTER_BITS = 23
HITS = "array<struct<kind:int,at:int,key:bigint,around:array<bigint>>>"
_KIND = pa.list_(pa.struct([("kind", pa.int32()), ("at", pa.int32()), ("key", pa.int64()), ("around", pa.list_(pa.int64()))]))


def _slide(x: np.ndarray, width: int, pick_: Callable) -> np.ndarray:
    """pick_ (minimum or maximum) over each `width` neighbours, by doubling."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out, have = pick_(out[:len(out) - step], out[step:]), have + step
    return out


def winnowed(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept K-grams. Ties are all kept, so the choice depends on the words alone."""
    gram = grams(hashes, K) | np.uint64(1)
    if len(hashes) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes))  # words from here to the end of the row
    least = np.where(left[:len(hashes) - SPAN + 1] >= SPAN, _slide(gram, REACH + 1, np.minimum), np.uint64(0))
    pad = np.zeros(REACH, np.uint64)
    at = np.flatnonzero(gram == _slide(np.concatenate((pad, least, pad)), REACH + 1, np.maximum)[:len(gram)])
    return at, gram[at]


def _fingerprints(hashes: np.ndarray, first: np.ndarray, lengths: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, positions, keys): kind 0 are winnowed K-grams, kind n whole sequences of n words for each wanted length."""
    yield 0, *winnowed(hashes, first)
    for n in lengths:
        left = np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes))
        at = np.flatnonzero(left >= n)
        yield n, at, grams(hashes, n)[at]


def _slot(kind: int, keys: np.ndarray) -> np.ndarray:
    return mixed(keys + np.uint64(kind)) >> np.uint64(64 - FILTER_BITS)


def _scan(lengths: tuple[int, ...], bits: bytes | None, own_length: bool) -> Callable:
    """Task function: (id, text) to (id, n_words, k1, k2, hits). own_length: a short row is one window, nothing else of it counts."""
    def task(batches):
        keep = None if bits is None else np.frombuffer(bits, np.uint8)
        for batch in batches:
            for lo, hi, data, bounds in text_blocks(batch.column(1)):
                hashes, first = hash_words(data, bounds, ALPHANUMERIC)
                counts = np.diff(first)
                row_of = np.repeat(np.arange(hi - lo), counts)
                found = []
                for kind, at, keys in _fingerprints(hashes, first, lengths):
                    if own_length and kind:
                        whole = (counts[row_of[at]] == kind)
                        at, keys = at[whole], keys[whole]
                    if keep is not None:
                        slot = _slot(kind, keys)
                        passed = (keep[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 != 0
                        at, keys = at[passed], keys[passed]
                    found.append((np.full(len(at), kind, np.int32), at, keys))
                kinds, at, keys = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((kinds, at))
                kinds, at, keys = kinds[order], at[order], keys[order]
                begin, end = first[row_of[at]], first[row_of[at] + 1]
                near = at[:, None] + np.arange(-REACH, K + REACH)
                inside = (near >= begin[:, None]) & (near < end[:, None]) & (kinds == 0)[:, None]
                around = np.where(inside, hashes[np.clip(near, 0, max(0, len(hashes) - 1))] if len(hashes) else np.uint64(0), np.uint64(0))
                width = np.where(kinds == 0, K + 2 * REACH, 0)
                around = around[kinds == 0]
                structs = pa.StructArray.from_arrays(
                    [pa.array(kinds), pa.array((at - begin).astype(np.int32)), pa.array(keys.view(np.int64)),
                     pack_lists(around.reshape(-1).view(np.int64), width, pa.int64())], names=["kind", "at", "key", "around"])
                per_row = np.bincount(row_of[at], minlength=hi - lo)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per_row))).astype(np.int32)), structs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(counts.astype(np.int64)),
                     pa.array(sequence_hash(hashes, first, 3).view(np.int64)), pa.array(sequence_hash(hashes, first, 4).view(np.int64)),
                     lists.cast(_KIND)], names=["id", "n_words", "k1", "k2", "hits"])
    return task


def _scanned(df: DataFrame, key: str, lengths: tuple[int, ...], bits: bytes | None, own_length: bool) -> DataFrame:
    rows = pick(df, key, "text").toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(_scan(lengths, bits, own_length)), f"id {kind}, n_words bigint, k1 bigint, k2 bigint, hits {HITS}")


def _bitmap(prints: DataFrame) -> bytes:
    """The filter's bytes: 2^FILTER_BITS bits, merged on the executors, so at most 131,072 rows reach the driver."""
    def slots(batches):
        for b in batches:
            kinds, keys = np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64)
            at = mixed(keys + kinds.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)),
                                              pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["word", "bit"])
    rows = prints.select("kind", "key").mapInArrow(slots, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for word, bits in rows:
        out[word] = bits
    return out.tobytes()


def _run(equal: Column) -> Column:
    """Trues before the first false."""
    at = F.array_position(equal, False)
    return F.when(at == 0, F.size(equal)).otherwise(at - 1).cast("int")


def contaminated_spans(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, spans, members): documents (id, n_words, k1, k2, hits) one per row of docs, staged in the shared folder; spans
    (k1, k2, class_1, class_2, lo, hi) with the hit words lo <= word < hi of documents of word sequence (k1, k2); members
    (class_1, class_2, item_id)."""
    spark = docs.sparkSession
    short = tuple(range(1, SPAN))
    item_path = fresh_path(spark, "decontaminate-items")
    _scanned(items, "item_id", short, None, True).filter("id IS NOT NULL AND n_words > 0").write.parquet(item_path)
    item_rows = spark.read.parquet(item_path)
    members = item_rows.select(F.col("k1").alias("class_1"), F.col("k2").alias("class_2"), F.col("id").alias("item_id")).distinct()
    prints = (item_rows.dropDuplicates(["k1", "k2"]).select(F.col("k1").alias("class_1"), F.col("k2").alias("class_2"), F.explode("hits").alias("h"))
              .select("class_1", "class_2", "h.kind", "h.key", F.col("h.around").alias("theirs")))
    lengths = tuple(sorted(r[0] for r in item_rows.filter(F.col("n_words") < SPAN).select("n_words").distinct().collect()))
    path = fresh_path(spark, "decontaminate-docs")
    _scanned(docs, "doc_id", lengths, _bitmap(prints), False).write.parquet(path)
    rows = spark.read.parquet(path)
    seen = (rows.filter(F.size("hits") > 0).dropDuplicates(["k1", "k2"]).select("k1", "k2", F.explode("hits").alias("h"))
            .select("k1", "k2", "h.kind", "h.at", "h.key", "h.around"))
    same = F.zip_with("around", "theirs", lambda x, y: (x == y) & (x != 0))
    met = (seen.join(prints, ["kind", "key"]).withColumn("_same", same)
           .withColumn("_left", _run(F.reverse(F.slice("_same", 1, REACH))))
           .withColumn("_right", _run(F.slice("_same", REACH + K + 1, REACH)))
           .withColumn("_core", F.forall(F.slice("_same", REACH + 1, K), lambda x: x)))
    spans = (met.filter((F.col("kind") > 0) | (F.col("_core") & (F.col("_left") + K + F.col("_right") >= SPAN)))
             .select("k1", "k2", "class_1", "class_2",
                     F.when(F.col("kind") > 0, F.col("at")).otherwise(F.col("at") - F.col("_left")).alias("lo"),
                     F.when(F.col("kind") > 0, F.col("at") + F.col("kind")).otherwise(F.col("at") + K + F.col("_right")).alias("hi")))
    return rows, spans.distinct(), members


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated) for each row of docs; item_ids as sorted strings."""
    rows, spans, members = contaminated_spans(docs, items)
    covered = F.aggregate(F.array_sort("_spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                          lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], s["end"]))).alias("n"),
                                                F.greatest(s["end"], x["hi"]).alias("end")))
    hit = (spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("_spans"))
           .select("k1", "k2", covered["n"].cast("bigint").alias("n_hit")))
    named = (spans.select("k1", "k2", "class_1", "class_2").distinct().join(members, ["class_1", "class_2"])
             .groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    result = hit.join(named, ["k1", "k2"])
    none = F.array().cast("array<string>")
    met = rows.filter(F.size("hits") > 0).drop("hits").join(result, ["k1", "k2"], "left")
    clean = rows.filter(F.size("hits") == 0).select("id", "n_words", F.lit(0).cast("bigint").alias("n_hit"), none.alias("item_ids"))
    every = met.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids")).union(clean)
    return every.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), "item_ids",
                        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
