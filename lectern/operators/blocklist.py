"""Which texts contain which phrases, as substrings, without pairing every text with every phrase.

A phrase is anchored on the rarest run of eight bytes in it (a shorter one on all of it), by counts of hashed runs over all texts. Texts are
scanned once, a block of bytes at a time: every run is looked up in a table of fixed size (how far the phrases of its bucket
reach before and after it), and only runs found there leave the row, with their surroundings of that length. They meet the
anchors in an equi-join and are compared byte by byte there, so no text is shuffled and none is read twice to verify.

Bytes are those of UTF-8, in which a substring of bytes is a substring of characters.

A list of at most SHORT phrases is looked for phrase by phrase in each text's row, without Python, index or join.
"""
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from lectern.session import fresh_path

# Task functions travel with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = 8
BUCKET_BITS = 19  # two 32-bit numbers a bucket: 4 MB for every list
BLOCK_BYTES = 1 << 22
SHORT = 16


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row bounds) of a string column, a bounded piece at a time; null reads as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + BLOCK_BYTES, "right")) - 1)
        yield row, data[bounds[row]:bounds[end]], bounds[row:end + 1] - bounds[row]
        row = end


def run_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n bytes from each position on."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    padded = np.append(data, np.zeros(RUN, np.uint8))
    runs = np.ndarray((len(data) - n + 1,), "<u8", padded, strides=(1,))
    if n < RUN:
        runs = runs & np.uint64((1 << (8 * n)) - 1)
    mixed = (runs + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _phrase_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every run of every phrase: phrase, at, n, h, bucket, size."""
    for b in batches:
        out = []
        for phrase in b.column(0).to_pylist():
            data = np.frombuffer(phrase.encode(), np.uint8)
            n = min(RUN, len(data))
            hashes = run_hashes(data, n)
            out += [(phrase, at, n, h, k, len(data)) for at, (h, k) in enumerate(zip(hashes.view(np.int64).tolist(), _bucket(hashes).tolist()))]
        names = ["phrase", "at", "n", "h", "bucket", "size"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()])], names=names)


def _counter(wanted: np.ndarray, lengths: list[int]) -> Callable:
    """How often runs of the wanted buckets occur in texts."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for b in batches:
            for _, data, _ in _blocks(b.column(0)):
                for n in lengths:
                    buckets = _bucket(run_hashes(data, n))
                    counts += np.bincount(buckets[wanted[buckets]], minlength=len(counts))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["bucket", "seen"])
    return task


def _scanner(keys: int, before: np.ndarray, after: np.ndarray, lengths: list[int]) -> Callable:
    """Runs that may be anchors, with what is around them: keys, h, place of the run in its surroundings, surroundings."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, data, bounds in _blocks(b.column(keys)):
                for n in lengths:
                    hashes = run_hashes(data, n)
                    buckets = _bucket(hashes)
                    at = np.flatnonzero(after[buckets])
                    row = np.searchsorted(bounds, at, "right") - 1
                    inside = at + n <= bounds[row + 1]
                    at, row = at[inside], row[inside]
                    if not len(at):
                        continue
                    h, reach, back = hashes[at], after[buckets[at]], before[buckets[at]]
                    # What lies in the run alone needs to be told once a text.
                    alone = (back == 0) & (reach <= n)
                    _, once = np.unique(np.stack([row[alone].astype(np.uint64), h[alone]]), axis=1, return_index=True)
                    keep = np.sort(np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)[once]]))
                    at, row, h = at[keep], row[keep], h[keep]
                    lo, hi = np.maximum(bounds[row], at - back[keep]), np.minimum(bounds[row + 1], at + reach[keep])
                    sizes = hi - lo
                    ends = np.cumsum(sizes)
                    around = data[np.repeat(lo - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
                    offsets = np.append(0, ends).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*[b.column(k).take(pa.array(first + row)) for k in range(keys)], pa.array(h.view(np.int64)), pa.array((at - lo).astype(np.int32)),
                         pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(around)])],
                        names=[*b.schema.names[:keys], "h", "place", "around"])
    return task


class PhraseIndex:
    """Anchors of a phrase list as a written table, and the table of fixed size that tells which runs may be one. Built once, by jobs of its own; a stream
    builds it before its first batch. With texts, the rarest runs there are taken, else the rarest among the phrases."""

    def __init__(self, phrases: DataFrame, texts: DataFrame | None = None, column: str = "text"):
        spark = phrases.sparkSession
        path = fresh_path(spark, "phrase-index")
        (phrases.select("phrase").distinct().filter(F.length("phrase") > 0)
         .mapInArrow(_phrase_runs, "phrase string, at int, n int, h bigint, bucket bigint, size int").write.parquet(f"{path}/runs"))
        runs = spark.read.parquet(f"{path}/runs")
        own = runs.groupBy("bucket").agg(F.count("*").alias("own"), F.max("n").alias("n"))
        seen = spark.createDataFrame([], "bucket bigint, seen bigint")
        if texts is not None:
            buckets = own.select("bucket", "n").toPandas()  # at most 2^19 numbers
            wanted = np.zeros(1 << BUCKET_BITS, bool)
            wanted[buckets["bucket"].to_numpy(np.int64)] = True
            lengths = sorted(buckets["n"].unique().tolist())
            seen = (texts.select(F.lower(column).alias("_low")).mapInArrow(_counter(wanted, lengths), "bucket bigint, seen bigint")
                    .groupBy("bucket").agg(F.sum("seen").alias("seen")))
        rank = F.struct(F.coalesce("seen", F.lit(0)), F.col("own"), F.col("at"))
        (runs.join(own.drop("n"), "bucket").join(seen, "bucket", "left")
         .groupBy("phrase").agg(F.min_by(F.struct("at", "n", "h", "bucket", "size"), rank).alias("a")).select("phrase", "a.*").write.parquet(f"{path}/anchors"))
        self.anchors = spark.read.parquet(f"{path}/anchors")
        reach = self.anchors.groupBy("bucket", "n").agg(F.max("at").alias("before"), F.max(F.col("size") - F.col("at")).alias("after")).toPandas()
        self.before, self.after = np.zeros(1 << BUCKET_BITS, np.int32), np.zeros(1 << BUCKET_BITS, np.int32)
        for name, table in (("before", self.before), ("after", self.after)):
            np.maximum.at(table, reach["bucket"].to_numpy(np.int64), reach[name].to_numpy(np.int32))
        self.lengths = sorted(reach["n"].unique().tolist())


def hits(texts: DataFrame, keys: list[str], column: str, phrases: DataFrame | PhraseIndex) -> DataFrame:
    """(keys, phrase) for each row of texts and each phrase that its lower-case text holds; phrases are lower case."""
    if isinstance(phrases, DataFrame):
        few = [x.phrase for x in phrases.select("phrase").distinct().filter(F.length("phrase") > 0).limit(SHORT + 1).collect()]
        if len(few) <= SHORT:
            low = texts.select(*keys, F.lower(column).alias("_low"))
            held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(p)), F.lit(p)) for p in few])) if few else F.array().cast("array<string>")
            return low.select(*keys, F.explode(held).alias("phrase"))
    index = phrases if isinstance(phrases, PhraseIndex) else PhraseIndex(phrases, texts, column)
    low = texts.select(*keys, F.monotonically_increasing_id().alias("_row"), F.lower(column).alias("_low"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in low.schema.fields[:-1])
    found = low.mapInArrow(_scanner(len(keys) + 1, index.before, index.after, index.lengths), f"{schema}, h bigint, place int, around binary")
    whole = F.expr("place >= at AND substring(around, place - at + 1, size) = encode(phrase, 'UTF-8')")
    return (found.join(index.anchors.select("h", "at", "size", "phrase"), "h").filter(whole)
            .select(*keys, "_row", "phrase").distinct().select(*keys, "phrase"))
