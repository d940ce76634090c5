"""Training-order materialisation: token shards in a keyed random order, of fixed stride.

Every document is one token sequence (its tokens, then END). Sequence i of n gets the slot P(i), P a Feistel network on the next
even power of two that walks its cycles until it falls below n, so slots 0 .. n - 1 are all taken once. A shard is a range
of `per_shard` slots. One shuffle of the texts brings the documents of a shard together in slot order; the task then tokenises and
writes records of `stride` tokens of two bytes, little-endian, back to back, and fills the last record with END. Record r of a
shard starts at byte 2 * stride * r, so a reader that knows (shard, record) resumes with one seek.

Shards are written to a name of the attempt's own and then moved, so a task that runs twice leaves one whole file.
The number of a document is its place in its input partition plus the rows of earlier partitions; docs must therefore be a table in
files (it is read twice). Each step is bounded by one document's tokens and one record.

Defined results: a null or empty text is the sequence (END); repeated rows are sequences of their own; an empty table
writes no shard; null ids are kept as null.
"""
import base64
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lectern.llm.frames import pick
from lectern.llm.memory import tidy
from lectern.llm.words import mixed

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how the public byte-level vocabulary splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
STRIDE = 1024
PER_SHARD = 8192
ROUNDS = 6


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A permutation of 0 .. n - 1, applied to numbers of that range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = x.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (mixed(right + np.uint64((key * ROUNDS + r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def with_slots(docs: DataFrame, key: int = 0) -> tuple[DataFrame, int]:
    """docs with its slot in `_slot`, and the number of slots. What reaches the driver is one count per input partition."""
    counts = {p: c for p, c in docs.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    n = sum(counts.values())
    starts = np.zeros(max(counts, default=0) + 1, np.int64)
    for p in sorted(counts):
        starts[p] = counts[p]
    starts = np.cumsum(starts) - starts

    @F.arrow_udf("bigint")
    def slot(part: pa.Array, place: pa.Array) -> pa.Array:
        return pa.array(feistel(starts[part.to_numpy()] + place.to_numpy(), n, key))

    numbered = docs.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return numbered.withColumn("_slot", slot("_part", "_place")).drop("_part", "_place"), n


def encoder(ranks_path: str) -> Callable[[str], np.ndarray]:
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    own = tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary


class ShardWriter:
    """One shard file: records of fixed stride, whole only after close()."""

    def __init__(self, folder: str, shard: int, stride: int):
        from pyarrow import fs
        self.files, root = fs.FileSystem.from_uri(folder)
        self.path, self.stride, self.written, self.buffer = f"{root}/shard-{shard:08d}.bin", stride, 0, []
        self.attempt = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.attempt)

    def add(self, tokens: np.ndarray) -> int:
        """Appends a sequence; where it starts, in tokens."""
        start = self.written
        self.written += len(tokens)
        self.out.write(tokens.astype("<u2").tobytes())
        return start

    def close(self) -> int:
        """Fills the last record; the number of records."""
        rest = -self.written % self.stride
        self.out.write(np.full(rest, END, "<u2").tobytes())
        self.out.close()
        self.files.move(self.attempt, self.path)
        return (self.written + rest) // self.stride


_INDEX = ("doc_id", "slot", "shard", "start", "n_tokens")


def _write_task(folder: str, ranks_path: str, stride: int) -> Callable:
    def task(batches):
        encode, writer, shard = None, None, None
        for b in batches:
            encode = encode or encoder(ranks_path)
            ids, slots, shards, texts = b.column(0), b.column(1), b.column(2).to_pylist(), pc.fill_null(b.column(3), "")
            starts, sizes = [], []
            for i, s in enumerate(shards):
                if s != shard:
                    if writer:
                        writer.close()
                    writer, shard = ShardWriter(folder, s, stride), s
                tokens = np.array(encode(texts[i].as_py()) + [END], np.uint16)
                starts.append(writer.add(tokens))
                sizes.append(len(tokens))
            yield pa.RecordBatch.from_arrays([ids, slots, b.column(2), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names=list(_INDEX))
        if writer:
            writer.close()
    return task


def write_shards(docs: DataFrame, folder: str, key: int = 0, ranks_path: str = RANKS, stride: int = STRIDE, per_shard: int = PER_SHARD) -> DataFrame:
    """Writes <folder>/tokens/shard-*.bin and the index <folder>/index (Parquet), and returns the index: one row per document with its
    slot, shard, first token in the shard and number of tokens, END included. folder is a URI or path that all executors reach."""
    from pyarrow import fs
    spark = docs.sparkSession
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    files, root = fs.FileSystem.from_uri(f"{folder}/tokens")
    files.create_dir(root)
    rows, n = with_slots(pick(docs, "doc_id", "text"), key)
    shards = max(1, -(-n // per_shard))
    kind = rows.schema["doc_id"].dataType.simpleString()
    (rows.withColumn("_shard", F.expr(f"_slot div {per_shard}L")).select("doc_id", "_slot", "_shard", "text")
     .repartitionById(shards, F.col("_shard").cast("int")).sortWithinPartitions("_slot")
     .mapInArrow(tidy(_write_task(f"{folder}/tokens", ranks_path, stride)), f"doc_id {kind}, slot bigint, shard bigint, start bigint, n_tokens bigint")
     .write.parquet(f"{folder}/index"))
    return spark.read.parquet(f"{folder}/index")


def read_records(folder: str, shard: int, record: int = 0, stride: int = STRIDE) -> Iterator[np.ndarray]:
    """The records of a shard from one on, in order."""
    from pyarrow import fs
    files, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    with files.open_input_file(f"{root}/tokens/shard-{shard:08d}.bin") as f:
        f.seek(2 * stride * record)
        while data := f.read(2 * stride):
            yield np.frombuffer(data, "<u2")


def read_sequences(index: DataFrame, folder: str, stride: int = STRIDE) -> DataFrame:
    """The index with the tokens of each document as read from the shards. A task reads each of its shards forward, record by record."""
    def task(batches):
        shard, records, have, begin = None, None, np.zeros(0, np.uint16), 0
        for b in batches:
            tokens = []
            for s, start, n in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                if s != shard:
                    shard, first = s, start // stride
                    records, have, begin = read_records(folder, s, first, stride), np.zeros(0, np.uint16), first * stride
                parts = [have[start - begin:]]
                got = len(parts[0])
                while got < n:
                    parts.append(next(records))
                    got += stride
                have, begin = np.concatenate(parts), start
                tokens.append(have[:n].tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tokens, pa.binary())], names=[*_INDEX, "tokens"])

    kind = index.schema["doc_id"].dataType.simpleString()
    return (index.select(*_INDEX).repartition("shard").sortWithinPartitions("shard", "start")
            .mapInArrow(tidy(task), f"doc_id {kind}, slot bigint, shard bigint, start bigint, n_tokens bigint, tokens binary"))
