"""Harmonic packing of documents into sequences of CAPACITY tokens.

A piece of s tokens belongs to the class of s, whose bins take k = CAPACITY div s pieces each: a fixed number, so a worker fills the bins of a class
by counting, without looking at other classes or other workers. A bin of class s wastes CAPACITY - k s tokens; classes that
waste at most SLACK are the open ones. A document gives as many whole sequences as it fills; the rest is cut into the fewest pieces of open classes
(about two on average; with SLACK 0 only powers of two are open, and nothing is wasted). Bins that are still part-filled at the
end of a worker's documents are laid end to end into whole sequences, and what is left of those into sequences whose lengths are powers of two.

So padding is below SLACK / CAPACITY in every table, and nothing is shuffled: a worker keeps the pieces of one part-filled bin per class at most (below
a million tokens) and one document.

Defined results: a null or empty text is the single token END; null ids stay null; repeated rows are documents of their own; an empty
table gives no pieces; other columns are ignored. A sequence's number is its worker's number and its place there, so it depends on how the table is split
into tasks, but a task that runs twice gives the same rows. docs must be read from files.
"""
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lectern.llm.frames import pick
from lectern.llm.training_order import PATTERN

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
CAPACITY = 2048
SLACK = 16
END = 1
ROWS_OUT = 4096


def cut_plan(capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """For each number of tokens below capacity, the longest piece to cut first so that the fewest pieces of open classes result."""
    sizes = [s for s in range(1, capacity + 1) if capacity % s <= slack]
    fewest, first = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
    sizes = np.array(sizes)
    for n in range(1, capacity + 1):
        fit = sizes[sizes <= n]
        best = fewest[n - fit]
        at = len(fit) - 1 - int(np.argmin(best[::-1]))
        fewest[n], first[n] = best[at] + 1, fit[at]
    return first.tolist()


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Token ids of a text, with END after it, of a byte-level vocabulary in the tokenizers library's format. Its merges are ranked by their
    tokens' ids, so the same ids come from tiktoken, at a third of the time; a file whose merges are not so ranked is refused."""
    import json

    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocabulary = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or sorted(merged) != merged:
        raise ValueError(f"{path} is not a byte-level vocabulary with merges in the order of their ids")
    # Byte-level vocabularies write a printable byte as itself and the others, in order, as the characters from U+0100 on.
    plain = [b for b in range(256) if 33 <= b <= 126 or (b >= 161 and b != 173)]
    other = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    own = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: np.append(own.encode_to_numpy(text, allowed_special="all"), END).astype(np.uint32)


class Packer:
    """The bins of one worker. A piece is (document, start, ids, document's tokens)."""

    def __init__(self, capacity: int, slack: int, emit: Callable):
        self.capacity, self.plan, self.emit = capacity, cut_plan(capacity, slack), emit
        self.bins, self.sequences = {}, 0

    def _write(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.emit(doc, start, ids, total, self.sequences, at)
            at += len(ids)
        self.sequences += 1

    def add(self, doc, ids: np.ndarray) -> None:
        at, total = 0, len(ids)
        while at < total:
            size = self.plan[min(total - at, self.capacity)]
            bin_ = self.bins.setdefault(size, [])
            bin_.append((doc, at, ids[at:at + size], total))
            if len(bin_) == self.capacity // size:
                self._write(bin_)
                del self.bins[size]
            at += size

    def close(self) -> None:
        """What is left in part-filled bins, as whole sequences and sequences of powers of two."""
        rest = [p for size in sorted(self.bins, reverse=True) for p in self.bins[size]]
        left = sum(len(p[2]) for p in rest)
        rest.reverse()
        while left:
            room = min(self.capacity, 1 << (left.bit_length() - 1))
            left -= room
            own = []
            while room:
                doc, start, ids, total = rest.pop()
                own.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    rest.append((doc, start + room, ids[room:], total))
                room -= len(own[-1][2])
            self._write(own)


def _pack_task(path: str, capacity: int, slack: int, schema: pa.Schema) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, encode, first = [], None, 0
        packer = Packer(capacity, slack, lambda doc, start, ids, total, sequence, at: out.append(
            (doc, start, len(ids), ids.astype("<u4").tobytes(), total, first + sequence, at)))

        def rows(least: int) -> Iterator[pa.RecordBatch]:
            while len(out) >= max(least, 1):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[:ROWS_OUT]), schema.types)], schema=schema)
                del out[:ROWS_OUT]

        for b in batches:
            encode = encode or encoder(path)
            if b.num_rows:
                first = b.column(2)[0].as_py() << 40
            texts = pc.fill_null(b.column(1), "")
            for doc, text in zip(b.column(0).to_pylist(), texts):
                packer.add(doc, encode(text.as_py()))
                yield from rows(ROWS_OUT)
        packer.close()
        yield from rows(1)
    return task


def packed_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """One row per piece: doc_id, start (tokens of the document before it), length, ids (32-bit little-endian), doc_tokens, sequence_id, offset."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())])
    return (pick(docs, "doc_id", "text").withColumn("_part", F.spark_partition_id().cast("bigint"))
            .mapInArrow(_pack_task(tokenizer, capacity, slack, schema),
                        f"doc_id {kind.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, `offset` bigint"))


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad: int = END) -> DataFrame:
    """One row per sequence: sequence_id, ids (padded to capacity unless a power of two), offsets where its pieces begin, length without padding."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("_parts"), F.sum("length").alias("length"))
    filler = F.unhex(F.repeat(F.lit(np.array([pad], "<u4").tobytes().hex()), (F.lit(capacity) - F.col("length")).cast("int")))
    joined = F.unhex(F.array_join(F.transform("_parts", lambda p: F.hex(p["ids"])), ""))
    power = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    return rows.select("sequence_id", F.when(power, joined).otherwise(F.concat(joined, filler)).alias("ids"), F.col("_parts.offset").alias("offsets"), "length")
