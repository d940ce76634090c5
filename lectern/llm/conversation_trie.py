"""A prefix trie over conversations: every distinct beginning is a node, with what is shared below it.

1. A turn becomes a unit of 32 characters (a 128-bit digest of role and text, and its number of words), a conversation the string of its units,
   its path. Texts never leave the task that reads them.
2. Equal paths become one row (conversations, least id). The digest of their ids streams through ids sorted by path and number.
3. Distinct paths are range partitioned and sorted, so a shard is a contiguous run of paths, cut into blocks of BLOCK_UNITS turns. A hot
   beginning is cut by its later turns like any other. Each block numbers its turns densely and packs its trie into BASE and CHECK (child of
   s by turn t: slot BASE[s] + t, valid if CHECK of that slot is s). Paths are then walked through the arrays to reach their nodes.
4. Paths with a common beginning stand side by side, so only beginnings of a block's first and last path can occur in other blocks. All other
   nodes are whole in their block, their subtrees too. The shared ones (two chains a block) are merged by a grouped sum; what they
   themselves add to the subtrees above is summed along the chains, each node on one chain only.

A task holds one block: its turns, or one conversation's keys if that is longer (32 bytes a turn).

Defined results: turns are ordered by turn, null first, ties by unit; null role and text read as ''; rows without conv_id are no conversation;
repeated rows are turns of their own; an empty table gives no nodes, not even a root; other columns are ignored.
"""
import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lectern.llm.frames import pick
from lectern.session import fresh_path

UNIT = 32
BLOCK_UNITS = 1 << 17
TRIES = 64  # free slots tried for a node with several children before it goes to the end of the arrays; decides density, not results
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
_LAST = np.iinfo(np.int64).max


def turn_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("bigint")), 16, "0")
    turns = (pick(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
             .select("conv_id", "turn", F.base64(F.unhex(F.concat(digest, words))).alias("unit")))
    return (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "unit"))).alias("_turns"))
            .select("conv_id", F.array_join("_turns.unit", "").alias("path")))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (end, conv_id), sorted, to one digest for each end; ids are hashed as they pass."""
    end, digest = None, None
    for b in batches:
        done = []
        if not b.num_rows:
            continue
        coded = b.column(0).dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        ids = b.column(1).cast(pa.string()).to_pylist()
        starts = np.flatnonzero(np.diff(codes, prepend=-1)).tolist()
        for lo, hi in zip(starts, [*starts[1:], len(ids)]):
            name, part = names[codes[lo]], ",".join(ids[lo:hi]).encode()
            if name == end:
                digest.update(b"," + part)
            else:
                if digest:
                    done.append((end, digest.hexdigest()))
                end, digest = name, hashlib.sha256(part)
        yield pa.RecordBatch.from_pylist([{"end": e, "ends_sha256": d} for e, d in done], pa.schema([("end", pa.string()), ("ends_sha256", pa.string())]))
    if digest:
        yield pa.RecordBatch.from_pylist([{"end": end, "ends_sha256": digest.hexdigest()}])


def end_digests(paths: DataFrame) -> DataFrame:
    """(end, ends_sha256): SHA-256 of the ids of all conversations of one path, ascending, comma-joined; end is the path's digest."""
    return (paths.select(F.md5(F.col("path").cast("binary")).alias("end"), F.col("conv_id").cast("bigint").alias("conv_id"))
            .repartition("end").sortWithinPartitions("end", "conv_id").mapInArrow(_join_ids, "end string, ends_sha256 string"))


class DoubleArray:
    """BASE and CHECK over dense turn ids. Slot 0 is the root; a slot with CHECK -1 is free."""

    def __init__(self, kinds: int):
        self.kinds = max(kinds, 1)
        self.base, self.check = np.zeros(1024, np.int64), np.full(1024, -1, np.int64)
        self.check[0], self.low, self.end = 0, 1, 1

    def _reserve(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.append(self.base, np.zeros(more, np.int64)), np.append(self.check, np.full(more, -1, np.int64))

    def _free(self, n: int) -> np.ndarray:
        """The first n free slots."""
        self._reserve(self.end + n)
        free = self.low + np.flatnonzero(self.check[self.low:self.end + n] < 0)[:n]
        self.low = int(free[0])
        return free

    def _take(self, slots: np.ndarray, parents: np.ndarray) -> None:
        self.check[slots] = parents
        self.end = max(self.end, int(slots.max()) + 1)

    def add_level(self, parents: np.ndarray, turns: np.ndarray) -> None:
        """Children of nodes without any yet; rows are distinct and sorted by parent, then turn."""
        starts = np.flatnonzero(np.diff(parents, prepend=-1))
        counts = np.diff(np.append(starts, len(parents)))
        for at, n in zip(starts[counts > 1].tolist(), counts[counts > 1].tolist()):
            own = turns[at:at + n]
            span = int(own[-1] - own[0]) + 1
            self._reserve(self.end + span + TRIES)
            for first in [*self._free(TRIES).tolist(), self.end]:
                self._reserve(first + span)
                if (self.check[first + own - own[0]] < 0).all():
                    break
            self.base[parents[at]] = first - own[0]
            self._take(first + own - own[0], np.full(n, parents[at]))
        lone = starts[counts == 1]
        if len(lone):
            slots = self._free(len(lone))
            self.base[parents[lone]] = slots - turns[lone]
            self._take(slots, parents[lone])

    def step(self, states: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The child of each state by its turn, -1 where there is none."""
        slots = self.base[states] + turns
        inside = (slots > 0) & (slots < len(self.check))
        return np.where(inside & (self.check[np.where(inside, slots, 0)] == states), slots, -1)


def pack(turns: np.ndarray, lengths: np.ndarray, kinds: int) -> DoubleArray:
    """The trie of sequences laid end to end."""
    trie, starts = DoubleArray(kinds), np.cumsum(lengths) - lengths
    live, depth = np.flatnonzero(lengths > 0), 0
    states = np.zeros(len(lengths), np.int64)
    while len(live):
        pairs = np.unique(states[live] * trie.kinds + turns[starts[live] + depth])
        trie.add_level(*np.divmod(pairs, trie.kinds))
        states[live] = trie.step(states[live], turns[starts[live] + depth])
        depth += 1
        live = live[lengths[live] > depth]
    return trie


def walk(trie: DoubleArray, turns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The nodes that each sequence passes, the root first, laid end to end."""
    starts = np.cumsum(lengths) - lengths
    places = starts + np.arange(len(lengths))
    out = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
    live, depth = np.flatnonzero(lengths > 0), 0
    while len(live):
        out[places[live] + depth + 1] = trie.step(out[places[live] + depth], turns[starts[live] + depth])
        depth += 1
        live = live[lengths[live] > depth]
    return out


_COLUMNS = [("chain", pa.int64()), ("key", pa.string()), ("parent_key", pa.string()), ("depth", pa.int64()), ("words", pa.int64()), ("conv_id", pa.int64()),
            ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
            ("ends_sha256", pa.string())]
_SCHEMA = pa.schema(_COLUMNS)


def _keys(path: str) -> list[str]:
    """A digest for each beginning of a path, the root's first."""
    out = [hashlib.md5(b"").hexdigest()]
    for at in range(0, len(path), UNIT):
        out.append(hashlib.md5((out[-1] + path[at:at + UNIT]).encode()).hexdigest())
    return out


def _block(chain: int, paths: list[str], counts: list[int], ids: list[int], ends: list[str]) -> pa.RecordBatch:
    lengths = np.array([len(p) // UNIT for p in paths], np.int64)
    units, turns = np.unique(np.frombuffer("".join(paths).encode(), f"S{UNIT}"), return_inverse=True)
    parts = np.frombuffer(base64.b64decode(units.tobytes()), np.uint8).reshape(-1, 24)
    unit_words = np.ascontiguousarray(parts[:, 16:]).view(">i8").ravel().astype(np.int64)
    trie = pack(turns, lengths, len(units))
    nodes = walk(trie, turns, lengths)
    size = len(trie.check)
    per_path = lengths + 1
    stops = np.cumsum(per_path)
    depth, words = np.zeros(size, np.int64), np.zeros(size, np.int64)
    place = np.arange(len(nodes)) - np.repeat(stops - per_path, per_path)
    depth[nodes] = place
    words[nodes[place > 0]] = unit_words[turns]
    n_convs, least = np.zeros(size, np.int64), np.full(size, _LAST)
    np.add.at(n_convs, nodes, np.repeat(np.array(counts, np.int64), per_path))
    np.minimum.at(least, nodes, np.repeat(np.array(ids, np.int64), per_path))
    digest = dict(zip(nodes[stops - 1].tolist(), ends))

    shared = np.zeros(size, bool)
    rims = [(chain, 0)] + ([(chain + 1, len(paths) - 1)] if len(paths) > 1 else [])
    key_of, chains = {}, []
    for number, row in rims:
        own = nodes[stops[row] - per_path[row]:stops[row]].tolist()
        names = _keys(paths[row])
        chains.append((number, own, names))
        key_of.update(zip(own, names))
        shared[own] = True
    used = np.flatnonzero(trie.check >= 0)
    inner = used[~shared[used]]
    children = np.bincount(trie.check[inner], minlength=size)
    leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64)
    leaves[inner] = children[inner] == 0
    saved[inner] = (n_convs[inner] - 1) * words[inner]
    by_depth = used[np.argsort(-depth[used], kind="stable")]
    for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        level = level[level > 0]
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])

    above = trie.check[inner]
    rows = {"chain": [None] * len(inner), "key": [None] * len(inner), "parent_key": [key_of.get(p) for p in above.tolist()], "depth": depth[inner].tolist(),
            "words": words[inner].tolist(), "conv_id": least[inner].tolist(),
            "parent_conv_id": [None if s else c for s, c in zip(shared[above].tolist(), least[above].tolist())], "n_convs": n_convs[inner].tolist(),
            "n_children": children[inner].tolist(), "n_leaves": leaves[inner].tolist(), "saved_tokens": saved[inner].tolist(),
            "ends_sha256": [digest.get(s) for s in inner.tolist()]}
    told = set()  # a node of both chains adds its figures once
    for number, own, names in chains:
        for d, s in enumerate(own):
            new = s not in told
            told.add(s)
            for name, value in (("chain", number), ("key", names[d]), ("parent_key", names[d - 1] if d else None), ("depth", d), ("words", int(words[s])),
                                ("conv_id", int(least[s])), ("parent_conv_id", None), ("n_convs", int(n_convs[s]) * new), ("n_children", int(children[s]) * new),
                                ("n_leaves", int(leaves[s]) * new), ("saved_tokens", int(saved[s]) * new), ("ends_sha256", digest.get(s))):
                rows[name].append(value)
    return pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in _COLUMNS], schema=_SCHEMA)


def _tries(block_units: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, units, chain = ([], [], [], []), 0, None
        for b in batches:
            if chain is None and b.num_rows:
                chain = b.column("part")[0].as_py() << 32
            for row in zip(*(b.column(c).to_pylist() for c in ("path", "n", "conv_id", "ends_sha256"))):
                for column, value in zip(held, row):
                    column.append(value)
                units += len(row[0]) // UNIT + 1
                if units >= block_units:
                    yield _block(chain, *held)
                    held, units, chain = ([], [], [], []), 0, chain + 2
        if held[0]:
            yield _block(chain, *held)
    return task


def prefix_trie(paths: DataFrame, block_units: int = BLOCK_UNITS) -> DataFrame:
    """The nodes of (conv_id, path): conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark, folder = paths.sparkSession, fresh_path(paths.sparkSession, "prefix-trie")
    distinct = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").cast("bigint").alias("conv_id"))
    (distinct.join(end_digests(paths), F.md5(F.col("path").cast("binary")) == F.col("end")).select("path", "n", "conv_id", "ends_sha256")
     .write.parquet(f"{folder}/paths"))
    (spark.read.parquet(f"{folder}/paths").orderBy("path").withColumn("part", F.spark_partition_id().cast("bigint"))
     .mapInArrow(_tries(block_units), ", ".join(f"{n} {'string' if t == pa.string() else 'bigint'}" for n, t in _COLUMNS)).write.parquet(f"{folder}/nodes"))
    nodes = spark.read.parquet(f"{folder}/nodes")

    chains = nodes.filter("chain IS NOT NULL")
    merged = chains.groupBy("key").agg(
        F.min("chain").alias("owner"), F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.min("conv_id").alias("conv_id"), F.max("ends_sha256").alias("ends_sha256"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    kids = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("_kids"))
    (merged.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_kids", F.lit(0))).drop("_kids")
     .withColumn("own_leaf", (F.col("n_children") == 0).cast("bigint")).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("words"))
     .write.parquet(f"{folder}/shared"))
    shared = spark.read.parquet(f"{folder}/shared")
    upward = Window.partitionBy("chain").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mine = lambda c: F.sum(F.when(F.col("chain") == F.col("owner"), F.col(c)).otherwise(0)).over(upward).alias(c)
    below = (chains.select("chain", "key").join(shared.select("key", "depth", "owner", "own_leaf", "own_saved"), "key")
             .select("key", mine("own_leaf"), mine("own_saved")).groupBy("key").agg(F.sum("own_leaf").alias("_leaves"), F.sum("own_saved").alias("_saved")))
    parents = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")]
    upper = (shared.join(below, "key").join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("_parent"))
             .withColumn("n_leaves", F.col("n_leaves") + F.col("_leaves")).withColumn("saved_tokens", F.col("saved_tokens") + F.col("_saved")).select(out))
    inner = (nodes.filter("chain IS NULL").join(parents, "parent_key", "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent")).select(out))
    return upper.union(inner)
