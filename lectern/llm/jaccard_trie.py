"""Set-similarity join of documents by a prefix tree over globally ordered n-grams.

A document's set holds its distinct SHINGLE-word shingles as 64-bit numbers whose leading bits are a frequency level, so that
ascending order puts rare shingles first in all sets alike. Levels come from counts of all shingles of all documents, kept in
2^SKETCH_BITS counters (a fixed size).

1. Documents of equal sets form a class; its smallest doc_id stands for it.
2. Two sets of Jaccard similarity T or more share one of their first n - ceil(T n) + 1 shingles. All classes that have such a
   shingle meet at the smallest of them, their centre, so the members of one centre contain every pair still possible.
3. Members that share a passage only are parted before any whole set is sent: two sets overlap by no more than the sum, over
   bins of the shingles, of the smaller count, so pairs whose sum is below the needed overlap are out. What may still be similar
   stays together as a group; equal groups of several centres are taken once.
4. The sets of a group are stored in a trie, and each is matched against it from the root: overlaps along a path
   are counted once for all sets below, and a subtree is left when the shingles remaining on either side cannot reach the needed
   overlap, or when all below is linked with the set already. What is returned are links that span the components.
5. A centre with many members is cut into slices that all hold the centre. Members that did not reach the centre's component are
   then matched against every other slice.

No list of all pairs is made, whole texts are read, and nothing is capped.

Defined results: null and empty texts have an empty set and link with nothing; rows of one doc_id are one node, but
each row keeps its own set size; a row without doc_id links with nothing and has a null component.
"""
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.bits import key_bits, maybe_in
from lectern.llm.components import components
from lectern.llm.frames import pick
from lectern.llm.memory import tidy
from lectern.llm.words import BLANK_SEPARATED, coefficients, grams, hash_words, mixed, pack_lists, text_blocks
from lectern.session import fresh_path

SHINGLE, NEED = 4, (85, 100)
SKETCH_BITS = 18
CHUNK = 1 << 10
SLICE = 4000  # members of a centre in one task
FEW_BINS, PER_BIN = 64, 4  # bins of a set are a power of two that grows with it, so that a bin holds PER_BIN shingles at most on average
FULL = 255  # a bin that can't count on; such sets are compared by size alone


def shingle_hashes(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all rows in order, and each row's bounds in them; a row of fewer words gives its whole sequence."""
    counts = np.diff(first)
    each = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(each)))
    at = np.repeat(first[:-1], each) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], each)
    padded = np.concatenate((hashes, np.zeros(SHINGLE, np.uint64)))
    out = grams(padded, SHINGLE)[at]
    for n in range(1, SHINGLE):
        rows = np.flatnonzero(counts == n)
        if len(rows):
            out[bounds[rows]] = grams(padded, n)[first[rows]]
    return out, bounds


def _shingled(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, data, bounds in text_blocks(column):
        yield lo, hi, *shingle_hashes(*hash_words(data, bounds, BLANK_SEPARATED))


def frequency_levels(docs: DataFrame) -> np.ndarray:
    """A byte for each counter: the magnitude of its count. Tasks add up their own counts first; 256 rows reach the driver."""
    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for _, _, shingles, _ in _shingled(b.column(0)):
                total += np.bincount((shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total) // CHUNK)), pa.array([x.tobytes() for x in total.reshape(-1, CHUNK)], pa.binary())],
                                             names=["chunk", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, counts in zip(b.column(0).to_pylist(), b.column(1)):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk bigint, counts binary"
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for chunk, counts in pick(docs, "text").mapInArrow(tidy(count), schema).repartition(F.col("chunk")).mapInArrow(tidy(add), schema).collect():
        total[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(counts, np.int64)
    return np.ceil(np.log2(total + 1)).astype(np.uint8)


def ordered_sets(shingles: np.ndarray, bounds: np.ndarray, levels: np.ndarray) -> Iterator[np.ndarray]:
    """Each row's distinct shingles in the global order."""
    level = levels[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    keyed = (level << np.uint64(57)) | (mixed(shingles) >> np.uint64(7))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = np.sort(keyed[lo:hi])
        yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def binned(own: np.ndarray) -> np.ndarray:
    n = FEW_BINS
    while n * PER_BIN < len(own):
        n *= 2
    return np.minimum(np.bincount((own & np.uint64(n - 1)).astype(np.int64), minlength=n), FULL).astype(np.uint8)


def prefix_length(n: int) -> int:
    return n - -(-n * NEED[0] // NEED[1]) + 1 if n else 0


def _sets_task(levels: np.ndarray, whole: bool) -> Callable:
    """whole: (id, tokens) with all of a set; else (id, n, c1, c2, bins, tokens) with its prefix."""
    def task(batches):
        for b in batches:
            for lo, hi, shingles, bounds in _shingled(b.column(1)):
                c1, c2, sizes, bins, lists, lengths = [], [], [], [], [], []
                place = coefficients(int(np.diff(bounds).max(initial=1)) + 1, 5)
                for own in ordered_sets(shingles, bounds, levels):
                    sizes.append(len(own))
                    if not whole:
                        c1.append(int((own * place[:len(own)]).sum(dtype=np.uint64)))
                        c2.append(int((mixed(own) * place[:len(own)]).sum(dtype=np.uint64)))
                        bins.append(binned(own).tobytes())
                        own = own[:prefix_length(len(own))]
                    lists.append(own)
                    lengths.append(len(own))
                tokens = pack_lists(np.concatenate(lists).view(np.int64), np.array(lengths), pa.int64())
                ids = b.column(0).slice(lo, hi - lo)
                if whole:
                    yield pa.RecordBatch.from_arrays([ids, tokens], names=["id", "tokens"])
                else:
                    yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(np.array(c1, np.uint64).view(np.int64)),
                                                      pa.array(np.array(c2, np.uint64).view(np.int64)), pa.array(bins, pa.binary()), tokens],
                                                     names=["id", "n", "c1", "c2", "bins", "tokens"])
    return task


class Trie:
    """A prefix tree with whole edges. Leaves are the sets; inner nodes keep the sizes below and whether all below is one component."""

    def __init__(self, sets: list[np.ndarray], parent: list[int]):
        self.sets, self.parent = sets, parent
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.root = self._node(0, len(sets), 0)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _node(self, lo: int, hi: int, depth: int) -> list:
        """[edge tokens, depth after the edge, smallest and largest size below, a leaf below, one component, children]"""
        made: list = []
        todo = [(lo, hi, depth, made)]
        while todo:
            lo, hi, depth, into = todo.pop()
            a, b = self.sets[self.order[lo]], self.sets[self.order[hi - 1]]
            if hi - lo == 1:
                into.append([a[depth:], len(a), len(a), len(a), self.order[lo], True, []])
                continue
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[depth:n] != b[depth:n])
            end = depth + int(differ[0]) if len(differ) else n
            sizes = [len(self.sets[self.order[i]]) for i in range(lo, hi)]
            node = [a[depth:end], end, min(sizes), max(sizes), self.order[lo], False, []]
            into.append(node)
            start = lo
            while start < hi:
                own = self.sets[self.order[start]]
                stop = start + 1
                if len(own) > end:
                    while stop < hi and self.sets[self.order[stop]][end] == own[end]:
                        stop += 1
                todo.append((start, stop, end, node[6]))
                start = stop
        return made[0]

    def match(self, i: int, link: Callable[[int, int], None]) -> None:
        """Link set i with what it must be linked with and isn't yet, so that its component is complete."""
        own = self.sets[i]
        todo = [(self.root, 0, 0, None)]
        while todo:
            node, overlap, at, after = todo.pop()
            edge, depth, small, large, leaf, one, children = node
            if after:  # all below has been looked at
                root = self.find(leaf)
                node[5] = all(c[5] and self.find(c[4]) == root for c in children)
                continue
            if one and self.find(leaf) == self.find(i):
                continue
            if 100 * min(len(own), large) < 85 * max(len(own), small):
                continue
            need = -(-NEED[0] * (len(own) + small) // (NEED[0] + NEED[1]))
            if overlap + min(len(own) - at, large - depth + len(edge)) < need:
                continue
            if len(edge):
                stop = int(np.searchsorted(own, edge[-1], "right"))
                overlap += len(edge) + stop - at - len(np.union1d(edge, own[at:stop])) if stop > at else 0
                at = stop
            if not children:
                if leaf != i and (NEED[0] + NEED[1]) * overlap >= NEED[0] * (len(own) + small):
                    link(i, leaf)
            elif overlap + min(len(own) - at, large - depth) >= need:
                todo.append((node, 0, 0, True))
                todo.extend((c, overlap, at, None) for c in children)


def spanning_links(ids: list[int], sets: list[np.ndarray], known: list[int]) -> list[tuple[int, int]]:
    """Links that join all similar sets into components, beyond those of equal `known` number."""
    seen: dict[int, int] = {}
    parent = [seen.setdefault(k, i) for i, k in enumerate(known)]
    trie, found = Trie(sets, parent), []

    def link(i, j):
        a, b = trie.find(i), trie.find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            found.append((ids[i], ids[j]))

    for i in range(len(sets)):
        trie.match(i, link)
    return found


def _groups(batches, width: int) -> Iterator[tuple[list, ...]]:
    """Rows sorted by their first `width` columns, one group at a time, as lists of the other columns."""
    key, rows = None, None
    for b in batches:
        keys = list(zip(*(b.column(i).to_pylist() for i in range(width))))
        others = [b.column(i) for i in range(width, b.num_columns)]
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            if keys[lo] != key:
                if rows:
                    yield tuple(rows)
                key, rows = keys[lo], [[] for _ in others]
            for column, values in zip(rows, others):
                column.extend(values.slice(lo, hi - lo))
    if rows:
        yield tuple(rows)


def possible_groups(sizes: np.ndarray, bins: list[np.ndarray]) -> list[int]:
    """For each set the first set of its group; sets of different groups are surely not similar."""
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    widths = np.array([len(bins[i]) for i in order])
    parent = list(range(len(sizes)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def compare(lo, hi, counts, start, stop, others):
        """All of lo <= i < hi with all of start <= j < stop, a bounded piece at a time."""
        step = max(1, (1 << 21) // (16 * counts.shape[1]))
        for a in range(lo, hi, 16):
            b = min(a + 16, hi)
            first, last = max(start, a), int(np.searchsorted(sizes[:stop], sizes[b - 1] * NEED[1] // NEED[0], "right"))
            for c in range(first, last, step):
                d = min(c + step, last)
                x, y = counts[a - lo:b - lo, None], others[None, c - start:d - start]
                small = np.minimum(sizes[a:b, None], sizes[None, c:d])
                most = np.where((x == FULL).any(2) | (y == FULL).any(2), small, np.minimum(x, y).sum(axis=2, dtype=np.int64))
                for i, j in np.argwhere((NEED[0] + NEED[1]) * most >= NEED[0] * (sizes[a:b, None] + sizes[None, c:d])).tolist():
                    p, q = find(a + i), find(c + j)
                    if p != q:
                        parent[max(p, q)] = min(p, q)

    # Sizes ascend, and so do widths. Similar sets have the same width or neighbouring ones; the wider counts are then folded.
    spans = [(int(np.searchsorted(widths, w)), int(np.searchsorted(widths, w, "right")), int(w)) for w in np.unique(widths)]
    tables = [np.stack([bins[i] for i in order[lo:hi]]) for lo, hi, _ in spans]
    for k, (lo, hi, width) in enumerate(spans):
        compare(lo, hi, tables[k], lo, hi, tables[k])
        if k + 1 < len(spans) and spans[k + 1][2] == 2 * width:
            start, stop, _ = spans[k + 1]
            wide = tables[k + 1].astype(np.uint16)
            folded = np.where((tables[k + 1] == FULL).any(1)[:, None], FULL, np.minimum(wide[:, :width] + wide[:, width:], FULL)).astype(np.uint8)
            compare(lo, hi, tables[k], start, stop, folded)
    out = [0] * len(sizes)
    for i in range(len(sizes)):
        out[order[i]] = int(order[find(i)])
    return out


def _possible_task(batches):
    """Rows (centre, slice, id, known, n, bins) sorted by centre and slice, to (g1, g2, id, known); a group's number follows from its members."""
    for ids, known, sizes, bins in _groups(batches, 2):
        ids, known = [x.as_py() for x in ids], [x.as_py() for x in known]
        counts = [np.frombuffer(x.as_py(), np.uint8) for x in bins]
        members: dict[int, list[int]] = {}
        for i, g in enumerate(possible_groups(np.array([x.as_py() for x in sizes]), counts)):
            members.setdefault(g, []).append(i)
        out = []
        for rows in members.values():
            if len({known[i] for i in rows}) > 1:
                own = mixed(np.sort(np.array([ids[i] for i in rows], np.int64)).view(np.uint64))
                g1, g2 = (int((own * coefficients(len(own), seed)).sum(dtype=np.uint64).view(np.int64)) for seed in (8, 9))
                out.extend((g1, g2, ids[i], known[i]) for i in rows)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["g1", "g2", "id", "known"])


def _match_task(batches):
    """Rows (g1, g2, id, known, tokens) sorted by group, to links (a, b)."""
    for ids, known, tokens in _groups(batches, 2):
        sets = [np.asarray(x.values).view(np.uint64) for x in tokens]
        found = spanning_links([x.as_py() for x in ids], sets, [x.as_py() for x in known])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])


def _linked(members: DataFrame, features: DataFrame, docs: DataFrame, levels: np.ndarray, path: str) -> DataFrame:
    """Links (a, b) inside the slices of members (centre, slice, id, known)."""
    spark = docs.sparkSession
    possible = (members.join(features, "id").select("centre", "slice", "id", "known", "n", "bins").repartition("centre", "slice")
                .sortWithinPartitions("centre", "slice", "id").mapInArrow(tidy(_possible_task), "g1 bigint, g2 bigint, id bigint, known bigint").distinct())
    possible.write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")
    near = (maybe_in(docs.withColumnRenamed("doc_id", "id"), "id", key_bits(groups.select("id"), "id")).filter("_maybe").select("id", "text"))
    sets = near.mapInArrow(tidy(_sets_task(levels, True)), "id bigint, tokens array<bigint>").repartition("id").dropDuplicates(["id", "tokens"])
    (groups.join(sets, "id").select("g1", "g2", "id", "known", "tokens").repartition("g1", "g2").sortWithinPartitions("g1", "g2", "id")
     .mapInArrow(tidy(_match_task), "a bigint, b bigint").write.parquet(f"{path}/links"))
    return spark.read.parquet(f"{path}/links")


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs."""
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    levels = frequency_levels(docs)
    path = fresh_path(spark, "jaccard")
    (docs.mapInArrow(tidy(_sets_task(levels, False)), "id bigint, n bigint, c1 bigint, c2 bigint, bins binary, tokens array<bigint>")
     .write.parquet(f"{path}/prefixes"))
    rows = spark.read.parquet(f"{path}/prefixes")
    whole = rows.filter("n > 0 AND id IS NOT NULL")
    classes = whole.groupBy("c1", "c2").agg(F.min("id").alias("rep"))
    first = whole.join(classes.select("c1", "c2", F.col("rep").alias("id")), ["c1", "c2", "id"], "leftsemi")
    entries = first.select("id", F.explode("tokens").alias("token"))
    centres = entries.groupBy("token").agg(F.min("id").alias("centre"), F.max("id").alias("_last")).filter("centre < _last").select("token", "centre")
    entries.join(centres, "token").select("centre", "id").distinct().write.parquet(f"{path}/members")
    met = spark.read.parquet(f"{path}/members")
    features = whole.select("id", "n", "bins")
    sizes = met.groupBy("centre").agg(F.ceil(F.count("*") / SLICE).alias("slices"))
    own_slice = F.when(F.col("id") == F.col("centre"), F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("id"), F.col("slices"))))
    sliced = met.join(sizes, "centre").select("centre", F.explode(own_slice).alias("slice"), "id", F.col("id").alias("known"))
    links = _linked(sliced, features, docs, levels, f"{path}/0")
    many = sizes.filter("slices > 1")
    if many.head(1):
        links = links.union(_linked(_across(met, many, links), features, docs, levels, f"{path}/1"))
    again = whole.select("id", "c1", "c2").join(classes, ["c1", "c2"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    joined = components(links.union(again))
    return (rows.join(joined.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def _across(met: DataFrame, many: DataFrame, links: DataFrame) -> DataFrame:
    """Members of sliced centres once more: those outside the centre's component visit every slice, the others stay in their own."""
    joined = components(links)
    placed = (met.join(many, "centre").join(joined, "id", "left").withColumn("known", F.coalesce("component", "id")).drop("component")
              .join(joined.select(F.col("id").alias("centre"), F.col("component").alias("_home")), "centre", "left")
              .withColumn("_stray", F.col("known") != F.coalesce("_home", "centre")))
    strays = placed.filter("_stray")
    visits = strays.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)))
    stay = (placed.filter("NOT _stray").join(strays.select("centre").distinct(), "centre", "leftsemi")
            .withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices"))))
    return visits.select("centre", "slice", "id", "known").union(stay.select("centre", "slice", "id", "known"))
