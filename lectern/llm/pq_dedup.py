"""Near-duplicate embeddings by an inverted file with product-quantised residuals.

1. Equal vectors of a label form a class, met once. Vectors are scaled to unit length.
2. Coarse lists (k-means) and the codebooks of residual subspaces are fitted on a bounded, keyed sample (SAMPLE_FLOATS); every
   vector is indexed: list, residual code, and the length of what the code leaves out.
3. A query visits every list that can hold a vector within the angle of THRESHOLD: one that lies past the plane between its
   own list and another by no more than that angle allows. These probes are sufficient, not a number chosen beforehand.
4. In a list, distances from the query to the codes come from tables: the squared distance is that to the list's centre, less
   twice the query's products with the codewords (one table per query), plus a number that the code and its list fix. A code farther
   away than the threshold plus its own left-out length cannot be a match; all others get the exact cosine in double precision.
No step loses a pair, so recall is 1. The lists of a label are dealt to cells of about SLICE vectors, so that a query travels once to a
cell, not once to a list; a cell that one long list fills is cut into slices, each visited by its queries. A task holds one slice and
streams the queries past it; it returns counts and links that span components, never pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors with a null
label, link with nothing; vectors of different length never link; repeated rows are vectors of their own that share an id; a null
vec_id counts as another's link but has a null component.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.components import components
from lectern.llm.frames import pick
from lectern.session import fresh_path

THRESHOLD = 0.98
SAMPLE_FLOATS = 1 << 21
LISTS, CODES, SUBSPACE = 256, 256, 8
SLICE = 4096


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres from evenly spaced starts; an empty centre keeps its place."""
    k = max(1, min(k, len(x)))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([np.argmax(x[i:i + 2048] @ centres.T - half, axis=1) for i in range(0, max(len(x), 1), 2048)])


class Index:
    """Coarse centres and residual codebooks."""

    def __init__(self, sample: np.ndarray, dims: int):
        self.dims = dims
        self.cuts = list(range(0, dims, SUBSPACE)) + [dims]
        self.centres = kmeans(sample, min(LISTS, max(1, len(sample) // 32)))
        rest = sample - self.centres[nearest(sample, self.centres)]
        self.books = [kmeans(rest[:, a:b], min(CODES, max(1, len(sample) // 8))) for a, b in zip(self.cuts, self.cuts[1:])]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes, and the lengths of what the codes leave out."""
        own = nearest(x, self.centres)
        rest = x - self.centres[own]
        codes = np.column_stack([nearest(rest[:, a:b], book) for (a, b), book in zip(zip(self.cuts, self.cuts[1:]), self.books)]).astype(np.uint8)
        left = np.column_stack([rest[:, a:b] - book[codes[:, m]] for m, ((a, b), book) in enumerate(zip(zip(self.cuts, self.cuts[1:]), self.books))])
        return own, codes, np.sqrt((left * left).sum(1))

    def probes(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """For each vector, whether each list can hold one within the threshold's angle."""
        dot, square = x @ self.centres.T, (self.centres * self.centres).sum(1)
        gap = np.sqrt(np.maximum(0, square[own][:, None] + square[None] - 2 * (self.centres[own] @ self.centres.T)))
        cosine = np.clip((dot - dot[np.arange(len(x)), own][:, None]) / np.maximum(gap, 1e-300), -1, 1)
        angle = np.maximum(0, np.arccos(cosine) - np.arccos(THRESHOLD))
        return (gap * np.cos(angle) >= (square[None] - square[own][:, None]) / 2 - 1e-9) | (np.arange(len(self.centres)) == own[:, None])

    def tables(self, x: np.ndarray) -> list[np.ndarray]:
        """Products of each query with the codewords, by subspace."""
        return [x[:, a:b] @ book.T for (a, b), book in zip(zip(self.cuts, self.cuts[1:]), self.books)]

    def fixed_part(self, places: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """|code|^2 + 2 centre . code of each member."""
        total = np.zeros(len(codes))
        for m, ((a, b), book) in enumerate(zip(zip(self.cuts, self.cuts[1:]), self.books)):
            word = book[codes[:, m]]
            total += (word * word).sum(1) + 2 * (self.centres[places, a:b] * word).sum(1)
        return total


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors of double precision, filled with zeros up to dims."""
    counts = np.asarray(column.value_lengths())
    out = np.zeros((len(column), dims))
    out[np.repeat(np.arange(len(column)), counts), np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = np.asarray(column.flatten())
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def _index_task(index: Index):
    """(label, size, h1, h2, rep, times, embedding) to (label, size, place, probes, h1, ..., vector, code, left)."""
    def task(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                x = _vectors(part.column(6), index.dims)
                own, codes, left = index.encode(x)
                probes = index.probes(x, own)
                lists = [np.flatnonzero(p).astype(np.int32) for p in probes]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(own.astype(np.int32)), pa.array(lists, pa.list_(pa.int32())), *part.columns[2:6],
                     pa.array(list(x), pa.list_(pa.float64())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left)],
                    names=["label", "size", "place", "probes", "h1", "h2", "rep", "times", "vector", "code", "left"])
    return task


class _Slice:
    """The members of one slice, by list, and what has been linked among them."""

    def __init__(self, index: Index, table: pa.Table):
        self.index = index
        self.h1, self.h2, self.times = (np.asarray(table.column(c)) for c in ("h1", "h2", "times"))
        self.reps, self.left = table.column("rep").to_pylist(), np.asarray(table.column("left"))
        self.x = np.asarray(table.column("vector").combine_chunks().flatten()).reshape(-1, index.dims)
        self.codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(self.h1), -1)
        places = np.asarray(table.column("place"))
        self.fixed = index.fixed_part(places, self.codes)
        self.by_place = {int(p): np.flatnonzero(places == p) for p in np.unique(places)}
        self.parent = list(range(len(self.h1)))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def ask(self, part: pa.RecordBatch) -> list[tuple]:
        """Queries met with the members of the lists they visit: rows (h1, h2, links, a, b)."""
        names = part.schema.names
        column = lambda c: part.column(names.index(c))
        x = np.asarray(column("vector").flatten()).reshape(-1, self.index.dims)
        h1, h2, reps = np.asarray(column("h1")), np.asarray(column("h2")), column("rep").to_pylist()
        probes = column("probes")
        query, place = np.repeat(np.arange(len(x)), np.asarray(probes.value_lengths())), np.asarray(probes.flatten())
        tables, links, met = self.index.tables(x), np.zeros(len(x), np.int64), [-1] * len(x)
        limit, out = np.sqrt(2 - 2 * THRESHOLD), []
        order = np.argsort(place, kind="stable")
        query, place = query[order], place[order]
        for p, rows in self.by_place.items():
            own = query[np.searchsorted(place, p):np.searchsorted(place, p, "right")]
            away = x[own] - self.index.centres[p]
            base = (away * away).sum(1)
            step = max(1, (1 << 20) // len(rows))
            for lo in range(0, len(own), step):
                q = own[lo:lo + step]
                far = base[lo:lo + step, None] + self.fixed[rows][None] - 2 * sum(t[q][:, self.codes[rows, m]] for m, t in enumerate(tables))
                i, j = np.nonzero(np.sqrt(np.maximum(far, 0)) <= limit + self.left[rows][None] + 1e-7)
                i, j = q[i], rows[j]
                sure = np.concatenate([np.einsum("ij,ij->i", x[i[a:a + 65536]], self.x[j[a:a + 65536]]) for a in range(0, max(1, len(i)), 65536)]) >= THRESHOLD
                other = (h1[i] != self.h1[j]) | (h2[i] != self.h2[j])
                i, j = i[sure & other], j[sure & other]
                np.add.at(links, i, self.times[j])
                for a, b in zip(i.tolist(), j.tolist()):
                    if met[a] < 0:
                        met[a] = b
                        out.append((None, None, None, reps[a], self.reps[b]))
                    c, d = self.find(met[a]), self.find(b)
                    if c != d:
                        self.parent[max(c, d)] = min(c, d)
                        out.append((None, None, None, self.reps[c], self.reps[d]))
        return out + [(int(h1[i]), int(h2[i]), int(links[i]), None, None) for i in np.flatnonzero(links)]


def _search_task(index: Index):
    """Rows sorted by label, size, cell, slice and role (members first) to (h1, h2, links, a, b): link counts, and spanning links."""
    def runs(batch):
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(5))))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield keys[lo][:4], keys[lo][4], batch.slice(lo, hi - lo)

    def task(batches):
        key, rows, held = None, [], None
        for batch in batches:
            for k, role, part in runs(batch):
                if k != key:
                    key, rows, held = k, [], None
                if role == 0:
                    rows.append(part)
                    continue
                if held is None and rows:
                    held, rows = _Slice(index, pa.Table.from_batches(rows)), []
                if held is None:  # a slice may be empty
                    continue
                for lo in range(0, part.num_rows, 1024):
                    found = held.ask(part.slice(lo, 1024))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["h1", "h2", "links", "a", "b"])
    return task


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding, label)."""
    spark, path = vectors.sparkSession, fresh_path(vectors.sparkSession, "pq")
    rows = pick(vectors, "vec_id", "embedding", "label").select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
                                                               F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0)
    rows = (rows.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn("size", F.size("embedding"))
            .withColumn("h1", F.xxhash64("label", "embedding")).withColumn("h2", F.xxhash64(F.lit(5), "embedding", F.lit(6))))
    keys = ["label", "size", "h1", "h2"]
    classes = rows.filter("usable").groupBy(*keys).agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"), F.first("embedding").alias("embedding"))
    classes.write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    dims = classes.agg(F.max("size")).first()[0]
    if dims is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    sample = classes.orderBy(F.xxhash64("h1", F.lit(3)), *keys).select("embedding").limit(max(1, SAMPLE_FLOATS // dims)).toArrow()
    index = Index(_vectors(sample.column(0).combine_chunks(), dims), dims)
    (classes.select(*keys, "rep", "times", "embedding")
     .mapInArrow(_index_task(index), "label int, size int, place int, probes array<int>, h1 bigint, h2 bigint, rep bigint, times bigint, "
                                     "vector array<double>, code binary, left double").write.parquet(f"{path}/index"))
    indexed = spark.read.parquet(f"{path}/index")
    spot = ["label", "size", "cell"]
    cells = indexed.groupBy("label", "size").agg(F.least(F.lit(len(index.centres)), F.ceil(F.count("*") / SLICE)).cast("int").alias("cells"))
    dealt = indexed.join(cells, ["label", "size"]).withColumn("cell", F.col("place") % F.col("cells"))
    slices = dealt.groupBy(*spot).agg(F.ceil(F.count("*") / SLICE).alias("slices"))
    names = [*spot, "slice", "role", "h1", "h2", "rep", "times", "place", "probes", "vector", "code", "left"]
    held = (dealt.join(slices, spot).withColumn("slice", F.pmod("h1", F.col("slices"))).withColumn("role", F.lit(0))
            .withColumn("probes", F.lit(None).cast("array<int>")).select(*names))
    asked = (dealt.withColumn("cell", F.explode(F.array_distinct(F.transform("probes", lambda p: p % F.col("cells"))))).join(slices, spot)
             .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))).withColumn("role", F.lit(1))
             .withColumn("code", F.lit(None).cast("binary")).withColumn("left", F.lit(None).cast("double")).select(*names))
    (held.union(asked).repartition(*spot, "slice").sortWithinPartitions(*spot, "slice", "role", "h1", "h2")
     .mapInArrow(_search_task(index), "h1 bigint, h2 bigint, links bigint, a bigint, b bigint").write.parquet(f"{path}/found"))
    found = spark.read.parquet(f"{path}/found")
    counts = found.filter("links IS NOT NULL").groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    joined = components(found.filter("links IS NULL").select("a", "b"))
    known = (classes.join(counts, ["h1", "h2"], "left").join(joined, F.col("rep") == F.col("id"), "left")
             .select(*keys, (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    linked = rows.filter("usable").join(known, keys).select("vec_id", "n_links", F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"))
    alone = rows.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
