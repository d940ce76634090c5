"""How far the sources of a language diverge in their words, by chunk factorization.

1. The blank-separated chunks of every document are counted in the task that reads it. What leaves the task is one row for each language
   and chunk of a block of documents, with a record for each source: occurrences, number of documents, the first and the last of them.
2. Rows meet by chunk. Each globally distinct chunk is tokenised once, and its records go on under each of its terms.
3. Rows meet by language and term. A term is kept if MIN_DOCS documents of the language hold it. Documents of a chunk add up, those of a term do
   not, since chunks of one document may share it. A (source, chunk) with MIN_DOCS documents decides for its terms; of all others the
   first and the last document are all there are, so distinct ones are counted. This is exact.
4. Smoothed shares p = 1 + floor(SCALE (count + 1) / (N + V)) of every group and language; divergence floor((p - q)^2 / q).
   Pairs of sources: dense blocks of terms by sources, a bucket of terms and two tiles of sources in a task; terms that neither tile holds are
   added as one product. Only sums leave a block.

A frequent chunk or term sends one row a block or chunk, and rows of one key are merged as they stream by, so memory is bounded by a block
of texts, a batch, a language's sources or a block of the matrix. Groups travel as 64-bit numbers that are checked to be distinct.
Arithmetic is in decimals and 64-bit integers, so it is exact.

Defined results: null text, lang and source read as ''; every row is a document of its own, repeated rows too; a group without terms still
takes part in pairs; a language without kept terms gives pairs of value 0; an empty table gives no rows; other columns are ignored.
"""
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.frames import pick
from lectern.session import fresh_path

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
BLOCK_BYTES = 1 << 24
BUCKET_TERMS = 1 << 13
TILE = 64
#: Bytes of terms: letters (A-Z lowered) and everything beyond ASCII; all others become blanks.
TERM_BYTES = np.array([b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
G, N, DOCS, FIRST, LAST = range(5)  # columns of a record


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most BLOCK_BYTES of text, or of one row."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    row, before = 0, 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right")))
        yield batch.slice(row, end - row)
        row, before = end, int(ends[end - 1])


def _changes(values: pa.Array) -> np.ndarray:
    """True where a value differs from the one before it; the first one does."""
    out = np.ones(len(values), bool)
    if len(values) > 1:
        out[1:] = pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
    return out


def _records(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All records of a binary column, and how many each row has."""
    bounds = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    flat = np.frombuffer(column.buffers()[2], np.int64, (bounds[-1] - bounds[0]) // 8, bounds[0])
    return flat.reshape(-1, 5), np.diff(bounds) // 40


def _binary(records: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Records as a binary column whose rows begin at starts."""
    bounds = (np.append(starts, len(records)) * 40).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(records))])


def _merged(records: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One record for each run and group; run numbers ascend. Documents of the records of a group are distinct."""
    order = np.lexsort((records[:, G], run))
    records, run = records[order], run[order]
    starts = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (records[1:, G] != records[:-1, G])))
    out = records[starts]
    for column, fold in ((N, np.add), (DOCS, np.add), (FIRST, np.minimum), (LAST, np.maximum)):
        out[:, column] = fold.reduceat(records[:, column], starts)
    return out, run[starts]


def _by_run(batches: Iterator[pa.RecordBatch], key: str, fold: Callable, squeeze: Callable) -> Iterator[pa.RecordBatch]:
    """fold over sorted rows, never cutting a run of equal keys; of an unfinished run only what squeeze makes of it is held."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            b = pa.RecordBatch.from_arrays([pa.concat_arrays([held.column(c), b.column(c)]) for c in b.schema.names], names=b.schema.names)
        last = int(np.flatnonzero(_changes(b.column(key)))[-1])
        if last:
            yield from fold(b.slice(0, last))
        held = squeeze(b.slice(last))
    if held is not None:
        yield from fold(held)


# -- 1: documents to chunks

def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _bounded(batch):
            lists = pc.ascii_split_whitespace(part.column("text").cast(pa.large_string()))
            coded = pc.list_flatten(lists).dictionary_encode()
            chunks, kinds = coded.dictionary, len(coded.dictionary)
            if not kinds:
                continue
            # Chunks of each document with their counts.
            pairs, n = np.unique(pc.list_parent_indices(lists).to_numpy().astype(np.int64) * kinds + coded.indices.to_numpy(), return_counts=True)
            doc, chunk = np.divmod(pairs, kinds)
            langs = part.column("lang").dictionary_encode()
            group_of, groups = pd.factorize(part.column("g").to_numpy())
            cell = langs.indices.to_numpy().astype(np.int64)[doc] * kinds + chunk
            # Documents ascend in a stable order, so the first and last of a run are the least and greatest.
            order = np.argsort(cell * len(groups) + group_of[doc], kind="stable")
            cell, doc = cell[order], doc[order]
            starts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (group_of[doc][1:] != group_of[doc][:-1])))
            ends = np.append(starts[1:], len(cell))
            keys = part.column("doc").to_numpy()
            records = np.stack([groups[group_of[doc[starts]]], np.add.reduceat(n[order], starts), ends - starts, keys[doc[starts]], keys[doc[ends - 1]]], axis=1)
            rows = np.flatnonzero(np.append(True, np.diff(cell[starts]) != 0))
            lang, chunk = np.divmod(cell[starts][rows], kinds)
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(lang)), chunks.take(pa.array(chunk)).cast(pa.string()), _binary(records, rows)],
                                             names=["lang", "chunk", "records"])


# -- 2: chunks to terms

def _chunk_runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that begin a (chunk, lang), the merged records, and the run of each."""
    new = _changes(batch.column("chunk")) | _changes(batch.column("lang"))
    records, sizes = _records(batch.column("records"))
    merged, run = _merged(records, np.repeat(np.cumsum(new) - 1, sizes))
    return np.flatnonzero(new), merged, np.flatnonzero(np.append(True, np.diff(run) != 0))


def _squeeze_chunk(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows, records, starts = _chunk_runs(batch)
    return pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(rows)), batch.column("chunk").take(pa.array(rows)), _binary(records, starts)],
                                      names=["lang", "chunk", "records"])


def terms_of(chunks: pa.Array) -> pa.Array:
    """The list of terms of each chunk; a chunk without terms, or with other bytes at its ends, may list empty ones."""
    bounds = np.frombuffer(chunks.buffers()[1], np.int32, len(chunks) + 1, chunks.offset * 4)
    data = TERM_BYTES[np.frombuffer(chunks.buffers()[2], np.uint8)[:bounds[-1]]]
    plain = pa.Array.from_buffers(pa.string(), len(chunks), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return pc.ascii_split_whitespace(plain)


def _tokenise(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    merged = _squeeze_chunk(batch)
    new = _changes(merged.column("chunk"))
    lists = terms_of(merged.column("chunk").take(pa.array(np.flatnonzero(new))))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    chunk_of = np.cumsum(new) - 1
    firsts = np.cumsum(counts) - counts
    sizes = counts[chunk_of]
    row = np.repeat(np.arange(merged.num_rows), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + firsts[chunk_of[row]]
    terms = pc.list_flatten(lists).take(pa.array(place))
    full = np.flatnonzero(pc.binary_length(terms).to_numpy(zero_copy_only=False) > 0)
    row = pa.array(row[full])
    yield pa.RecordBatch.from_arrays([merged.column("lang").take(row), terms.take(pa.array(full)), merged.column("records").take(row)], names=["lang", "term", "records"])


# -- 3: terms to kept terms

def _term_runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that begin a (term, lang), all records and the run of each."""
    new = _changes(batch.column("term")) | _changes(batch.column("lang"))
    records, sizes = _records(batch.column("records"))
    return np.flatnonzero(new), records, np.repeat(np.cumsum(new) - 1, sizes)


def _witnesses(records: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, document) of all distinct documents that records name."""
    docs, runs = np.concatenate([records[:, FIRST], records[:, LAST]]), np.concatenate([run, run])
    order = np.lexsort((docs, runs))
    docs, runs = docs[order], runs[order]
    new = np.append(True, (docs[1:] != docs[:-1]) | (runs[1:] != runs[:-1]))
    return runs[new], docs[new]


def _squeeze_term(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Records merged by group, and what the decision needs as records without occurrences: MIN_DOCS documents at most, or a record that decides."""
    rows, records, run = _term_runs(batch)
    counts, of = _merged(records, run)
    counts[:, DOCS] = 0
    counts[:, LAST] = counts[:, FIRST]  # one of the documents named
    runs, docs = _witnesses(records, run)
    rank = np.arange(len(runs)) - np.searchsorted(runs, runs)
    runs, docs = runs[rank < MIN_DOCS], docs[rank < MIN_DOCS]
    most = np.zeros(len(rows), np.int64)
    np.maximum.at(most, run, records[:, DOCS])
    extra = np.stack([np.full(len(runs), records[0, G]), np.zeros(len(runs), np.int64), most[runs], docs, docs], axis=1)
    both, of = np.concatenate([counts, extra]), np.concatenate([of, runs])
    order = np.argsort(of, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(of[order]) != 0))
    return pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(rows)), batch.column("term").take(pa.array(rows)), _binary(both[order], starts)],
                                      names=["lang", "term", "records"])


def _keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows, records, run = _term_runs(batch)
    named = np.bincount(_witnesses(records, run)[0], minlength=len(rows))
    most = np.zeros(len(rows), np.int64)
    np.maximum.at(most, run, records[:, DOCS])
    kept = (most >= MIN_DOCS) | (named >= MIN_DOCS)
    mine = kept[run] & (records[:, N] > 0)
    if not mine.any():
        return
    merged, of = _merged(records[mine], run[mine])
    starts = np.flatnonzero(np.append(True, np.diff(of) != 0))
    rows = pa.array(rows[of[starts]])
    bounds = pa.array(np.append(starts, len(of)).astype(np.int32))
    yield pa.RecordBatch.from_arrays([batch.column("lang").take(rows), batch.column("term").take(rows), pa.array(np.add.reduceat(merged[:, N], starts)),
                                      pa.ListArray.from_arrays(bounds, pa.array(merged[:, G])), pa.ListArray.from_arrays(bounds, pa.array(merged[:, N]))],
                                     names=["lang", "term", "lang_n", "g", "n"])


def read_groups(docs: DataFrame) -> DataFrame:
    """(lang, source, text) without nulls."""
    return pick(docs, "lang", "source", "text").select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def numbered_groups(docs: DataFrame, path: str) -> tuple[DataFrame, int]:
    """(lang, source, g), staged, and the seed of g = xxhash64(seed, lang, source), the first one that gives every group a number of its own."""
    read_groups(docs).select("lang", "source").distinct().write.parquet(path)
    groups, seed = docs.sparkSession.read.parquet(path), 0
    while True:
        named = groups.withColumn("g", F.xxhash64(F.lit(seed), "lang", "source"))
        if named.groupBy("g").count().filter("count > 1").isEmpty():
            return named, seed
        seed += 1


def kept_terms(docs: DataFrame, seed: int, path: str) -> DataFrame:
    """(lang, term, lang_n, g, n) of the kept terms, staged: occurrences in the language, and in each group that has any."""
    rows = read_groups(docs).select(F.monotonically_increasing_id().alias("doc"), "lang", F.xxhash64(F.lit(seed), "lang", "source").alias("g"), "text")
    chunks = rows.mapInArrow(_count_chunks, "lang string, chunk string, records binary").filter("chunk <> ''")
    terms = (chunks.repartition("chunk").sortWithinPartitions("chunk", "lang")
             .mapInArrow(lambda it: _by_run(it, "chunk", _tokenise, _squeeze_chunk), "lang string, term string, records binary"))
    (terms.repartition("lang", "term").sortWithinPartitions("term", "lang")
     .mapInArrow(lambda it: _by_run(it, "term", _keep, _squeeze_term), "lang string, term string, lang_n bigint, g array<bigint>, n array<bigint>").write.parquet(path))
    return docs.sparkSession.read.parquet(path)


# -- 4: shares and divergence

def share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE (n + 1) / (total + kinds)); 1 where there are no terms at all."""
    wide = lambda c: c.cast("decimal(20,0)")
    part = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 1), F.nullif(wide(total + kinds), F.lit(0).cast("decimal(20,0)")))
    return F.lit(1).cast("bigint") + F.coalesce(part.cast("bigint"), F.lit(0).cast("bigint"))


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _pair_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over one bucket's terms, less what the pair has for a term that it lacks."""
    lang, _, i, j = key
    marks = rows[rows["term"] < 0].sort_values("no")
    numbers, names, base = marks["no"].to_numpy(), marks["g"].to_numpy(), marks["p"].to_numpy(np.int64)
    held = rows[rows["term"] >= 0]
    codes, terms = pd.factorize(held["term"].to_numpy())
    matrix = np.repeat(base[:, None], len(terms), axis=1)
    matrix[np.searchsorted(numbers, held["no"].to_numpy()), codes] = held["p"].to_numpy(np.int64)
    out = []
    for s in range(len(numbers)):
        other = np.flatnonzero((numbers // TILE != numbers[s] // TILE) if i != j else (numbers != numbers[s]))
        gap = matrix[s] - matrix[other]
        plain = (base[s] - base[other]) ** 2 // base[other]
        out.append(np.stack([np.full(len(other), names[s]), names[other], (gap * gap // matrix[other]).sum(axis=1) - plain * len(terms), plain], axis=1))
    return pd.DataFrame(np.concatenate(out), columns=["g", "other", "sum", "plain"])


def source_pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of sources of a language.
    rows: (lang, term, g, no, p, sources, kinds), term a number; groups: (lang, source, g, no, p, sources, kinds), p the share of a term that the group lacks."""
    buckets = F.expr(f"kinds div {BUCKET_TERMS} + 1")
    tiles = F.expr(f"sequence(0, (sources - 1) div {TILE})")

    def dealt(df: DataFrame) -> DataFrame:
        own = F.expr(f"no div {TILE}")
        return (df.withColumn("_tile", F.explode(tiles))
                .select("lang", "bucket", F.least(own, F.col("_tile")).alias("i"), F.greatest(own, F.col("_tile")).alias("j"), "term", "g", "no", "p"))

    marks = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), buckets - 1))).withColumn("term", F.lit(-1).cast("bigint"))
    sums = (dealt(marks).unionByName(dealt(rows.withColumn("bucket", F.pmod(F.xxhash64("term"), buckets)))).groupBy("lang", "bucket", "i", "j")
            .applyInPandas(_pair_sums, "g bigint, other bigint, sum bigint, plain bigint"))
    return (sums.groupBy("g", "other").agg(F.sum("sum").alias("sum"), F.max("plain").alias("plain"))
            .join(groups.select("g", "lang", "source", "kinds"), "g").join(groups.select(F.col("g").alias("other"), F.col("source").alias("item")), "other")
            .select("lang", "source", "item", (F.col("sum") + F.col("plain") * F.col("kinds")).alias("value")))


def ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return df.withColumn("rank", F.row_number().over(order))


def source_audit(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair`, all other sources of the language; part `term`, the `top` terms that a source overuses."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "source-audit")
    named, seed = numbered_groups(docs, f"{path}/names")
    kept = kept_terms(docs, seed, f"{path}/kept")
    numbered = kept.withColumn("number", F.monotonically_increasing_id())
    counts = numbered.select("lang", "number", "term", "lang_n", F.inline(F.arrays_zip("g", "n")))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("kinds"))
    by_source = Window.partitionBy("lang").orderBy("source")
    (named.join(counts.groupBy("g").agg(F.sum("n").alias("total")), "g", "left").join(langs, "lang", "left").na.fill(0)
     .withColumn("no", (F.row_number().over(by_source) - 1).cast("bigint")).withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
     .write.parquet(f"{path}/groups"))
    groups = spark.read.parquet(f"{path}/groups")
    p = share(F.col("n"), F.col("total"), F.col("kinds"))
    pairs = source_pairs(counts.select(F.col("number").alias("term"), "g", "n").join(groups.drop("source"), "g").withColumn("p", p),
                         groups.withColumn("p", share(F.lit(0), F.col("total"), F.col("kinds"))))
    terms = (counts.select("g", F.col("term").alias("item"), "n", "lang_n").join(groups.select("g", "lang", "source", "total", "lang_total", "kinds"), "g")
             .select("lang", "source", "item", p.alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("kinds")).alias("q"))
             .filter("p > q").select("lang", "source", "item", divergence("p", "q").alias("value")))
    out = ["lang", "source", "part", "item", "value", "rank"]
    return (ranked(pairs).withColumn("part", F.lit("pair")).select(out)
            .union(ranked(terms).filter(F.col("rank") <= top).withColumn("part", F.lit("term")).select(out)))
