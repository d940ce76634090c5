"""Toxicity through a noisy channel: obfuscated words are restored first, then the restored text is scored.

Channel: writers replace letters by look-alikes (LOOKALIKES), put blanks or marks between letters, and repeat letters. Only spans
that can be read in more than one way have a lattice (a token that mixes letters and look-alikes, three or more single
characters in a row, a letter three times in a row); every other token has one reading and stays. The Viterbi path of a lattice
maximises the character trigram model's probability times the channel's.

Language model: trigram counts of all texts in a fixed alphabet of 64 symbols, so 262,144 counters whatever the corpus; tasks add up
their own first, and sums are made on the executors.

Classifier: fitted on at most TRAIN_ROWS labelled documents (those of the smallest key; a parameter). Words and word beginnings weigh
as much as their counts in toxic documents are beyond chance (root of the likelihood ratio). A logistic regression is fitted to the presence of
the TOP weightiest ones and to the summed weight of all others, for which each training document is weighed without itself.

Defined results: null and empty texts get the score of a text without evidence; rows are scored one by one, repeated ones alike; a
null label teaches nothing, and of several labels of one document the highest counts; without labels of both kinds every score is 0.
"""
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.frames import pick
from lectern.llm.memory import give_back, tidy
from lectern.session import fresh_path

TRAIN_ROWS = 20_000
MIN_DOCS = 3
MIN_WEIGHT, TOP_WEIGHT, TOP = 3.0, 4.5, 256
#: What a look-alike may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "gq", "@": "a", "$": "s",
              "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou"}
SUBSTITUTED, JOINED, SHORTENED = 2.0, 0.5, 0.5  # costs in nats
BREAK, OTHER, DIGIT = 0, 58, 59
CHUNK = 1 << 10
AT_ONCE = 500  # rows of a batch that are Python strings at one time

_MARKS = re.escape("".join(LOOKALIKES))
_LETTER = r"[^\W\d_]"
_ONE = rf"(?:{_LETTER}|[{_MARKS}])"
AMBIGUOUS = re.compile(
    rf"(?<![\w{_MARKS}]){_ONE}(?:[ ._\-]{_ONE}(?![\w{_MARKS}])){{2,}}"  # single characters in a row
    rf"|(?<![\w{_MARKS}])(?=[\w{_MARKS}]*{_LETTER})(?=[\w]*[{_MARKS}])[\w{_MARKS}]+"  # letters and look-alikes in one token
    rf"|(?<![\w{_MARKS}])(?={_LETTER}*({_LETTER})\1\1){_LETTER}+")  # a letter three times
WORDS = re.compile(rf"{_LETTER}+")
# Every ambiguous span lies in one line and holds a mark, three equal characters, or single characters side by side.
_HAS_MARK, _HAS_TRIPLE = re.compile(f"[{_MARKS}]"), re.compile(r"(\S)\1\1")
_HAS_SINGLES = re.compile(r"(?:\A|[\W_])\S[ ._\-]\S[ ._\-]\S(?![^\W_])")


def _alphabet() -> np.ndarray:
    """Symbol of each Latin-1 code point, in lower case."""
    table = np.zeros(256, np.uint8)
    for code in range(256):
        c = chr(code).lower()
        if "a" <= c <= "z":
            table[code] = ord(c) - 96
        elif c.isdigit() and code < 128:
            table[code] = DIGIT
        elif c.isalpha():
            table[code] = 27 + (ord(c) - 0xDF) % 31 if len(c) == 1 and ord(c) >= 0xDF else OTHER
    return table


ALPHABET = _alphabet()
SYMBOL = {chr(code): int(symbol) for code, symbol in enumerate(ALPHABET)}


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 256, ALPHABET[np.minimum(codes, 255)], np.uint8(OTHER))


def strings(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, AT_ONCE rows in memory at a time."""
    for lo in range(0, len(column), AT_ONCE):
        yield from column.slice(lo, AT_ONCE).to_pylist()


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of symbol triples in all texts; 256 rows of 1,024 sums reach the driver."""
    def count(batches):
        total = np.zeros(1 << 18, np.int64)

        def add_texts(texts):
            s = symbols("\n\n" + "\n\n".join(texts) + "\n\n").astype(np.int32)
            np.add(total, np.bincount(s[:-2] * 4096 + s[1:-1] * 64 + s[2:], minlength=1 << 18), out=total)

        for b in batches:
            texts, size = [], 0
            for t in filter(None, strings(b.column(0))):
                texts.append(t)
                size += len(t)
                if size >= 250_000:
                    add_texts(texts)
                    texts, size = [], 0
            if texts:
                add_texts(texts)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total) // CHUNK)), pa.array([x.tobytes() for x in total.reshape(-1, CHUNK)], pa.binary())],
                                         names=["chunk", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, counts in zip(b.column(0).to_pylist(), b.column(1)):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk bigint, counts binary"
    total = np.zeros(1 << 18, np.int64)
    for chunk, counts in pick(docs, "text").mapInArrow(tidy(count), schema).repartition(F.col("chunk")).mapInArrow(tidy(add), schema).collect():
        total[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(counts, np.int64)
    return total.reshape(64, 64, 64)


def costs_of(counts: np.ndarray) -> np.ndarray:
    """-log P(third | first two), trigrams interpolated with bigrams and single symbols."""
    one = counts.sum((0, 1)) + 1.0
    two = counts.sum(0).astype(float)
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (counts + 5 * p2[None]) / (counts.sum(2, keepdims=True) + 5)
    return -np.log(0.9 * p3 + 0.08 * p2[None] + 0.02 * p1).astype(np.float32)


class Restorer:
    """Reads texts through the channel. `costs` is the language model; readings of spans are remembered, up to a fixed number."""

    REMEMBER = 100_000

    def __init__(self, costs: np.ndarray):
        self.costs, self.known = costs, {}

    def __call__(self, text: str) -> str:
        text = text.lower()
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        triples = bool(((codes[:-2] == codes[1:-1]) & (codes[1:-1] == codes[2:])).any())
        return "\n".join(AMBIGUOUS.sub(self._read, line) if _HAS_MARK.search(line) or _HAS_SINGLES.search(line) or triples and _HAS_TRIPLE.search(line) else line
                         for line in text.split("\n"))

    def _read(self, match: re.Match) -> str:
        span = match.group()
        if span not in self.known:
            if len(self.known) >= self.REMEMBER:
                self.known.clear()
            self.known[span] = self.decode(span)
        return self.known[span]

    @staticmethod
    def lattice(span: str) -> list[list[tuple[str, float]]]:
        """For each unit of the span its readings and their channel costs. A unit is a run of one character, or a separator."""
        loose = len(span) > 1 and all(c in " ._-" for c in span[1::2])
        units = []
        for run in re.finditer(r"(.)\1*", span, re.S):
            c, n = run[1], len(run[0])
            if c in " ._-":
                units.append([(run[0], 0.0)] + ([("", JOINED)] if loose else []))
                continue
            readings = [(c, 0.0)] + [(x, SUBSTITUTED) for x in LOOKALIKES.get(c, "")]
            if n == 1:
                units.append(readings)
            else:
                units.append([(x * n, k * n) for x, k in readings] + [(x * m, k + SHORTENED) for x, k in readings for m in (1, 2) if m < n])
        return units

    def decode(self, span: str) -> str:
        costs = self.costs
        paths = {(BREAK, BREAK): (0.0, None)}
        for unit in self.lattice(span):
            readings = [(r, k, [SYMBOL.get(c, OTHER) for c in r]) for r, k in unit]
            after: dict = {}
            for (a, b), (cost, path) in paths.items():
                for reading, k, codes in readings:
                    x, y, total = a, b, cost + k
                    for c in codes:
                        total += float(costs[x, y, c])
                        x, y = y, c
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, (path, reading))
            paths = after
        _, path = min(((cost + float(costs[a, b, BREAK]), path) for (a, b), (cost, path) in paths.items()), key=lambda x: x[0])
        parts = []
        while path:
            path, reading = path
            parts.append(reading)
        return "".join(reversed(parts))


def features(restored: str) -> set[str]:
    """Whole words (marked by a closing blank) and the first 4, 5 and 6 letters of words."""
    words = set(WORDS.findall(restored))
    return {w + " " for w in words} | {w[:n] for w in words for n in (4, 5, 6) if len(w) >= n}


def weight(pos: int, neg: int, all_pos: int, all_neg: int) -> float:
    """Root of the likelihood ratio of pos among pos + neg against the share of toxic documents; 0 if it isn't above that."""
    n, share = pos + neg, all_pos / max(1, all_pos + all_neg)
    if not n or not 0 < share < 1 or pos / n <= share:
        return 0.0
    return math.sqrt(2 * sum(k * math.log(k / (n * p)) for k, p in ((pos, share), (neg, 1 - share)) if k))


class Evidence:
    """What a text's features say: the numbers of the top features in it, and the (log of the) summed weight of others."""

    def __init__(self, counts: dict[str, tuple[int, int]], all_pos: int, all_neg: int):
        weights = {f: weight(pos, neg, all_pos, all_neg) for f, (pos, neg) in counts.items()}
        top = sorted((f for f, w in weights.items() if w >= TOP_WEIGHT), key=lambda f: (-weights[f], f))[:TOP]
        self.top = {f: i for i, f in enumerate(top)}
        self.others = {f: counts[f] for f, w in weights.items() if f not in self.top and w >= 0.8 * MIN_WEIGHT}
        self.known = frozenset(self.top) | frozenset(self.others)
        self.all_pos, self.all_neg = all_pos, all_neg

    def __call__(self, found: set[str], own: int | None = None) -> tuple[list[int], float]:
        """own: the label of a training document, which is then left out of the counts."""
        pos, neg = (0, 0) if own is None else (own, 1 - own)
        found = self.known & found
        heavy = [w for f in found if f in self.others
                 if (w := weight(self.others[f][0] - pos, self.others[f][1] - neg, self.all_pos - pos, self.all_neg - neg)) >= MIN_WEIGHT]
        return [self.top[f] for f in found if f in self.top], math.log1p(sum(heavy))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights (constant first) by Newton's method with a ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [0.3] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple:
    """(language model costs, evidence, logistic weights: constant, others' weight, top features; or None). Labels of held-out
    documents are not read."""
    spark = docs.sparkSession
    costs = costs_of(trigram_counts(docs))
    chosen = (pick(labels, "doc_id", "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(train_rows))
    path = fresh_path(spark, "toxicity-train")

    def restored(batches):
        read = Restorer(costs)
        for b in batches:
            for lo in range(0, b.num_rows, AT_ONCE):
                part = b.slice(lo, AT_ONCE)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([read(t or "") for t in part.column(1).to_pylist()])],
                                                 names=["toxic", "text"])

    (pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
     .select((F.col("toxic") > 0).cast("int").alias("toxic"), "text").mapInArrow(tidy(restored), "toxic int, text string").write.parquet(path))
    train = spark.read.parquet(path)

    def counted(wanted):
        def task(batches):
            total: Counter = Counter()
            for b in batches:
                for t in strings(b.column(0)):
                    found = features(t)
                    total.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], names=["f", "n"])
        return task

    def counts(kind: int, wanted, least: int) -> dict[str, int]:
        rows = train.filter(F.col("toxic") == kind).select("text").mapInArrow(tidy(counted(wanted)), "f string, n bigint")
        return dict(map(tuple, rows.groupBy("f").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).collect()))

    totals = dict(map(tuple, train.groupBy("toxic").count().collect()))
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not (pos and neg):
        return costs, None, None
    toxic = counts(1, None, min(MIN_DOCS, max(1, pos // 10)))
    clean = counts(0, set(toxic), 1)
    evidence = Evidence({f: (n, clean.get(f, 0)) for f, n in toxic.items()}, pos, neg)

    def measured(batches):
        for b in batches:
            kinds = b.column(0).to_pylist()
            seen = [evidence(features(t), k) for t, k in zip(strings(b.column(1)), kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s[0] for s in seen], pa.list_(pa.int32())), pa.array([s[1] for s in seen], pa.float64())],
                                             names=["toxic", "top", "others"])

    points = train.mapInArrow(tidy(measured), "toxic int, top array<int>, others double").collect()
    x = np.zeros((len(points), 1 + len(evidence.top)))
    for i, p in enumerate(points):
        x[i, 0] = p.others
        x[i, [1 + t for t in p.top]] = 1
    return costs, evidence, _logistic(x, np.array([p.toxic for p in points], float)).tolist()


def scorer(model: tuple) -> Callable[[Column | str], Column]:
    """A column function: text to the probability that it is toxic."""
    costs, evidence, weights = model

    def sums_of(texts: pa.Array) -> np.ndarray:
        read, sums = Restorer(costs), []
        for text in strings(texts):
            top, others = evidence(features(read(text))) if text else ([], 0.0)
            sums.append(weights[0] + weights[1] * others + sum(weights[2 + t] for t in sorted(top)))
        return np.array(sums, float)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if weights is None:
            return pa.array(np.zeros(len(texts)))
        sums = sums_of(texts)
        give_back()  # what was read and remembered is free by now
        return pa.array(1 / (1 + np.exp(-np.clip(sums, -700, 700))))

    return score
