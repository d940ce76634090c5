"""Words of many texts at once, as 64-bit hashes, straight from Arrow's UTF-8 buffers.

A text is never turned into Python strings: bytes are classed by a table, words are runs of word bytes, and a word's hash is a
multilinear sum of its bytes with fixed pseudorandom coefficients, mixed with its length. All separators in use are ASCII, so
a byte of 0x80 and above always belongs to a word and byte runs equal code point runs.
"""
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19  # bytes of text in work at once, some 36 times that in memory; a longer text is a block of its own


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(n: int, seed: int) -> np.ndarray:
    """The first n odd pseudorandom numbers of a seed."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def byte_class(separators: str) -> np.ndarray:
    """True for bytes that belong to words; separators are ASCII."""
    table = np.ones(256, bool)
    table[[ord(c) for c in separators]] = False
    return table


BLANK_SEPARATED = byte_class(" \t\n\x0b\x0c\r")
ALPHANUMERIC = byte_class("".join(chr(c) for c in range(128) if not (chr(c).isdigit() or "a" <= chr(c) <= "z")))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row bounds in bytes) of a string column, a bounded piece at a time; null reads as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if n and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def hash_words(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, A-Z lower-cased, and for each row the index of its first word (one more at the end)."""
    data = LOWER[data]
    inside = is_word[data]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    follows = np.empty_like(inside)  # a word byte before it in the same row
    follows[0] = False
    follows[1:] = inside[:-1]
    follows[bounds[:-1][bounds[:-1] < len(data)]] = False
    where = np.flatnonzero(inside)
    first = np.flatnonzero(~follows[where])
    starts = where[first]
    lengths = np.diff(np.append(first, len(where)))
    place = np.arange(len(where)) - np.repeat(first, lengths)
    products = (data[where].astype(np.uint64) + np.uint64(1)) * coefficients(int(lengths.max()), 1)[place]
    hashes = mixed(np.add.reduceat(products, first) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, bounds)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions have none."""
    n = max(0, len(hashes) - k + 1)
    total = np.full(n, k * 0xA0761D6478BD642F % (1 << 64), np.uint64)
    for j, c in enumerate(coefficients(k, 2)):
        total += hashes[j:j + n] * c
    return mixed(total)


def sequence_hash(hashes: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """One hash for each row's whole word sequence."""
    counts = np.diff(first)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        place = np.arange(len(hashes)) - np.repeat(first[:-1], counts)
        out[full] = np.add.reduceat(hashes * coefficients(int(counts.max()), seed)[place], first[:-1][full])
    return mixed(out + counts.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def pack_lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of the given counts over flat values."""
    bounds = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))
