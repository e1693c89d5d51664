"""Words of a whole Arrow column of texts, found and hashed by array operations on its UTF-8 bytes.

Every character that parts words is ASCII, so it never occurs inside another character's bytes, and A-Z are put in lower
case byte by byte. Nothing is done word by word, but for words of more than ``LONG`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = (0x20, *range(0x09, 0x0E))
LONG = 64
#: Bytes that are hashed at a time.
BLOCK = 1 << 20

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_tables: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int) -> np.ndarray:
    """base to the powers 0 to ``BLOCK + LONG``, modulo 2**64."""
    if base not in _tables:
        p = np.ones(1, np.uint64)
        while len(p) <= BLOCK + LONG:
            p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
        _tables[base] = p
    return _tables[base]


def own_bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text begins and the last ends; null is empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    _, begins, data = texts.buffers()
    at = np.frombuffer(begins, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``own_bytes_of``, with A-Z in lower case."""
    data, at = own_bytes_of(column)
    return _LOWER[data], at


def table_of(codes: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


def find_words(data: np.ndarray, at: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (and one past the last).

    ``parts`` says for each byte whether it parts words; the ends of texts always do.
    """
    inside = ~parts[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word: a polynomial of its bytes, mixed; words of more than ``LONG`` bytes by XXH64."""
    from xxhash import xxh64_intdigest

    out = np.empty(len(starts), np.uint64)
    up, down = _powers(_BASE), _powers(_INVERSE)
    a = 0
    while a < len(starts):
        low = starts[a]
        b = int(np.searchsorted(starts, low + BLOCK))
        part = _BYTE_VALUES[data[low : min(low + BLOCK + LONG, ends[b - 1])]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        s = starts[a:b] - low
        e = np.minimum(ends[a:b] - low, s + LONG)
        out[a:b] = (sums[e] - sums[s]) * down[s]
        a = b
    out = mixed(out)
    for i in np.flatnonzero(ends - starts > LONG):
        out[i] = xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 7)
    return out


def hash_shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of the text and a 64-bit hash for every run of ``size`` words; of a shorter text the whole, if not empty.

    Hashes come text by text, in the order of the words.
    """
    counts = np.diff(first)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), shingles)
    begin = np.concatenate([[0], np.cumsum(shingles)])
    at = first[:-1][text] + np.arange(len(text)) - begin[text]
    length = np.minimum(counts, size)[text]
    out = length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    for k in range(size):
        has = length > k
        factor = np.uint64(pow(0xE7037ED1A0B428DB, k + 1, 1 << 64))
        if has.all():
            out += words[at + k] * factor
        else:
            out[has] += words[at[has] + k] * factor
    return text, mixed(out)


def in_pieces(batches: Iterator[pa.RecordBatch], most: int, text: int = 0) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text; a longer text stays whole, alone."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64())).to_numpy()
        a = 0
        while a < batch.num_rows:
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(a, b - a)
            a = b


def hash_column(column: pa.Array) -> np.ndarray:
    """64 bits for each string, as of one word each."""
    data, at = bytes_of(column)
    return hash_words(data, at[:-1], at[1:])


def as_words(data: np.ndarray, parts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words that ``find_words`` has found, as an Arrow column."""
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(data[~parts[data]]))


def cut_at(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The parts of the bytes that begin at the given places, the first at 0, as an Arrow column; no part is empty."""
    at = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data)))


def gathered(values: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values, ``sizes`` long and one after the other, in the order ``which``; and where each begins (and the last ends)."""
    begins = np.cumsum(sizes) - sizes
    many = sizes[which]
    at = np.concatenate([[0], np.cumsum(many)])
    return values[np.arange(at[-1]) + np.repeat(begins[which] - at[:-1], many)], at
