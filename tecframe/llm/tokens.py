"""Vectorised tokens of Arrow text columns: word hashes, shingles, sets.

Everything works on pieces of about a megabyte, so that the memory of a task
follows the piece (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15)) | U64(1)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# for comparisons that overlook punctuation: ASCII letters, digits and all bytes of other letters make words
MARKS = np.ones(256, bool)
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"): ord("Z") + 1] += 32
BYTES = stream(256, 11)[FOLD]
RAW = stream(256, 11)
BASE = 0x9E3779B97F4A7C15
MULTIPLIERS = stream(64, 77)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n, kept between pieces of usual size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE * 5 // 4)
        have = np.full(size, base % 2**64, U64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 2 * PIECE:
            _powers[base] = have
    return have[:n]


INVERSE = pow(BASE, -1, 2**64)


def prefix_sums(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """s with s[b] - s[a] the polynomial hash of data[a:b], times BASE ** a."""
    s = np.zeros(len(data) + 1, U64)
    np.cumsum(table[data] * powers(len(data), BASE), out=s[1:])
    return s


def span_hash(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((s[ends] - s[starts]) * powers(len(s), INVERSE)[starts])


class Texts:
    """Texts of one piece as bytes with offsets; null is the empty text."""

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        if column.null_count:
            column = column.fill_null(b"")
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0]: offsets[-1]]
        self.off = offsets - offsets[0]

    @classmethod
    def of(cls, data: np.ndarray, off: np.ndarray) -> "Texts":
        self = cls.__new__(cls)
        self.data, self.off = data, off
        return self

    def __len__(self) -> int:
        return len(self.off) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.off[i]: self.off[i + 1]].tobytes()

    def word_spans(self, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word (bytes outside `space`), and the word offsets of the texts."""
        data, off = self.data, self.off
        if not len(data):
            empty = np.zeros(0, np.int64)
            return empty, empty, np.zeros(len(off), np.int64)
        word = ~space[data]
        before = np.empty(len(data), bool)
        before[0], before[1:] = False, word[:-1]
        first = off[:-1][off[:-1] < len(data)]
        before[first] = False
        after = np.empty(len(data), bool)
        after[-1], after[:-1] = False, word[1:]
        after[off[1:][off[1:] > 0] - 1] = False
        starts = np.flatnonzero(word & ~before)
        ends = np.flatnonzero(word & ~after) + 1
        return starts, ends, np.searchsorted(starts, off)

    def words(self, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hash of every word with A-Z lowered, and the word offsets of the texts."""
        starts, ends, woff = self.word_spans(space)
        return span_hash(prefix_sums(self.data, BYTES), starts, ends), woff


def pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches with about `limit` bytes of text each, next to the texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64))
        at = 0
        while at < batch.num_rows:
            done = lengths[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(lengths, done + limit, "right")))
            part = batch.slice(at, end - at)
            yield part, Texts(part.column("text"))
            at = end


def shingles(h: np.ndarray, woff: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text; a text of fewer words gives its whole sequence."""
    count = np.diff(woff)
    each = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    soff = np.concatenate([[0], np.cumsum(each)])
    if not soff[-1]:
        return np.zeros(0, U64), soff
    first = np.arange(soff[-1]) + np.repeat(woff[:-1] - soff[:-1], each)
    words = np.repeat(np.minimum(count, k), each)
    g = words.astype(U64) * MULTIPLIERS[63]
    for j in range(k):
        g += np.where(j < words, h[np.minimum(first + j, len(h) - 1)] * MULTIPLIERS[j], U64(0))
    return mix(g), soff


def distinct(g: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every text, with new offsets."""
    parts = [np.unique(g[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts) if parts else g, np.concatenate([[0], np.cumsum(sizes)])


def set_sum(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint per text of its set of values."""
    s = np.concatenate([np.zeros(1, U64), np.cumsum(mix(values ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
    return mix(s[off[1:]] - s[off[:-1]] + np.diff(off).astype(U64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def below(x: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """Maps 64-bit hashes evenly and monotonically to 0 .. n - 1."""
    return ((x >> U64(32)) * np.asarray(n).astype(U64)) >> U64(32)
