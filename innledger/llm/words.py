"""Words, lines and their hashes for a whole batch of texts at once, as numpy arrays.

Texts are laid end to end as UTF-8 bytes, each followed by a newline, so that no word or line crosses from one
text to the next. A hash is a polynomial over the bytes modulo 2**64, read off prefix sums: one pass over the bytes
serves every word, line and window. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time, some 50 bytes of arrays for each of them; a longer text is hashed alone.
CHUNK_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
WHITESPACE = np.zeros(256, bool)
WHITESPACE[[32, 9, 10, 11, 12, 13]] = True
WITHIN = (np.arange(256) & 0xC0) == 0x80  # bytes inside a code point
_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_codes(lower: bool = False) -> np.ndarray:
    """A number per byte; with `lower`, A-Z count as a-z."""
    codes = _CODES.copy()
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        size = max(n, CHUNK_BYTES + (1 << 16))
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        found = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if n > 64 << 20:  # a single huge text: not worth keeping
            return found
        _powers = found
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in runs of at most `size` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64) + 1)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Packed:
    """Bytes of texts with the places of their words.

    `bounds[i]` to `bounds[i + 1]` are the bytes of text i with its newline; `first[i]` to `first[i + 1]` its words;
    `begin` and `end` the bytes of each word, `text_of` its text.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        joined = pc.binary_join_element_wise(texts, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
        n = len(joined)
        _, offsets, data = joined.buffers()
        offsets = np.frombuffer(offsets, np.int64)[joined.offset : joined.offset + n + 1]
        self.bounds = offsets - offsets[0]
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        self.n = n
        self.space = WHITESPACE[self.data]
        edge = np.flatnonzero(np.diff(self.space.view(np.int8), prepend=np.int8(1)))
        self.begin, self.end = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.begin, self.bounds)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(n), self.counts)
        self._codes = byte_codes(lower)
        self._sums: np.ndarray | None = None

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each span."""
        if self._sums is None:
            up, _ = powers(len(self.data) + 1)
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(self._codes[self.data] * up[: len(self.data)], dtype=np.uint64, out=self._sums[1:])
        _, down = powers(len(self.data) + 1)
        return mixed((self._sums[end] - self._sums[begin]) * down[begin] + (end - begin).astype(np.uint64))

    def words(self) -> np.ndarray:
        return self.spans(self.begin, self.end)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        if not self.n:
            return np.zeros(0, np.int64)
        return np.add.reduceat(marks.astype(np.int64), self.bounds[:-1])

    def windows(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every k consecutive words within a text, and the first word of each."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * BASE + words[j : j + n]
        inside = self.text_of[:n] == self.text_of[k - 1 :]
        return mixed(total[inside]), np.flatnonzero(inside)
