"""NumPy helpers on the buffers of an Arrow string column: words of many texts at once, without a Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are handled in slices of about this many bytes, which bounds the arrays made from them; one longer text is a slice.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0x2545F4914F6CDD1D)


class Texts:
    """Bytes and offsets of some texts; null is an empty text."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "")
        if pa.types.is_string(column.type):
            offsets = np.frombuffer(column.buffers()[1], np.int32)
        else:
            column = column.cast(pa.large_string())
            offsets = np.frombuffer(column.buffers()[1], np.int64)
        offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = column.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.n = len(column)

    def runs(self, breaks: np.ndarray, fold: bool = False) -> Runs:
        return Runs(self, breaks, fold)

    def counted(self, flags: np.ndarray) -> np.ndarray:
        """True bytes per text."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


class Runs:
    """Maximal runs of bytes that are no breaks, inside one text each: start, end, text number and 64-bit hash."""

    def __init__(self, texts: Texts, breaks: np.ndarray, fold: bool):
        inside = ~breaks[texts.bytes]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = texts.offsets[:-1] < texts.offsets[1:]
        heads, tails = texts.offsets[:-1][filled], texts.offsets[1:][filled] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(texts.offsets, self.starts, side="right") - 1
        self.inside = inside
        lengths = self.ends - self.starts
        self.hash = np.zeros(len(lengths), np.uint64)
        if len(lengths):
            values = texts.bytes[inside]
            values = BYTE_VALUES[LOWER[values] if fold else values]
            begin = np.cumsum(lengths) - lengths
            powers = np.cumprod(np.full(int(lengths.max()), BASE, np.uint64))
            values *= powers[np.arange(len(values)) - np.repeat(begin, lengths)]
            self.hash = mix(np.add.reduceat(values, begin) + lengths.astype(np.uint64))

    def per_text(self, n: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n).astype(np.int64)


def windows(runs: Runs, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first run and hash of every window of n runs of one text."""
    count = len(runs.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(runs.text[:count] == runs.text[n - 1:])
    total = np.zeros(len(at), np.uint64)
    for j in range(n):
        total = mix(total * BASE + runs.hash[at + j])
    return at, total


def slices(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Record batches cut into slices of bounded text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                part = batch.slice(lo, hi - lo)
                yield part, Texts(part.column(text_col))
