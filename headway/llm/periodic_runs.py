"""Periodic runs of words, found on an enhanced suffix array by the branching-tandem test.

The words of a text become codes that no other text shares, so that one suffix array (by prefix doubling), with its
inverse and the common prefixes of neighbours (LCP), serves many texts at once. Every place of the LCP array splits the
suffixes of an interval of that depth in two. A suffix of the smaller part whose partner, depth words before or after
it, lies in the other part begins (or ends) a square that the word after it breaks: a branching tandem. Each suffix is
in a smaller part at most log2(n) times. Squares are rotated to the left as far as the words agree, by the ranks that
prefix doubling left, and those with the same ends are one run, whose period is the smallest. Intervals are kept as
bounds in arrays; there are no tree nodes.

A run is a stretch of at least ``max(min_length, 2 * period)`` words, ``period`` the smallest distance at which all of
them repeat, that neither neighbouring word continues. ``collapsed`` is the text without the words that any run holds
after its first period, joined by one space.

Defined results: null and empty texts and those of white space have no words, no runs and an empty ``collapsed``. Equal
rows get equal results. Texts of any length are taken whole; memory follows the longest text (about 4 bytes a word for
each doubling of its longest repeat, besides a dozen arrays). Columns named like the added ones are replaced, all others
stay. An empty table gives an empty result. Words are told apart by 64-bit hashes within a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import small_batches
from .text_arrays import SPACE, Runs, Texts, mix, slices

MIN_LENGTH = 12
# Suffixes of smaller parts that are tested at once.
TESTED = 1 << 20
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the stretches of equal neighbours."""
    changes = np.ones(len(keys), bool)
    changes[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(changes)
    return starts, np.diff(np.append(starts, len(keys)))


def suffix_ranks(codes: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4 ... words, until all differ; equal ranks are equal words.

    ``left`` counts the words from each place to the end of its text. One more entry, -1, follows the last word.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    starts, sizes = _groups(codes[order])
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = np.repeat(starts, sizes), -1
    levels, open_, k = [rank.astype(np.int32)], order[np.repeat(sizes > 1, sizes)], 1
    while len(open_):
        follow = np.where(left[open_] > k, rank[np.minimum(open_ + k, n)] + 1, 0)
        old = rank[open_]
        key = old * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        open_, key, old = open_[order], key[order], old[order]
        starts, sizes = _groups(key)
        group_starts, group_sizes = _groups(old)
        rank[open_] = old + np.repeat(starts, sizes) - np.repeat(group_starts, group_sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        levels.append(rank.astype(np.int32))
        k *= 2
    return levels


def neighbour_prefixes(levels: list[np.ndarray], suffixes: np.ndarray) -> np.ndarray:
    """Common words of each suffix and the one before it in order; -1 for the first."""
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    lcp = np.zeros(len(suffixes), np.int64)
    lcp[0] = -1
    near = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b, common = a[near], b[near], np.zeros(len(near), np.int64)
    for j in range(len(levels) - 2, -1, -1):
        step = (levels[j][a] == levels[j][b]).astype(np.int64) << j
        a, b, common = a + step, b + step, common + step
    lcp[near + 1] = common
    return lcp


def interval_bounds(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place r of the LCP array the first suffix of the part that ends before r and the last of the one from r on."""
    values = lcp.tolist()
    first, last, waiting = [0] * len(values), [len(values) - 1] * len(values), [0]
    for r in range(1, len(values)):
        depth = values[r]
        while values[waiting[-1]] >= depth:
            last[waiting.pop()] = r - 1
        first[r] = waiting[-1]
        waiting.append(r)
    return np.array(first, np.int64), np.array(last, np.int64)


def branching_squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and half lengths of all squares that the word after them does not continue."""
    rank = levels[-1]
    n = len(rank) - 1
    suffixes = np.empty(n, np.int64)
    suffixes[rank[:n]] = np.arange(n)
    lcp = neighbour_prefixes(levels, suffixes)
    first, last = interval_bounds(lcp)
    at = np.flatnonzero(lcp > 0)
    first, last, depth = first[at], last[at], lcp[at]
    left_small = at - first <= last - at + 1
    begin, size = np.where(left_small, first, at), np.where(left_small, at - first, last - at + 1)
    low, high = np.where(left_small, at, first), np.where(left_small, last, at - 1)
    starts, halves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    total = np.cumsum(size)
    cuts = [0, *(np.flatnonzero(np.diff(total // TESTED)) + 1), len(at)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi <= lo:
            continue
        node = np.repeat(np.arange(lo, hi), size[lo:hi])
        inside = np.arange(len(node)) - np.repeat(total[lo:hi] - size[lo:hi] - (total[lo] - size[lo]), size[lo:hi])
        place, d = suffixes[begin[node] + inside], depth[node]
        for partner in (place + d, place - d):
            there = (partner >= 0) & (partner < n)
            r = rank[np.where(there, partner, n)]
            hit = there & (r >= low[node]) & (r <= high[node])
            starts.append(np.minimum(place, partner)[hit])
            halves.append(d[hit])
    return np.concatenate(starts), np.concatenate(halves)


def find_runs(codes: np.ndarray, left: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run of the words, by start and period."""
    if not len(codes):
        return (np.zeros(0, np.int64),) * 3
    levels = suffix_ranks(codes, left)
    start, period = branching_squares(levels)
    end, other = start + 2 * period, start + period
    for j in range(len(levels) - 2, -1, -1):
        a, b = start - (1 << j), other - (1 << j)
        step = ((a >= 0) & (levels[j][np.maximum(a, 0)] == levels[j][np.maximum(b, 0)])).astype(np.int64) << j
        start, other = start - step, other - step
    long_enough = end - start >= min_length
    start, end, period = start[long_enough], end[long_enough], period[long_enough]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    shortest = np.ones(len(start), bool)
    shortest[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[shortest], end[shortest], period[shortest]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def text_codes(words: Runs, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A code for each word that only equal words of the same text share, the words left in its text, and where texts begin."""
    counts = words.per_text(n_texts)
    begins = np.cumsum(counts) - counts
    own = mix(words.hash ^ mix(words.text.astype(np.uint64) + np.uint64(1)))
    codes = np.unique(own, return_inverse=True)[1].astype(np.int64)
    return codes, (begins + counts)[words.text] - np.arange(len(codes)), begins


def _joined(texts: Texts, words: Runs, kept: np.ndarray) -> pa.Array:
    """The kept words of every text, with a space between two."""
    start, length, owner = words.starts[kept], (words.ends - words.starts)[kept], words.text[kept]
    spaced = np.zeros(len(start), np.int64)
    spaced[1:] = owner[1:] == owner[:-1]
    ends = np.cumsum(length + spaced)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    if len(ends):
        before = np.cumsum(length) - length
        inside = np.arange(int(length.sum())) - np.repeat(before, length)
        out[np.repeat(ends - length, length) + inside] = texts.bytes[np.repeat(start, length) + inside]
    sizes = np.bincount(owner, weights=length + spaced, minlength=texts.n).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(texts.n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def runs_of_texts(texts: Texts, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, list of runs and collapsed text of every text."""
    words = texts.runs(SPACE)
    codes, left, begins = text_codes(words, texts.n)
    start, length, period = find_runs(codes, left, min_length)
    owner = words.text[start]
    step = np.zeros(len(codes) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    kept = np.cumsum(step[:-1]) == 0
    rows = pa.StructArray.from_arrays([pa.array(start - begins[owner]), pa.array(length), pa.array(period)], fields=list(RUN_TYPE))
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts.n))]).astype(np.int32)
    return words.per_text(texts.n), pa.ListArray.from_arrays(pa.array(ends), rows), _joined(texts, words, kept)


def collapse_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period; by start and period) and ``collapsed``."""
    added = ["n_words", "runs", "collapsed"]
    kept = [f for f in docs.schema if f.name not in added or f.name == text_col]
    added = [c for c in added if c != text_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text_col):
            n, runs, collapsed = runs_of_texts(texts, min_length)
            made = {"n_words": pa.array(n), "runs": runs, "collapsed": collapsed}
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *(made[c] for c in added)],
                                             names=[*(f.name for f in kept), *added])

    types = {"n_words": "bigint", "runs": "array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed": "string"}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"`{c}` {types[c]}" for c in added)])
    return small_batches(docs).select(*(f.name for f in kept)).mapInArrow(work, schema)
