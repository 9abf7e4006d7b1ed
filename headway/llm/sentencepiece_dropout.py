"""SentencePiece encoding and decoding with seeded merge-dropout.

A byte-pair model's merges are worked off from an agenda: the best piece first, the leftmost of equals. A candidate merge
is known by where its two parts begin and end in their unit (a word with the space marks before it); a keyed hash of
seed, document, place of the unit in the text, unit and these places tells whether it is skipped when its turn comes. So
a text is cut into shorter pieces than without dropout, each occurrence of a unit by its own draws, yet the same way on
every run and every executor. What can happen to a unit is a tree, whose nodes are the merges that have their turn: an
occurrence draws for those it comes to, and occurrences that make and skip the same are cut once. With dropout 0 the ids
are those of the model. Equal units are known by a 64-bit hash.

Short units are worked off together, as rows of arrays; the agenda of a row is the smallest rank in it. Long units have
an agenda of their own (a heap), so that a text without any space costs n log n.

Spaces become marks and one is put in front, as the model says. Characters without a piece, and marks that stand in the
text itself, become byte pieces, so every text decodes to itself.

Defined results: null text has null ids and decodes to null; an empty text has no ids. Equal rows get equal ids. Null
ids of documents count as 0 in the key. Texts of any length are encoded whole. An empty table gives an empty result.
The vocabulary is read from a model file by the driver and goes to the tasks; it is bounded by the model's size.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .shared import small_batches
from .text_arrays import mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 29
# Units are cut as rows of these widths, longer ones with a heap; texts are handled in slices of about so many characters.
WIDTHS = (1, 2, 4, 6, 8, 11, 15, 22, 40)
SLICE_CHARS = 1 << 19
MARK = "▁"
NONE = np.int32(2**31 - 1)
# Nodes of the tree of draws that a process keeps between slices: about 40 bytes each, its units and pieces included about 100.
KNOWN_NODES = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces, ranks of merges (the lower the earlier), byte pieces, and what is not text."""

    pieces: tuple[str, ...]
    ranks: tuple[int, ...]
    byte_ids: tuple[int, ...]
    control: frozenset[int]
    prefix: bool = True
    source: str = ""

    @cached_property
    def ids(self) -> dict[str, int]:
        special = set(self.byte_ids) | self.control
        return {p: i for i, p in enumerate(self.pieces) if i not in special}

    @cached_property
    def of_char(self) -> np.ndarray:
        """Id of each one-character piece by code point, -1 for none."""
        table = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                table[ord(piece)] = i
        return table

    @cached_property
    def merges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (left id, right id), ids of the merged pieces, and their ranks."""
        found = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = i
        keys = np.array(sorted(found), np.int64)
        merged = np.array([found[k] for k in keys.tolist()], np.int64)
        return keys, merged, np.array(self.ranks, np.int64)[merged]

    @cached_property
    def texts(self) -> list[bytes]:
        """What each id decodes to."""
        raw = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        return [raw.get(i, b"" if i in self.control else p.replace(MARK, " ").encode()) for i, p in enumerate(self.pieces)]

    @cached_property
    def slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The merges in an open-addressed table: keys (-1 for a free slot), merged ids and ranks."""
        keys, merged, ranks = self.merges
        size = 1 << max((16 * len(keys)).bit_length(), 4)
        table, ids, order = np.full(size + 1, -1, np.int64), np.full(size + 1, -1, np.int32), np.full(size + 1, NONE, np.int32)
        waiting, at = np.arange(len(keys)), _slot(keys, size)
        while len(waiting):
            free = table[at] == -1
            # Of those that meet in a free slot the first takes it; the others go on with those that found it taken.
            winners = np.flatnonzero(free)
            winners = winners[np.unique(at[winners], return_index=True)[1]]
            place = at[winners]
            table[place], ids[place], order[place] = keys[waiting[winners]], merged[waiting[winners]], ranks[waiting[winners]]
            rest = np.ones(len(waiting), bool)
            rest[winners] = False
            waiting, at = waiting[rest], (at[rest] + 1) & (size - 1)
        return table, ids, order

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged id and rank of pairs of ids; rank NONE where they don't merge."""
        table, merged, ranks = self.slots
        size = len(table) - 1
        want = (left.astype(np.int64) << 32) | right
        shape, want = want.shape, want.ravel()
        at = _slot(want, size)
        # Symbols below 0 are no piece: their slot is the last one, which stays free.
        at[((left < 0) | (right < 0)).ravel()] = size
        found = table[at]
        missed = np.flatnonzero((found != want) & (found != -1))
        while len(missed):
            at[missed] = (at[missed] + 1) & (size - 1)
            found = table[at[missed]]
            missed = missed[(found != want[missed]) & (found != -1)]
        return merged[at].reshape(shape), ranks[at].reshape(shape)


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    """Where a pair's search begins: the high bits of a multiplicative hash."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    scores = sorted({model.get_score(i) for i in range(n)}, reverse=True)
    rank = {s: k for k, s in enumerate(scores)}
    byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    control = frozenset(i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    return Vocabulary(tuple(model.id_to_piece(i) for i in range(n)), tuple(rank[model.get_score(i)] for i in range(n)), byte_ids, control,
                      bool(model.encode("a", out_type=str)[0].startswith(MARK)), hashlib.sha256(model.serialized_model_proto()).hexdigest())


def _place(start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((start.astype(np.uint64) << np.uint64(42)) ^ (mid.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64))


def _skipped(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    """Whether the merge of [start, mid) and [mid, end) of a unit is skipped under its key."""
    return (mix(key ^ _place(start, mid, end)) >> np.uint64(11)) < np.uint64(limit)


class Tree:
    """What happens to a unit: a node is the merge whose turn comes next, its children follow when it is made or skipped.

    A leaf has the pieces. An occurrence draws only for the merges that it comes to, and those that make and skip the same
    end in one leaf, which is cut once. A process keeps its tree between slices and tasks, at most KNOWN_NODES nodes;
    results don't depend on it.
    """

    def __init__(self) -> None:
        self.start_over(None)

    def start_over(self, settings) -> None:
        self.settings, self.roots, self.n = settings, {}, 0
        self.place, self.child = np.zeros(1024, np.uint64), np.full((1024, 2), -1, np.int32)
        # Where the pieces of a leaf are, and how many; -1 for a node that is none.
        self.at, self.count = np.zeros(1024, np.int64), np.full(1024, -1, np.int32)
        self.pool, self.used = np.zeros(4096, np.int32), 0

    def _room(self, nodes: int) -> None:
        if self.n + nodes > len(self.place):
            more = max(len(self.place), self.n + nodes)
            self.place = np.concatenate([self.place, np.zeros(more, np.uint64)])
            self.child = np.concatenate([self.child, np.full((more, 2), -1, np.int32)])
            self.at, self.count = np.concatenate([self.at, np.zeros(more, np.int64)]), np.concatenate([self.count, np.full(more, -1, np.int32)])

    def add_roots(self, units: list[int]) -> np.ndarray:
        """Roots of these units, new ones for those without."""
        self._room(len(units))
        found = np.array([self.roots.get(u, -1) for u in units], np.int64)
        fresh = np.flatnonzero(found < 0)
        found[fresh] = self.n + np.arange(len(fresh))
        self.roots.update(zip([units[i] for i in fresh.tolist()], found[fresh].tolist()))
        self.n += len(fresh)
        return found

    def known(self, node: np.ndarray) -> np.ndarray:
        """Whether nodes have been reached by a cut: then they have a merge or pieces."""
        return (self.count[node] >= 0) | (self.place[node] != 0)

    def walk(self, node: np.ndarray, own: np.ndarray, limit: int) -> np.ndarray:
        """How far each occurrence comes: to a leaf, or to a node that no cut has reached yet."""
        node = node.copy()
        going = np.flatnonzero((self.count[node] < 0) & (self.place[node] != 0))
        while len(going):
            here = node[going]
            skipped = (mix(own[going] ^ self.place[here]) >> np.uint64(11)) < np.uint64(limit)
            there = self.child[here, skipped.astype(np.int64)]
            # A child that is missing is made, as a node without anything.
            lost = np.flatnonzero(there < 0)
            if len(lost):
                edges, back = np.unique(here[lost] * 2 + skipped[lost], return_inverse=True)
                self._room(len(edges))
                made = self.n + np.arange(len(edges))
                self.child[edges >> 1, edges & 1] = made
                self.n += len(edges)
                there[lost] = made[back]
            node[going] = there
            going = going[(self.count[there] < 0) & (self.place[there] != 0)]
        return node

    def add_path(self, node: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]], counts: np.ndarray, pieces: np.ndarray) -> None:
        """Enters cuts below these roots. Each step has rows, places of merges and whether they are skipped; ``pieces`` are the ends."""
        node = node.copy()
        for rows, place, skipped in steps:
            here = node[rows]
            self.place[here] = place
            there = self.child[here, skipped.astype(np.int64)]
            lost = np.flatnonzero(there < 0)
            if len(lost):
                edges, back = np.unique(here[lost] * 2 + skipped[lost], return_inverse=True)
                self._room(len(edges))
                made = self.n + np.arange(len(edges))
                self.child[edges >> 1, edges & 1] = made
                self.n += len(edges)
                there[lost] = made[back]
            node[rows] = there
        if self.used + len(pieces) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(pieces)), np.int32)])
        self.pool[self.used:self.used + len(pieces)] = pieces
        self.at[node], self.count[node] = self.used + np.cumsum(counts) - counts, counts
        self.used += len(pieces)


_tree = Tree()


def cut_rows(v: Vocabulary, symbols: np.ndarray, keys: np.ndarray, limit: int, steps: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merges units together, one a row. Returns the pieces, shifted to the left, with start places; free places hold -2, as may
    those behind a short unit.

    ``steps`` gets, for every turn, the rows that have one, the merge's mixed place and whether it is skipped.
    """
    n, width = symbols.shape
    sym = symbols.astype(np.int32)
    begin = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
    out_sym, out_begin = np.full((n, width), -2, np.int32), np.full((n, width), width, np.int32)
    if width == 1:
        out_sym[:], out_begin[:] = sym, 0
        return out_sym, out_begin
    rows = np.arange(n)
    merged, rank = v.pairs(sym[:, :-1], sym[:, 1:])
    column = np.arange(width)
    while len(rows):
        k, at = np.arange(len(rows)), rank.argmin(axis=1)
        live = rank[k, at] < NONE
        if not live.all():
            ended = ~live
            out_sym[rows[ended]], out_begin[rows[ended]] = sym[ended], begin[ended, :width]
            rows, sym, begin, merged, rank, keys, at = rows[live], sym[live], begin[live], merged[live], rank[live], keys[live], at[live]
            if not len(rows):
                break
            k = np.arange(len(rows))
        new, made = merged[k, at], None
        if limit or steps is not None:
            place = _place(begin[k, at], begin[k, at + 1], begin[k, at + 2])
            made = (mix(keys ^ place) >> np.uint64(11)) >= np.uint64(limit)
            if steps is not None:
                steps.append((rows, place, ~made))
            # A merge that is skipped never has its turn again.
            rank[k[~made], at[~made]] = NONE
        # Right of a merge everything moves one place to the left.
        right = column >= (at if made is None else np.where(made, at, width))[:, None]
        np.copyto(begin[:, 1:-1], begin[:, 2:], where=right[:, :-1])
        np.copyto(sym[:, 1:-1], sym[:, 2:], where=right[:, :-2])
        np.copyto(merged[:, :-1], merged[:, 1:], where=right[:, :-2])
        np.copyto(rank[:, :-1], rank[:, 1:], where=right[:, :-2])
        if made is not None:
            k, at, new = k[made], at[made], new[made]
        sym[k, -1] = -2
        sym[k, at] = new
        rank[k, -1] = NONE
        # The pair that ends with the new piece, and the one that begins with it.
        before, after = at > 0, at < width - 1
        r, p = np.concatenate([k[before], k[after]]), np.concatenate([at[before] - 1, at[after]])
        merged[r, p], rank[r, p] = v.pairs(sym[r, p], sym[r, p + 1])
    return out_sym, out_begin


def cut_long(v: Vocabulary, symbols: np.ndarray, key: np.uint64, limit: int) -> tuple[list[int], list[int]]:
    """The same for one unit of any length, with a heap: pieces and their start places."""
    n = len(symbols)
    sym, right, left, end, alive = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    merged, rank = v.pairs(symbols[:-1], symbols[1:]) if n > 1 else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    agenda = [(r, i, sym[i], sym[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), merged.tolist())) if r < NONE]
    heapq.heapify(agenda)
    pair = {}
    one = np.array([key], np.uint64)
    while agenda:
        r, i, a, b, m = heapq.heappop(agenda)
        j = right[i]
        if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
            continue
        if limit and _skipped(one, np.array([i]), np.array([j]), np.array([end[j]]), limit)[0]:
            continue
        sym[i], end[i], right[i], alive[j] = m, end[j], right[j], False
        if right[j] < n:
            left[right[j]] = i
        for x, y in ((left[i], i), (i, right[i])):
            if x >= 0 and y < n and sym[x] >= 0 and sym[y] >= 0:
                if (sym[x], sym[y]) not in pair:
                    got = v.pairs(np.array([sym[x]]), np.array([sym[y]]))
                    pair[sym[x], sym[y]] = (int(got[1][0]), int(got[0][0]))
                rank_xy, merged_xy = pair[sym[x], sym[y]]
                if rank_xy < NONE:
                    heapq.heappush(agenda, (rank_xy, x, sym[x], sym[y], merged_xy))
    starts = [i for i in range(n) if alive[i]]
    return [sym[i] for i in starts], starts


def encode_texts(v: Vocabulary, texts: list[str], salts: np.ndarray, dropout: float = DROPOUT, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and how many each text has. ``salts`` has a number for each document."""
    limit = int(round(dropout * (1 << 53)))
    # U+2581 of the text itself stays apart from the marks: it has no symbol here.
    front = MARK if v.prefix else ""
    points = [np.frombuffer((front + t if t else "").replace(" ", MARK).encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    literal = [np.flatnonzero(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) == ord(MARK)) + len(front) if MARK in t else None for t in texts]
    sizes = np.array([len(p) for p in points], np.int64)
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    cp = np.concatenate(points).astype(np.int64)
    offsets = np.cumsum(sizes) - sizes
    sym = v.of_char[cp].astype(np.int64)
    mark = cp == ord(MARK)
    for o, places in zip(offsets, literal):
        if places is not None:
            sym[o + places], mark[o + places] = -1, False
    # A unit begins where marks begin, and with every text.
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    begins[offsets[sizes > 0]] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, total))
    owner = np.searchsorted(offsets[sizes > 0], starts, side="right") - 1
    owner = np.flatnonzero(sizes > 0)[owner]
    # Hash of each unit, told from others by its code points and which of them are marks.
    value = mix((cp * 2 + mark).astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    inside = np.arange(total) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x2545F4914F6CDD1D, np.uint64))
    unit = mix(np.add.reduceat(value * powers[inside], starts) + lengths.astype(np.uint64))
    nth = np.arange(len(starts)) - np.searchsorted(owner, owner)
    draw = mix(mix(salts[owner] ^ np.uint64(seed)) ^ nth.astype(np.uint64))
    own = mix(unit ^ mix(draw + mix(np.array([seed], np.uint64))))
    settings = (v.source, limit)
    if not v.source or _tree.settings != settings or _tree.n > KNOWN_NODES or _tree.used > 2 * KNOWN_NODES:
        _tree.start_over(settings)
    byte_ids = np.array(v.byte_ids, np.int64)
    short = np.flatnonzero(lengths <= WIDTHS[-1])
    count, at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    if len(short):
        distinct, first, back = np.unique(unit[short], return_index=True, return_inverse=True)
        roots = _tree.add_roots(distinct.tolist())
        node = _tree.walk(roots[back], own[short], limit)
        waiting = np.flatnonzero(_tree.count[node] < 0)
        while len(waiting):
            # One occurrence of each place that no cut has reached is cut; the others may come further by its cut.
            chosen = waiting[np.unique(node[waiting], return_index=True)[1]]
            wide = np.searchsorted(WIDTHS, lengths[short[chosen]])
            for kind in np.unique(wide).tolist():
                part = chosen[wide == kind]
                begin, size = starts[short[part]], lengths[short[part]]
                inside = np.arange(WIDTHS[kind])
                rows_of = np.where(inside < size[:, None], sym[begin[:, None] + np.minimum(inside, size[:, None] - 1)], -2)
                steps: list = []
                cut, place = cut_rows(v, rows_of, own[short[part]], limit, steps)
                full = cut != -2
                flat, n = cut[full], full.sum(axis=1)
                if (flat < 0).any():
                    flat, n = _with_bytes(flat, (place + begin[:, None])[full], n, cp, byte_ids)
                _tree.add_path(roots[back[part]], steps, n, flat.astype(np.int32))
            node[waiting] = _tree.walk(node[waiting], own[short[waiting]], limit)
            waiting = waiting[_tree.count[node[waiting]] < 0]
        count[short], at[short] = _tree.count[node], _tree.at[node]
    alone = [np.zeros(0, np.int32)]
    pool_size = _tree.used
    for i in np.flatnonzero(lengths > WIDTHS[-1]).tolist():
        s = int(starts[i])
        ids, begin = cut_long(v, sym[s:s + int(lengths[i])], own[i], limit)
        flat, n = np.array(ids, np.int64), np.array([len(ids)])
        if (flat < 0).any():
            flat, n = _with_bytes(flat, np.array(begin, np.int64) + s, n, cp, byte_ids)
        count[i], at[i] = len(flat), pool_size
        pool_size += len(flat)
        alone.append(flat.astype(np.int32))
    ends = np.cumsum(count)
    gather = np.repeat(at - (ends - count), count) + np.arange(int(ends[-1]))
    pool = np.concatenate([_tree.pool[:_tree.used], *alone]) if len(alone) > 1 else _tree.pool
    return pool[gather], np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)


def _with_bytes(flat: np.ndarray, place: np.ndarray, n: np.ndarray, cp: np.ndarray, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols without a piece replaced by the byte pieces of their character."""
    unit = np.repeat(np.arange(len(n)), n)
    encoded = {i: list(chr(cp[place[i]]).encode("utf-8", "surrogatepass")) for i in np.flatnonzero(flat < 0).tolist()}
    times = np.ones(len(flat), np.int64)
    for i, raw in encoded.items():
        times[i] = len(raw)
    out = np.repeat(flat, times)
    begin = np.cumsum(times) - times
    for i, raw in encoded.items():
        out[begin[i]:begin[i] + len(raw)] = byte_ids[raw]
    return out, np.bincount(np.repeat(unit, times), minlength=len(n)).astype(np.int64)


def decode_ids(v: Vocabulary, ids: list[int]) -> str:
    raw = b"".join(map(v.texts.__getitem__, ids))
    if v.prefix and raw.startswith(b" "):
        raw = raw[1:]
    return raw.decode("utf-8", "replace")


def _salts(column: pa.Array) -> np.ndarray:
    return mix(pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def encode(docs: DataFrame, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED,
           id_col: str = "doc_id", text_col: str = "text", out_col: str = "ids", check_col: str | None = None) -> DataFrame:
    """``docs`` with ``out_col``, the ids of the text, and with ``check_col`` whether they decode to it.

    Columns of these names are replaced, all others stay.
    """
    added = [out_col, *([check_col] if check_col else [])]
    kept = [f for f in docs.schema if f.name not in added]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes) // SLICE_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    part = batch.slice(lo, hi - lo)
                    texts = part.column(text_col)
                    ids, n = encode_texts(vocabulary, [t or "" for t in texts.to_pylist()], _salts(part.column(id_col)), dropout, seed)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids),
                                                     mask=texts.is_null() if texts.null_count else None)
                    columns = [lists]
                    if check_col:
                        ends, made = np.cumsum(n), ids.tolist()
                        columns.append(pa.array([decode_ids(vocabulary, made[e - k:e]) == (t or "") for e, k, t in zip(ends, n, texts.to_pylist())]))
                    yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *columns], names=[*(f.name for f in kept), *added])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out_col}` array<int>", *([f"`{check_col}` boolean"] if check_col else [])])
    return small_batches(docs).select(*(f.name for f in kept)).mapInArrow(work, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``, the text of the ids; a column of that name is replaced, all others stay."""
    kept = [f for f in encoded.schema if f.name != out_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                texts = [None if ids is None else decode_ids(vocabulary, ids) for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(texts, pa.string())], names=[*(f.name for f in kept), out_col])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out_col}` string"])
    return small_batches(encoded).mapInArrow(work, schema)
