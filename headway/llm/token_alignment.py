"""Alignment of two tokenizers: which tokens of a byte-level model (A) and a piece model (B) cover the same bytes.

A encodes a space and the text, B the text, before which it puts that space itself. The ends of A's tokens come from the
character offsets of the ``tokenizers`` library, those of B's from the spans in the result message of ``sentencepiece``
(its successor to the immutable one), and both are coarse cuts: a token whose span has as many bytes as the token
decodes to ends there. Where a character of several bytes is split between tokens, or made of byte pieces, spans are
empty or too wide; there the ends are found by the decoded bytes, from the last good cut on. Texts whose tokens do not
decode to the space and the text have no tokens.

Most words occur many times, so a text is cut into units first: a space that stands between two characters that are no
white space begins a unit. Neither model has a token across such a place (the byte-level split never does, and pieces
hold no mark behind another character, which is checked), so a unit is aligned once for a block of texts and encoded once
for a block or, where it came up in the first blocks of a task, for all that follow, strung together with others.

Places where tokens of both end cut a text into groups. Between two neighbouring ends of either side lies a part of one
A and one B token, so these parts are the links, one for each pair of tokens that overlap. The links of an id pair are
counted over all texts, in blocks of texts first, and the counts return to the blocks that hold the pair: one row for
each block and pair is shuffled, no row for a link, and a frequent pair has no more rows than there are blocks.

Defined results: null and empty texts, and those that do not decode to themselves, have zeros and an empty
``alignment``. Equal rows count as often as they stand in the table, and get equal results; null ids are kept. Strings
of special tokens are plain text. Texts of any length are taken whole. Only the id and the text are read, other columns
don't matter. An empty table gives an empty result. The files of the tokenizers are read by the driver and go to the
tasks; they are bounded by the vocabularies.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain
from operator import attrgetter, itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches, stored
from .text_arrays import BASE, BYTE_VALUES, mix

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
# Bytes of text that make a block, whose distinct pairs are counted together; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
# Bytes of distinct units that are strung together for one text of a tokenizer, whose time grows faster than a text.
STRUNG_BYTES = 1 << 11
# Bytes of the units whose tokens a task keeps for its later blocks.
KNOWN_BYTES = 4 << 20
SPACE_MARK = "▁"


@dataclass(frozen=True)
class TokenizerPair:
    """The two tokenizers as the bytes of their files, which is what tasks get."""

    byte_level: bytes
    pieces: bytes

    @cached_property
    def tools(self):
        return _tools(self.byte_level, self.pieces)


def read_tokenizers(byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> TokenizerPair:
    with open(byte_level, "rb") as a, open(pieces, "rb") as b:
        return TokenizerPair(a.read(), b.read())


class Decoded:
    """What the ids of one tokenizer decode to: all bytes in a row, and where each id's begin and how many there are."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.sizes[ids]
        ends = np.cumsum(size)
        return self.bytes[np.repeat(self.begins[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable ones are their own, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


@lru_cache(maxsize=2)
def _tools(byte_level: bytes, pieces: bytes):
    """Both tokenizers and their decoded ids, built once in a process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(byte_level.decode())
    a.encode_special_tokens = True
    added = {t["id"]: t["content"].encode() for t in json.loads(byte_level)["added_tokens"]}
    letters = byte_letters()
    entries = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}
    of_a = [added[i] if i in added else bytes(letters[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]
    b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
    names = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    if any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names):
        raise ValueError("a piece goes on behind a space, so texts can't be cut into units")
    of_b = [bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace(SPACE_MARK, " ").encode() for i, name in enumerate(names)]
    return a, Decoded(of_a), b, Decoded(of_b)


def refined_ends(coarse: np.ndarray, sizes: np.ndarray, new_text: np.ndarray, text_begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of tokens in bytes from the coarse ends of their spans; and whether each stretch of refined tokens came out at a cut.

    ``sizes`` are the bytes that tokens decode to, ``new_text`` marks the first token of a text, ``text_begin`` is where
    the text of each token begins.
    """
    before = np.empty_like(coarse)
    before[1:] = coarse[:-1]
    before = np.where(new_text, text_begin, before)
    fits = coarse - before == sizes
    if fits.all():
        return coarse, fits
    # Stretches of tokens that don't fit start at the end before them and go on by decoded bytes.
    first = ~fits
    first[1:] &= fits[:-1] | new_text[1:]
    stretch = np.cumsum(first) - 1
    run = np.cumsum(sizes)
    heads = np.flatnonzero(first)
    start = before[heads] - (run[heads] - sizes[heads])
    ends = np.where(fits, coarse, run + start[np.maximum(stretch, 0)])
    last = ~fits
    last[:-1] &= fits[1:] | new_text[1:]
    return ends, fits | ~last | (ends == coarse)


@dataclass
class Tokens:
    """Ids of one side for some texts, their ends in bytes of all texts in a row, and how many each text has."""

    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    def of(self, good: np.ndarray) -> Tokens:
        kept = np.repeat(good, self.counts)
        return Tokens(self.ids[kept], self.ends[kept], np.where(good, self.counts, 0))

    def picked(self, places: np.ndarray, decoded: Decoded) -> Tokens:
        """The tokens of the texts at these places, in this order, strung together anew."""
        begin, n = (np.cumsum(self.counts) - self.counts)[places], self.counts[places]
        ids = self.ids[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return Tokens(ids, np.cumsum(decoded.sizes[ids]), n)


def _side(ids: np.ndarray, coarse: np.ndarray, counts: np.ndarray, decoded: Decoded, begins: np.ndarray, data: np.ndarray,
          sizes: np.ndarray) -> tuple[Tokens, np.ndarray]:
    """Tokens with refined ends, and which texts they decode to."""
    new_text = np.zeros(len(ids), bool)
    new_text[(np.cumsum(counts) - counts)[counts > 0]] = True
    owner = np.repeat(np.arange(len(counts)), counts)
    length = decoded.sizes[ids]
    ends, sound = refined_ends(coarse, length, new_text, begins[owner])
    good = (np.bincount(owner, weights=length, minlength=len(counts)).astype(np.int64) == sizes) & (counts > 0)
    good[owner[~sound]] = False
    kept = np.repeat(good, counts)
    wrong = decoded.joined(ids[kept]) != data[np.repeat(good, sizes)]
    good[np.repeat(np.arange(len(counts)), np.where(good, sizes, 0))[wrong]] = False
    return Tokens(ids, ends, counts), good


def tokenise(pair: TokenizerPair, texts: list[str]) -> tuple[Tokens, Tokens, np.ndarray]:
    """Tokens of both sides, none for texts that don't decode to themselves; and the bytes of each text with its space."""
    a, of_a, b, of_b = pair.tools
    full = [" " + t if t else "" for t in texts]
    raw = "".join(full).encode()
    data = np.frombuffer(raw, np.uint8)
    byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    chars = np.array([len(t) for t in full], np.int64)
    first_char = np.cumsum(chars) - chars
    begins = byte_of[first_char]
    sizes = np.diff(np.append(begins, len(data)))
    made = a.encode_batch(full, add_special_tokens=False)
    counts = np.array([len(e) for e in made], np.int64)
    total = int(counts.sum())
    ids = np.fromiter(chain.from_iterable(e.ids for e in made), np.int64, total)
    offsets = np.fromiter(map(itemgetter(1), chain.from_iterable(e.offsets for e in made)), np.int64, total)
    left, good_a = _side(ids, byte_of[offsets + np.repeat(first_char, counts)], counts, of_a, begins, data, sizes)
    messages = b.encode(texts, return_type="proto", num_threads=1)
    counts = np.array([len(m.pieces) for m in messages], np.int64)
    pieces = chain.from_iterable(m.pieces for m in messages)
    spans = np.fromiter(chain.from_iterable(map(attrgetter("id", "end"), pieces)), np.int64, 2 * int(counts.sum()))
    ids, coarse = spans[::2], spans[1::2]
    right, good_b = _side(ids, coarse + np.repeat(begins + 1, counts), counts, of_b, begins, data, sizes)
    good = good_a & good_b
    return left.of(good), right.of(good), sizes


@dataclass
class Alignment:
    """Links and groups of the tokens of some texts. ``a`` and ``b`` are the tokens of each link, by place."""

    a: np.ndarray
    b: np.ndarray
    n_links: np.ndarray
    n_groups: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def align_tokens(a_ends: np.ndarray, b_ends: np.ndarray, sizes: np.ndarray) -> Alignment:
    """``a_ends`` and ``b_ends`` count bytes over all texts, which have ``sizes`` bytes; each has tokens of both sides or none.

    ``group_a`` and ``group_b`` count the tokens before the end of each group.
    """
    total = int(sizes.sum())
    at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
    at_a[a_ends], at_b[b_ends] = True, True
    text_ends = np.cumsum(sizes)

    def per_text(places: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.searchsorted(places, text_ends, side="right")]))

    cuts, both = np.flatnonzero(at_a | at_b), np.flatnonzero(at_a & at_b)
    return Alignment(np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts), per_text(cuts), per_text(both),
                     np.searchsorted(a_ends, both, side="right"), np.searchsorted(b_ends, both, side="right"))


@lru_cache(maxsize=4)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 to n - 1, one number in each row, and how many there are."""
    width = len(str(max(n - 1, 0)))
    digits = np.array([f"{i:<{width}d}".encode() for i in range(n)], f"S{width}").view(np.uint8).reshape(n, width)
    return digits, (digits != 32).sum(axis=1)


def alignment_texts(a: np.ndarray, b: np.ndarray, made: Alignment) -> pa.Array:
    """For each text its groups as ``a1,a2|b1;a3|b2,b3``: ids of A and B in order."""
    n_a, n_b, groups = len(a), len(b), len(made.group_a)
    in_group_a = np.repeat(np.arange(groups), np.diff(np.concatenate([[0], made.group_a])))
    in_group_b = np.repeat(np.arange(groups), np.diff(np.concatenate([[0], made.group_b])))
    before_b = np.concatenate([[0], made.group_b])
    ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    place_a, place_b = np.arange(n_a) + before_b[in_group_a], np.arange(n_b) + made.group_a[in_group_b]
    ids[place_a], ids[place_b] = a, b
    mark[place_a[made.group_a - 1]] = ord("|")
    last_b = place_b[made.group_b - 1]
    mark[last_b] = ord(";")
    text_ends = np.cumsum(made.n_groups)
    filled = made.n_groups > 0
    mark[last_b[text_ends[filled] - 1]] = 0
    digits, width = _decimals(int(max(ids.max() + 1, 1)) if len(ids) else 1)
    size = width[ids]
    marked = mark != 0
    ends = np.cumsum(size + marked)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    begin = ends - marked - size
    for column in range(digits.shape[1]):
        has = size > column
        out[begin[has] + column] = digits[ids[has], column]
    out[(ends - 1)[marked]] = mark[marked]
    stops = np.zeros(len(filled), np.int64)
    if len(ends):
        # A text ends with the last B token of its last group.
        stops[filled] = ends[last_b[text_ends[filled] - 1]]
        stops = np.maximum.accumulate(stops)
    offsets = np.concatenate([[0], stops]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(filled), pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _plain(byte: np.ndarray, earlier: np.ndarray | None = None) -> np.ndarray:
    """Whether characters are no white space for sure: ASCII above the space, or of two bytes from U+00C0 on.

    ``byte`` is the character's first byte; or its last, with ``earlier``, the byte before.
    """
    two = (byte >= 0xC3) & (byte < 0xE0) if earlier is None else (byte >= 128) & (earlier >= 0xC3) & (earlier < 0xE0)
    return ((byte > 32) & (byte < 128)) | two


def split_units(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where units begin in the bytes of texts, each of which begins with a space at its place in ``begins``.

    Texts are cut at spaces between two plain characters.
    """
    at = np.flatnonzero(data[1:-1] == 32) + 1
    plain = _plain(data[at - 1], data[np.maximum(at - 2, 0)]) & _plain(data[at + 1])
    cut = np.zeros(len(data), bool)
    cut[at[plain]] = True
    cut[begins] = True
    return np.flatnonzero(cut)


def distinct_units(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``starts``) of the first of equal units, and for each unit which of them it equals. Bytes are compared."""
    sizes = np.diff(np.append(starts, len(data)))
    inside = np.arange(len(data)) - np.repeat(starts, sizes)
    values = BYTE_VALUES[data] * np.cumprod(np.full(int(sizes.max()), BASE, np.uint64))[inside]
    keys = mix(np.add.reduceat(values, starts) + sizes.astype(np.uint64))
    _, first, back = np.unique(keys, return_index=True, return_inverse=True)
    same = sizes[first[back]] == sizes
    if same.all():
        same = np.logical_and.reduceat(data[np.repeat(starts[first[back]], sizes) + inside] == data, starts)
    if not same.all():
        # Units whose hash is another one's stay alone.
        odd = np.flatnonzero(~same)
        back = back.copy()
        back[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
    return first, back


def tokenise_units(pair: TokenizerPair, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[Tokens, Tokens, np.ndarray]:
    """As :func:`tokenise`, for units of ``raw``, most of them strung together in longer texts.

    Units that begin and end with plain characters are cut where they meet. The others, and those of texts that don't
    come out whole, are encoded by themselves.
    """
    data, size = np.frombuffer(raw, np.uint8), stops - starts
    easy = (size > 1) & _plain(data[np.minimum(starts + 1, len(data) - 1)]) & _plain(data[stops - 1], data[np.maximum(stops - 2, 0)])
    order = np.concatenate([np.flatnonzero(easy), np.flatnonzero(~easy)])
    n_easy = int(easy.sum())
    chunk = np.arange(len(order))
    chunk[:n_easy] = np.cumsum(size[order[:n_easy]]) // STRUNG_BYTES
    if n_easy:
        chunk[n_easy:] += int(chunk[n_easy - 1]) + 1 - n_easy
    heads = np.flatnonzero(np.diff(chunk, prepend=-1))
    parts = [raw[i:j] for i, j in zip(starts[order].tolist(), stops[order].tolist())]
    cut = [*heads.tolist(), len(order)]
    sides = tokenise(pair, [b"".join(parts[i:j])[1:].decode() for i, j in zip(cut, cut[1:])])
    limits = np.cumsum(size[order])
    whole = np.ones(len(order), bool)
    counts = []
    for side in sides[:2]:
        through = np.searchsorted(side.ends, limits, side="right")
        whole &= (through > 0) & (side.ends[np.maximum(through - 1, 0)] == limits) if len(side.ends) else False
        counts.append(np.diff(through, prepend=0))
    # Texts with a unit that isn't whole: strung ones are encoded unit by unit, single ones have no tokens.
    text_of = np.cumsum(np.diff(chunk, prepend=-1) != 0) - 1
    failed = np.zeros(len(heads), bool)
    failed[text_of[~whole]] = True
    alone = np.flatnonzero(failed[text_of] & (np.arange(len(order)) < n_easy))
    sides = [Tokens(t.ids, t.ends, n).of(~failed[text_of]) for t, n in zip(sides[:2], counts)]
    if len(alone):
        again = tokenise(pair, [parts[i][1:].decode() for i in alone.tolist()])
        sides = [_merged(t, r, alone) for t, r in zip(sides, again[:2])]
    back = np.argsort(order)
    _, of_a, _, of_b = pair.tools
    made = [side.picked(back, decoded) for side, decoded in zip(sides, (of_a, of_b))]
    return *made, np.where(made[0].counts > 0, size, 0)


class KnownUnits:
    """Tokens of units that earlier blocks of a task had, so that a frequent unit is encoded once in a task.

    Units are kept until they have ``KNOWN_BYTES``, others are encoded once a block. Bytes are compared.
    """

    def __init__(self):
        nothing = np.zeros(0, np.int64)
        self.place: dict[bytes, int] = {}
        self.room, self.sides = KNOWN_BYTES, [Tokens(nothing, nothing, nothing)] * 2

    def tokenise(self, pair: TokenizerPair, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[Tokens, Tokens, np.ndarray]:
        """As :func:`tokenise_units`."""
        parts = [raw[i:j] for i, j in zip(starts.tolist(), stops.tolist())]
        places = np.fromiter((self.place.get(part, -1) for part in parts), np.int64, len(parts))
        new, known = np.flatnonzero(places < 0), len(self.sides[0].counts)
        sides = self.sides
        if len(new):
            made = tokenise_units(pair, raw, starts[new], stops[new])
            places[new] = known + np.arange(len(new))
            # Ends are made when units are picked.
            sides = [Tokens(np.concatenate([old.ids, t.ids]), old.ends, np.concatenate([old.counts, t.counts])) for old, t in zip(sides, made)]
            taken = np.cumsum((stops - starts)[new])
            kept = int(np.searchsorted(taken, self.room, side="right"))
            if kept:
                self.room -= int(taken[kept - 1])
                self.place.update(zip((parts[i] for i in new[:kept].tolist()), range(known, known + kept)))
                self.sides = [Tokens(t.ids[:int(t.counts[:known + kept].sum())], t.ends, t.counts[:known + kept]) for t in sides]
        _, of_a, _, of_b = pair.tools
        made = [side.picked(places, decoded) for side, decoded in zip(sides, (of_a, of_b))]
        return *made, np.where(made[0].counts > 0, stops - starts, 0)


def _merged(side: Tokens, again: Tokens, places: np.ndarray) -> Tokens:
    """``side`` with the tokens of ``again`` at these places, which have none yet; the ends no longer hold."""
    counts = side.counts.copy()
    counts[places] = again.counts
    ids, own = np.empty(int(counts.sum()), np.int64), np.zeros(len(counts), bool)
    own[places] = True
    ids[np.repeat(own, counts)], ids[np.repeat(~own, counts)] = again.ids, side.ids
    return Tokens(ids, np.zeros(0, np.int64), counts)


def _packed(values: np.ndarray, kind: type) -> bytes:
    return values.astype(kind).tobytes()


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(raw, kind).astype(np.int64)


def _unit_width(n: int) -> int:
    """Bytes of a unit's number in a block of so many."""
    return 2 if n <= 1 << 16 else 3 if n <= 1 << 24 else 4


def _packed_units(units: np.ndarray, width: int) -> bytes:
    return units.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _unpacked_units(raw: bytes, width: int) -> np.ndarray:
    numbers = np.zeros((len(raw) // width, 4), np.uint8)
    numbers[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return numbers.view("<u4").ravel().astype(np.int64)


def _kind(decoded: Decoded) -> type:
    return np.uint16 if len(decoded.sizes) <= 1 << 16 else np.uint32


# Columns that one row of a block fills: the tokens of the block's distinct units, and how many each has.
SHEET = ("a", "n_a", "b", "n_b")


def _block(pair: TokenizerPair, texts: list[str], known: KnownUnits) -> tuple[list[bytes | None], dict[str, bytes], np.ndarray, np.ndarray]:
    """Units of each text (None where it has no tokens), tokens of the distinct units, and the block's pairs with their links."""
    encoded = [(" " + t).encode() if t else b"" for t in texts]
    raw = b"".join(encoded)
    data, sizes = np.frombuffer(raw, np.uint8), np.array([len(t) for t in encoded], np.int64)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return [None] * len(texts), dict.fromkeys(SHEET, b""), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = (np.cumsum(sizes) - sizes)[filled]
    starts = split_units(data, begins)
    owner = filled[np.searchsorted(begins, starts, side="right") - 1]
    first, unit = distinct_units(data, starts)
    stops = np.append(starts[1:], len(data))
    a, b, unit_sizes = known.tokenise(pair, raw, starts[first], stops[first])
    good = sizes > 0
    good[owner[a.counts[unit] == 0]] = False
    made = align_tokens(a.ends, b.ends, unit_sizes)
    times = np.bincount(unit[good[owner]], minlength=len(first))
    codes, back = np.unique(a.ids[made.a] << 32 | b.ids[made.b], return_inverse=True)
    n = np.bincount(back, weights=np.repeat(times, made.n_links), minlength=len(codes)).astype(np.int64)
    width = _unit_width(len(first))
    packed = _packed_units(unit, width)
    cut = [0, *(width * np.cumsum(np.bincount(owner, minlength=len(texts)))).tolist()]
    rows = [packed[i:j] if g else None for i, j, g in zip(cut, cut[1:], good)]
    _, of_a, _, of_b = pair.tools
    sheet = {"a": _packed(a.ids, _kind(of_a)), "n_a": _packed(a.counts, np.uint32), "b": _packed(b.ids, _kind(of_b)), "n_b": _packed(b.counts, np.uint32)}
    return rows, sheet, codes[n > 0], n[n > 0]


def token_blocks(docs: DataFrame, pair: TokenizerPair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Units of every text in blocks: id, block, ``units`` (numbers of the block's distinct units). The first row of a block
    has the tokens of these units and the block's links as ``pairs`` (array of pair, n). A pair is A's id times 2^32, plus B's.
    """
    pair_type = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, done, known = TaskContext.get().partitionId(), 0, KnownUnits()
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(size) // BLOCK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi <= lo:
                    continue
                part = batch.slice(lo, hi - lo)
                rows, sheet, codes, n = _block(pair, [t or "" for t in part.column(text_col).to_pylist()], known)
                rest = [None] * (hi - lo - 1)
                pairs = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.full(hi - lo, len(codes))]).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(codes), pa.array(n)], fields=list(pair_type.value_type)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), pa.array(np.full(hi - lo, partition << 32 | done, np.int64)), pa.array(rows, pa.binary()),
                     *(pa.array([sheet[c], *rest], pa.binary()) for c in SHEET), pairs], names=["id", "block", "units", *SHEET, "pairs"])
                done += 1

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = small_batches(docs).select(F.col(id_col), F.col(text_col))
    columns = ", ".join(f"{c} binary" for c in SHEET)
    return rows.mapInArrow(work, f"id {id_type}, block bigint, units binary, {columns}, pairs array<struct<pair:bigint,n:bigint>>")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Links of every id pair over all texts: ``pair``, ``links``, and whether no other pair of its B id has more (``best``)."""
    counts = blocks.select(F.explode("pairs").alias("p")).groupBy("p.pair").agg(F.sum("p.n").alias("links"))
    counts = counts.withColumn("b_id", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    most = counts.groupBy("b_id").agg(F.max("links").alias("most"))
    return counts.join(most, "b_id").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of whole numbers over consecutive stretches of so many."""
    run, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(counts)
    return run[ends] - run[ends - counts]


def _joined_units(unit_texts: pa.Array, used: np.ndarray, per_text: np.ndarray) -> pa.Array:
    """The alignments of each text's units, with a semicolon between two."""
    pieces = np.array(unit_texts.to_pylist(), object)[used] if len(used) else np.zeros(0, object)
    cut = [0, *np.cumsum(per_text).tolist()]
    return pa.array([";".join(pieces[i:j]) for i, j in zip(cut, cut[1:])], pa.string())


def align(docs: DataFrame, pair: TokenizerPair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each of ``docs``: the id, n_a, n_b, n_groups, n_links, n_best (links whose pair is its B id's most frequent
    one, ties included), count_sum (frequency of the pair, over links), and ``alignment``, the groups as text.

    The tokens are written once to the shared folder: they are read for the counts and again with the counts.
    """
    blocks = stored(token_blocks(docs, pair, id_col, text_col), "tokens", compression="zstd")
    wanted = blocks.select(F.col("block").alias("holder"), F.explode("pairs").alias("p")).select("holder", "p.pair")
    known = wanted.join(pair_counts(blocks), "pair")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def work(texts: pa.Table, counts: pa.Table) -> pa.Table:
        texts = texts.combine_chunks()
        sheet = {c: b"".join(x for x in texts.column(c).to_pylist() if x) for c in SHEET}
        _, of_a, _, of_b = pair.tools
        a, n_a, b, n_b = (_unpacked(sheet[c], k) for c, k in zip(SHEET, (_kind(of_a), np.uint32, _kind(of_b), np.uint32)))
        made = align_tokens(np.cumsum(of_a.sizes[a]), np.cumsum(of_b.sizes[b]), _sums(of_a.sizes[a], n_a))
        code, links, best = (counts.column(c).to_numpy() for c in ("pair", "links", "best"))
        order = np.argsort(code)
        # Pairs that only texts without tokens hold have no count, and nothing asks for it.
        at = np.minimum(np.searchsorted(code[order], a[made.a] << 32 | b[made.b]), max(len(code) - 1, 0))
        links, best = (x[order][at] if len(code) else np.zeros(len(at), np.int64) for x in (links, best))
        of_unit = [n_a, n_b, made.n_groups, made.n_links, _sums(best.astype(np.int64), made.n_links), _sums(links, made.n_links)]
        rows, width = [x or b"" for x in texts.column("units").to_pylist()], _unit_width(len(n_a))
        used, per_text = _unpacked_units(b"".join(rows), width), np.array([len(r) // width for r in rows], np.int64)
        columns = [pa.array(_sums(c[used], per_text)) for c in of_unit]
        return pa.Table.from_arrays([texts.column("id"), *columns, _joined_units(alignment_texts(a, b, made), used, per_text)], names=[id_col, *names, "alignment"])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {id_type}", *(f"{c} bigint" for c in names), "alignment string"])
    return blocks.select("id", "block", "units", *SHEET).groupBy("block").cogroup(known.groupBy("holder")).applyInArrow(work, schema)
