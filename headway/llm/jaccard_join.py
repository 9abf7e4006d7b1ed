"""N-gram Jaccard join by vertical partitioning.

All shingles have one global order, rare ones first. How frequent a shingle is comes from a sketch that counts every
document (a fixed number of counters; it decides the order and so the speed, never a result). Exact copies of a set are
one node. A node posts the first shingles of its order that a partner of the wanted similarity must share; posted
shingles held by two nodes or more give candidates, which size and place of the shingle thin out. The order is cut into
fragments of equal mass; for each candidate the overlaps of the two sets are counted fragment by fragment and summed.

Links are only needed between groups that are not joined yet: first every node meets one pivot, the node with the fewest
rarer shingles among those it shares most with; when the linked ones are put together, what remains are candidates of
different groups, all of them. A large group of near copies so costs about one pair per member.

Defined results: null or wordless text has an empty set, no link, and is its own component. Texts of fewer words than a
shingle have one. Rows that share an id are joined each by its own text and stay; a component's id ignores null ids.
Very long texts are read whole; ties have no part in the result. An empty table gives an empty result.

Nodes are told by 64 bits of hash of the set together with its size; shingles by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import small_batches, stored, text_mark
from .text_arrays import SPACE, Texts, mix, slices, windows

SHINGLE = 4
PERCENT = 85
FRAGMENTS = 8
SKETCH_BITS = 20
BLOCK = 1 << 14
FAN = 64
FILTER_BITS = 1 << 23


def shingle_sets(texts: Texts, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct shingles, in the order of both."""
    words = texts.runs(SPACE, fold=True)
    at, hashes = windows(words, shingle)
    owner = words.text[at]
    counts = words.per_text(texts.n)
    for few in range(1, shingle):
        at, h = windows(words, few)
        short = counts[words.text[at]] == few
        owner, hashes = np.concatenate([owner, words.text[at[short]]]), np.concatenate([hashes, h[short]])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[first], hashes[first]


def signatures(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and hash of each set."""
    sizes = np.bincount(owner, minlength=n).astype(np.int64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(1)), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return sizes, mix(sums[ends] - sums[ends - sizes]).view(np.int64)


def _unseen(sigs: np.ndarray, sizes: np.ndarray, seen: set[int]) -> np.ndarray:
    """True for the texts whose set this task has not met before."""
    fresh = np.zeros(len(sigs), bool)
    for i, s in enumerate(sigs.tolist()):
        if sizes[i] and s not in seen:
            seen.add(s)
            fresh[i] = True
    return fresh


def _sizes_and_sketch(own: DataFrame, id_type: str, shingle: int) -> DataFrame:
    """Rows (id, n, sig) of the documents, with their mark if they have one, and rows (block, slot, counts) of each task's part of the sketch."""
    marked = "mark" in own.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen, slot, ids = np.zeros(1 << SKETCH_BITS, np.uint32), set(), TaskContext.get().partitionId(), None
        names = ["id", "n", "sig", "block", "slot", "counts", *(["mark"] if marked else [])]
        for part, texts in slices(batches, "text"):
            owner, hashes = shingle_sets(texts, shingle)
            sizes, sigs = signatures(owner, hashes, texts.n)
            fresh = _unseen(sigs, sizes, seen)
            sketch += np.bincount((hashes[fresh[owner]] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS).astype(np.uint32)
            ids = part.column("id")
            none = pa.nulls(texts.n, pa.int32())
            marks = [part.column("mark")] if marked else []
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(sigs), none, none, pa.nulls(texts.n, pa.binary()), *marks], names=names)
        if ids is not None:
            blocks = [sketch[lo:lo + BLOCK].tobytes() for lo in range(0, len(sketch), BLOCK)]
            n = len(blocks)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, ids.type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(range(n), pa.int32()),
                                              pa.array([slot] * n, pa.int32()), pa.array(blocks, pa.binary()),
                                              *([pa.nulls(n, pa.int64())] if marked else [])], names=names)

    return small_batches(own).mapInArrow(work, f"id {id_type}, n long, sig long, block int, slot int, counts binary{', mark long' if marked else ''}")


def _summed(parts: DataFrame) -> np.ndarray:
    """The whole sketch; tasks' parts are added 64 at a time, and one sketch of fixed size goes to the driver."""
    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")], axis=0, dtype=np.uint64)
        return pa.table({"block": table.column("block")[:1], "slot": table.column("part")[:1],
                         "counts": pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())})

    last = parts.agg(F.max("slot")).first()[0]
    if last is None:
        return np.zeros(1 << SKETCH_BITS, np.uint32)
    tasks = last + 1
    while True:
        parts = parts.withColumn("part", F.floor(F.col("slot") / FAN).cast("int")).groupBy("block", "part").applyInArrow(
            add, "block int, slot int, counts binary")
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
        parts = stored(parts, "sketch")
    rows = sorted((r["block"], bytes(r["counts"])) for r in parts.collect())
    return np.frombuffer(b"".join(counts for _, counts in rows), np.uint32)


class Order:
    """The global order of shingles: class of frequency, then hash; and the places where it is cut into fragments."""

    def __init__(self, sketch: np.ndarray, fragments: int):
        self.classes = np.minimum(255, 6 * np.log2(sketch + 1.0)).astype(np.uint8)
        places = np.lexsort((np.arange(len(sketch)), self.classes))
        mass = np.cumsum(sketch[places].astype(np.float64))
        cut = places[np.searchsorted(mass, mass[-1] * np.arange(1, fragments) / fragments)]
        self.cuts = (self.classes[cut].astype(np.uint64) << np.uint64(56)) | (cut.astype(np.uint64) << np.uint64(56 - SKETCH_BITS))

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        group = self.classes[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        return (group.astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))


def _ordered(texts: Texts, shingle: int, order: Order, chosen) -> Iterator[np.ndarray]:
    """Owner, hash, order key, place in the set and size of the set, in global order, of the chosen texts' shingles."""
    owner, hashes = shingle_sets(texts, shingle)
    sizes, sigs = signatures(owner, hashes, texts.n)
    use = chosen(sigs, sizes)
    owner, hashes = owner[use[owner]], hashes[use[owner]]
    keys = order.keys(hashes)
    by = np.lexsort((keys, owner))
    owner, hashes, keys = owner[by], hashes[by], keys[by]
    left = np.where(use, sizes, 0)
    begin = np.cumsum(left) - left
    return owner, hashes, keys, np.arange(len(owner)) - begin[owner], sizes, sigs


def postings(own: DataFrame, order: Order, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(tok, sig, n, pos): the first shingles of every set, one of which each partner must share."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, texts in slices(batches, "text"):
            owner, hashes, _, pos, sizes, sigs = _ordered(texts, shingle, order, lambda s, n: _unseen(s, n, seen))
            head = pos < (sizes - -(-percent * sizes // 100) + 1)[owner]
            owner = owner[head]
            yield pa.RecordBatch.from_arrays([pa.array(hashes[head].view(np.int64)), pa.array(sigs[owner]), pa.array(sizes[owner].astype(np.int32)),
                                              pa.array(pos[head].astype(np.int32))], names=["tok", "sig", "n", "pos"])

    return own.select("text").mapInArrow(work, "tok long, sig long, n int, pos int")


def may_link(percent: int, n: str, pos: str, m: str, q: str) -> Column:
    """Sizes n and m are near enough, and enough shingles are left from places pos and q on."""
    n, pos, m, q = map(F.col, (n, pos, m, q))
    enough = (100 + percent) * F.least(n - pos, m - q).cast("long") >= percent * (n + m).cast("long")
    return (100 * F.least(n, m).cast("long") >= percent * F.greatest(n, m).cast("long")) & enough


def id_mark(id_column: Column) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(FILTER_BITS))


def members(classes: DataFrame, pairs: DataFrame) -> np.ndarray:
    """A filter of fixed size on document ids, so that only documents that stand for a node of a pair are cut into shingles.

    It may let a few others through; the joins drop them.
    """
    nodes = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    bit = nodes.join(classes, "sig").select(id_mark(F.col("least")).alias("bit"))
    held = bit.select(F.bitmap_bucket_number("bit").alias("bucket"), F.bitmap_bit_position("bit").alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()
    member = np.zeros(FILTER_BITS, bool)
    for row in held:
        bits = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little").astype(bool)
        # Bucket k holds the numbers from (k - 1) * 32768 + 1 to k * 32768; number 0 is in bucket 0.
        inside = np.flatnonzero(bits) + (row["bucket"] - 1) * len(bits) + 1
        member[inside[(inside >= 0) & (inside < FILTER_BITS)]] = True
        if row["bucket"] == 0:
            member[0] = True
    return np.packbits(member)


def verified(own: DataFrame, classes: DataFrame, pairs: DataFrame, order: Order, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, an, b, bn) that link: overlaps counted by fragment, then summed."""
    packed = members(classes, pairs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = np.unpackbits(packed).astype(bool), set()

        def picked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(wanted[batch.column("bit").to_numpy(zero_copy_only=False)]))

        for _, texts in slices(picked(), "text"):
            owner, hashes, keys, _, sizes, sigs = _ordered(texts, shingle, order, lambda s, n: _unseen(s, n, seen))
            fragment = np.searchsorted(order.cuts, keys, side="right")
            first = np.ones(len(owner), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (fragment[1:] != fragment[:-1])
            at = np.flatnonzero(first)
            lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(owner)).astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(sigs[owner[at]]), pa.array(sizes[owner[at]].astype(np.int32)),
                                              pa.array(fragment[at].astype(np.int32)), lists], names=["sig", "n", "fragment", "toks"])

    sets = own.select(id_mark(F.col("id")).alias("bit"), "text").mapInArrow(work, "sig long, n int, fragment int, toks array<long>")
    # Both joins use the partitioning of this grouping, so a set is shuffled once and then once for each of its pairs.
    sets = sets.groupBy("sig", "n", "fragment").agg(F.any_value("toks").alias("toks"))
    left, right = sets.toDF("a", "an", "fragment", "a_toks"), sets.toDF("b", "bn", "fragment", "b_toks")
    cut = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(len(order.cuts)))))
    partial = cut.join(left, ["a", "an", "fragment"]).join(right, ["b", "bn", "fragment"]).select(
        "a", "an", "b", "bn", F.size(F.array_intersect("a_toks", "b_toks")).alias("both"))
    total = partial.groupBy("a", "an", "b", "bn").agg(F.sum("both").alias("both"))
    return total.where(100 * F.col("both") >= percent * (F.col("an") + F.col("bn") - F.col("both"))).select("a", "b")


def similar_links(own: DataFrame, classes: DataFrame, order: Order, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(a, b) between nodes: enough links that all linked nodes are connected."""
    # One shuffle brings the rows of a shingle together; those of shingles that one node alone posts go no further.
    whole = Window.partitionBy("tok")
    posted = postings(own, order, percent, shingle)
    held = posted.withColumns({"lo": F.min("sig").over(whole), "hi": F.max("sig").over(whole), "pivot": F.min(F.struct("pos", "n", "sig")).over(whole)})
    held = stored(held.where("lo <> hi").select("tok", "sig", "n", "pos", F.col("pivot.sig").alias("p"), F.col("pivot.n").alias("pn"),
                                                F.col("pivot.pos").alias("ppos")), "held")
    # One pivot for each node: the one it shares most posted shingles with.
    votes = held.where((F.col("sig") != F.col("p")) & may_link(percent, "n", "pos", "pn", "ppos")).groupBy("sig", "n", "p", "pn").agg(F.count("*").alias("v"))
    pivots = votes.groupBy("sig", "n").agg(F.max(F.struct("v", "p", "pn")).alias("best"))
    first = stored(pivots.select(F.col("sig").alias("a"), F.col("n").alias("an"), F.col("best.p").alias("b"), F.col("best.pn").alias("bn")), "pairs")
    links = stored(verified(own, classes, first, order, percent, shingle), "links")
    roots = components(links)
    grouped = held.join(roots, held.sig == roots.node, "left").select("tok", "sig", "n", "pos", F.coalesce("root", "sig").alias("root")).distinct()
    grouped = stored(grouped, "grouped")
    other = grouped.toDF("tok", "sig2", "n2", "pos2", "root2")
    rest = grouped.join(other, "tok").where((F.col("sig") < F.col("sig2")) & (F.col("root") != F.col("root2")) & may_link(percent, "n", "pos", "n2", "pos2"))
    pairs = rest.select(F.col("sig").alias("a"), F.col("n").alias("an"), F.col("sig2").alias("b"), F.col("n2").alias("bn")).distinct()
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
    return links.unionByName(verified(own, classes, pairs, order, percent, shingle))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], share: int = 1000) -> DataFrame:
    """Left join with one right row a key. Keys with over 1/share of the rows, at most ``share``, are broadcast."""
    total = left.count()
    hot = stored(left.groupBy(*keys).count().where(F.col("count") > max(1, total // share)).select(*keys), "hot")
    few = F.broadcast(hot)
    often = left.join(few, keys, "left_semi").join(F.broadcast(right.join(few, keys, "left_semi")), keys, "left")
    return often.unionByName(left.join(few, keys, "left_anti").join(right, keys, "left"))


def _grouped(docs: DataFrame, percent: int, shingle: int, fragments: int, id_col: str, text_col: str, marked: bool) -> DataFrame:
    """One row per document: id, mark of its text (if wanted), n, sig, and head (least id, sig, n) of its group; null if it is alone."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = dict(docs.dtypes)[id_col]
    scanned = stored(_sizes_and_sketch(own.withColumn("mark", text_mark(F.col("text"))) if marked else own, id_type, shingle), "sets")
    sizes = scanned.where("block is null").select("id", *(["mark"] if marked else []), "n", "sig")
    order = Order(_summed(scanned.where("block is not null").select("block", "slot", "counts")), fragments)
    classes = stored(sizes.where("n > 0").groupBy("sig", "n").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "classes")
    roots = components(similar_links(own, classes, order, percent, shingle))
    placed = classes.join(roots, classes.sig == roots.node, "left").select("sig", "n", "least", "copies", F.coalesce("root", "sig").alias("root"), F.col("root").isNotNull().alias("linked"))
    # Sets of null ids only come last.
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "sig", "n"))
    heads = placed.where("linked").groupBy("root").agg(first.alias("head"))
    merged = placed.where("linked or copies > 1").join(heads, "root", "left").select(
        "sig", "n", F.coalesce("head", F.struct(F.col("least").isNull().alias("none"), "least", "sig", "n")).alias("head"))
    return spread_join(sizes, stored(merged, "merged"), ["sig", "n"])


def jaccard_components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, fragments: int = FRAGMENTS,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, mark of the set (sig), n_shingles, component_id."""
    result = _grouped(docs, percent, shingle, fragments, id_col, text_col, False)
    return result.select(F.col("id").alias(id_col), "sig", F.col("n").alias("n_shingles"), F.coalesce("head.least", "id").alias("component_id"))


def without_near_copies(docs: DataFrame, percent: int, shingle: int, fragments: int = FRAGMENTS,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group: the one with the smallest id, of these the one with the smallest mark of its set.

    Rows go by id and set, so one text of a repeated id can go and another stay; rows that repeat both stay together.
    Null ids come last: such a row stays only if its group has no other id. Texts without words stay.
    """
    result = _grouped(docs, percent, shingle, fragments, id_col, text_col, True)
    is_head = F.col("id").eqNullSafe(F.col("head.least")) & (F.col("sig") == F.col("head.sig")) & (F.col("n") == F.col("head.n"))
    gone = result.where(F.col("head").isNotNull() & ~is_head).select(F.col("id").alias("__gone"), F.col("mark").alias("__mark")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(F.col("__gone")) & (text_mark(docs[text_col]) == F.col("__mark")), "left_anti")
