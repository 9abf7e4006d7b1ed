"""Quality classifier by importance resampling.

Byte 4-grams and repeated words are hashed into a fixed number of buckets. Two generative models, smoothed shares of the buckets,
are counted: one of the target (documents labelled good and not toxic) and one of the raw text (all documents). A document's weight is
the sum of log ratios over its n-grams. With Gumbel noise added, taking the k largest keys is sampling without
replacement in proportion to the weights. ``k`` is given, or counted from a cut that separates labelled good and bad best; then as many documents stay as have a key above that cut.

The raw model reads every document. The target is a bounded sample of the labels (``label_rows``, picked by hash), half
for the model and half for the cut; these rows are broadcast, at most ``label_rows`` of 20 bytes.

Defined results: null or wordless text has weight 0. Noise comes from id, text and seed, so equal rows get equal keys
and ties at the k-th key are all kept. Without usable labels all weights are 0 and every document is kept. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches, stored, text_mark
from .text_arrays import SPACE, Texts, slices

GRAM = 4
BUCKETS = 1 << 16
LABEL_ROWS = 20_000
SMOOTH = 1.0
SEED = 17
# Scale of the Gumbel noise; 1 is sampling exactly in proportion to the weights.
TEMPERATURE = 1.0


def gram_buckets(texts: Texts, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every gram, in the order of the texts, with where each text's grams begin and how many it has.

    Grams are the byte 4-grams inside a text, and one for each word that repeats the word before it (bucket 0).
    """
    data = texts.bytes.astype(np.uint32)
    n = max(len(data) - GRAM + 1, 0)
    packed = np.zeros(n, np.uint32)
    for j in range(GRAM):
        packed |= data[j:n + j] << np.uint32(8 * j)
    bucket = 1 + ((packed * np.uint32(2654435761)) >> np.uint32(8)).astype(np.int64) % (buckets - 1)
    # A gram that would reach into the next text counts for none.
    ends = texts.offsets[1:]
    inside = np.ones(n, bool)
    for j in range(1, GRAM):
        last = ends - j
        inside[last[(last >= texts.offsets[:-1]) & (last < n)]] = False
    words = texts.runs(SPACE, fold=True)
    twice = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])) + 1
    owner = np.concatenate([np.repeat(np.arange(texts.n), np.diff(texts.offsets))[:n][inside], words.text[twice]])
    bucket = np.concatenate([bucket[inside], np.zeros(len(twice), np.int64)])
    order = np.argsort(owner, kind="stable") if len(twice) else slice(None)
    sizes = np.bincount(owner, minlength=texts.n)
    return bucket[order], np.cumsum(sizes) - sizes, sizes


def label_sample(labels: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """(label_id, good, toxic, fit): at most ``rows`` ids, picked by hash; of an id with several labels the worst counts."""
    each = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.min((F.col("quality") == 1).cast("int")).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    picked = each.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    return picked.withColumn("fit", F.pmod(F.xxhash64(F.lit("half"), "label_id"), F.lit(2)) == 0)


def fit_models(marked: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of target to raw share of each bucket. ``marked``: text, in_target."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part, texts in slices(batches, "text"):
            bucket, _, sizes = gram_buckets(texts, buckets)
            raw += np.bincount(bucket, minlength=buckets)
            chosen = part.column("in_target").to_numpy(zero_copy_only=False).astype(bool)
            if chosen.any():
                target += np.bincount(bucket[np.repeat(chosen, sizes)], minlength=buckets)
        full = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(raw[full]), pa.array(target[full])], names=["bucket", "raw", "target"])

    sums = small_batches(marked).mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target")).toArrow()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    where = sums.column(0).to_numpy()
    raw[where], target[where] = sums.column(1).to_numpy(), sums.column(2).to_numpy()
    if not target.sum():
        return np.zeros(buckets)
    share = (raw + SMOOTH) / (raw.sum() + SMOOTH * buckets)
    # The raw share is the prior of the target, so buckets that the labelled rows don't show stay near ratio 1.
    prior = SMOOTH * buckets
    return np.log((target + prior * share) / (target.sum() + prior)) - np.log(share)


def weigh(docs: DataFrame, ratios: np.ndarray, seed: int = SEED, temperature: float = TEMPERATURE) -> DataFrame:
    """``docs`` (id, text, more) with n_grams, weight and key in place of text."""
    kept = [f for f in docs.schema if f.name != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            bucket, begin, sizes = gram_buckets(texts, len(ratios))
            weight = np.zeros(texts.n)
            if len(bucket):
                weight[sizes > 0] = np.add.reduceat(ratios[bucket], begin[sizes > 0])
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(sizes.astype(np.int64)), pa.array(weight)],
                                             names=[*(f.name for f in kept), "n_grams", "weight"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", n_grams long, weight double"
    scored = docs.mapInArrow(score, schema)
    unit = (F.pmod(F.xxhash64(F.lit(seed), "id", "mark"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    return scored.withColumn("key", F.col("weight") - temperature * F.log(-F.log(unit)))


def best_cut(keys: np.ndarray, good: np.ndarray, times: np.ndarray | None = None) -> float | None:
    """The cut with the fewest labelled documents on the wrong side, both kinds weighing the same.

    ``times`` says how many documents each key stands for; without it, one.
    """
    if not good.any() or good.all():
        return None
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], np.ones(len(keys)) if times is None else times[order].astype(float)
    good, bad = np.where(good[order], times, 0.0), np.where(good[order], 0.0, times)
    # Cutting below place i rejects the i lowest keys.
    wrong = np.concatenate([[0], np.cumsum(good)]) / good.sum() + (bad.sum() - np.concatenate([[0], np.cumsum(bad)])) / bad.sum()
    edges = np.concatenate([[-np.inf], (keys[:-1] + keys[1:]) / 2, [np.inf]])
    usable = np.concatenate([[True], keys[1:] > keys[:-1], [True]])
    wrong = np.where(usable, wrong, np.inf)
    best = np.flatnonzero(wrong == wrong.min())
    return float(edges[best[len(best) // 2]])


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest key, by counting in ever narrower bins; only bins go to the driver."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k >= n:
        return -np.inf
    if k <= 0:
        return np.inf
    left = k
    while True:
        width = (high - low) / bins
        if not width or low + width == low:
            return low
        number = F.least(F.floor((F.col("key") - low) / width), F.lit(bins - 1))
        counts = dict(keys.where(F.col("key").between(low, high)).groupBy(number.alias("bin")).agg(F.struct(
            F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))).collect())
        for b in sorted(counts, reverse=True):
            if counts[b]["n"] >= left:
                if counts[b]["n"] == 1 or counts[b]["lo"] == counts[b]["hi"]:
                    return counts[b]["lo"]
                low, high = counts[b]["lo"], counts[b]["hi"]
                break
            left -= counts[b]["n"]


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = BUCKETS, label_rows: int = LABEL_ROWS,
             seed: int = SEED, temperature: float = TEMPERATURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, mark, n_grams, weight, key, kept."""
    sample = F.broadcast(label_sample(labels, label_rows))
    own = docs.select(F.col(id_col).cast("long").alias("id"), text_mark(F.col(text_col)).alias("mark"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marked = own.join(sample, own.id == sample.label_id, "left").drop("label_id")
    ratios = fit_models(marked.select("text", F.coalesce((F.col("good") == 1) & (F.col("toxic") == 0) & F.col("fit"), F.lit(False)).alias("in_target")), buckets)
    keys = stored(weigh(marked, ratios, seed, temperature), "importance")
    if k is None:
        held = keys.where("not fit and good is not null").groupBy("id").agg(F.max("key"), F.max("good")).toArrow()
        cut = best_cut(held.column(1).to_numpy(), held.column(2).to_numpy() == 1) if held.num_rows and ratios.any() else None
        k = keys.count() if cut is None else keys.where(F.col("key") >= cut).count()
    threshold = kth_largest(keys, k)
    return keys.select(F.col("id").alias(id_col), "mark", "n_grams", "weight", "key", (F.col("key") >= F.lit(float(threshold))).alias("kept"))


def without_rejected(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept documents, with all their columns."""
    bad = verdicts.where("not kept").select(F.col(id_col).alias("__bad_id"), F.col("mark").alias("__bad_mark")).distinct()
    return docs.join(bad, F.col("__bad_id").eqNullSafe(docs[id_col].cast("long")) & (F.col("__bad_mark") == text_mark(docs[text_col])), "left_anti")
