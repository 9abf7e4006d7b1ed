"""URL filters: host and path rules, and a ratio of two character language models for the urls that no rule judges.

Urls with a rule's verdict are the accepted and the rejected training texts. For each class a Markov model of order 0 to
4 over bytes is counted, context by context; a longer context is smoothed by the shorter one. A url's score is the
difference of the two log-likelihoods per byte. A fifth of the ruled urls, picked by hash, is not counted but used to
find the cut with the fewest errors (both classes weighing the same); urls at or above the cut are allowed.

The model is a table with a row for each distinct window (a byte and the four before it) and grows with the urls: nothing
of it is collected or of a fixed size. Windows are gathered by chunks of urls, so a window of all urls meets the model
once for each chunk, and each chunk gets the values of its windows back.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule; a null url scores 0 and is
judged like the empty text. Equal urls get equal verdicts and all rows stay. Urls of any length are read whole. If one
class has no url, everything without a rule is allowed. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality_classifier import best_cut
from .shared import lower_ascii, small_batches, stored
from .text_arrays import Texts, slices

ORDERS = 5
STRENGTH = 2.0
# A window holds its symbols in nine bits each, the last one lowest: bytes, and one more symbol before the begin of a url.
BITS, BEGIN = 9, 256
# Urls are dealt out in chunks of about so many bytes.
CHUNK_BYTES = 1 << 19

# Rules as host and path, with their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return lower_ascii(F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits; null if none does."""
    chosen = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        chosen = F.when(fits, rule) if chosen is None else chosen.when(fits, rule)
    return chosen if chosen is not None else F.lit(None).cast("string")


def url_windows(texts: Texts) -> np.ndarray:
    """For every byte the window of it and the four symbols before."""
    n = len(texts.bytes)
    value = texts.bytes.astype(np.int64)
    begin, where = np.repeat(texts.offsets[:-1], np.diff(texts.offsets)), np.arange(n)
    found = value.copy()
    for back in range(1, ORDERS):
        found |= np.where(where - back >= begin, value[np.maximum(where - back, 0)], BEGIN) << (BITS * back)
    return found


def chunked(urls: DataFrame) -> DataFrame:
    """``urls`` (with a column url) and the chunk of each row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            sizes = before + np.cumsum(64 + pc.fill_null(pc.binary_length(batch.column("url")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            before = int(sizes[-1]) if len(sizes) else before
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((task << 32) | (sizes // CHUNK_BYTES))], names=[*batch.schema.names, "chunk"])

    return urls.mapInArrow(work, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema), "chunk long"]))


def chunk_windows(urls: DataFrame) -> DataFrame:
    """(chunk, window, a, r): the distinct windows of each chunk, and how often they stand in urls with accepted 1 and 0."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "url"):
            if not len(texts.bytes):
                continue
            lengths = np.diff(texts.offsets)
            chunks, local = np.unique(part.column("chunk").to_numpy(), return_inverse=True)
            accepted = np.repeat(pc.fill_null(part.column("accepted"), -1).to_numpy(zero_copy_only=False), lengths)
            keys, back = np.unique((np.repeat(local, lengths).astype(np.int64) << (BITS * ORDERS)) | url_windows(texts), return_inverse=True)
            counts = [pa.array(np.bincount(back[accepted == side], minlength=len(keys)).astype(np.int64)) for side in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(chunks[keys >> (BITS * ORDERS)]), pa.array(keys & ((1 << (BITS * ORDERS)) - 1)), *counts],
                                             names=["chunk", "window", "a", "r"])

    found = urls.select("url", "chunk", "accepted").mapInArrow(work, "chunk long, window long, a long, r long")
    return found.groupBy("chunk", "window").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))


def window_ratios(counts: DataFrame) -> DataFrame:
    """(window, ratio): log P(accepted) - log P(rejected) of each window's byte after its context. ``counts``: window, a, r."""
    levels = [counts.select(F.col("window").alias("key"), "a", "r")]
    for order in range(ORDERS - 2, -1, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << (BITS * (order + 1))) - 1))
        levels.append(levels[-1].groupBy(shorter.alias("key")).agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    model = None
    for order, level in enumerate(reversed(levels)):
        # A context has a row for each symbol after it, and a shorter window one for each symbol before it: 257 at most.
        context = Window.partitionBy(F.shiftright("key", BITS))
        seen = level.select("key", "a", "r", F.sum("a").over(context).alias("sa"), F.sum("r").over(context).alias("sr"))
        if model is None:
            seen = seen.withColumns({"pa": F.lit(1 / 256), "pr": F.lit(1 / 256)})
        else:
            seen = seen.withColumn("shorter", F.col("key").bitwiseAND(F.lit((1 << (BITS * order)) - 1))).join(model.withColumnRenamed("key", "shorter"), "shorter")
        model = seen.select("key", *(((F.col(n) + STRENGTH * F.col(f"p{n}")) / (F.col(f"s{n}") + STRENGTH)).alias(f"p{n}") for n in ("a", "r")))
    return model.select(F.col("key").alias("window"), (F.log("pa") - F.log("pr")).alias("ratio"))


def scored_urls(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """``urls`` (with url and chunk) and their score: the mean ratio of the windows; 0 for an empty url. ``ratios``: chunk, window, ratio."""
    names = urls.columns

    def work(rows: pa.Table, values: pa.Table) -> pa.Table:
        window, ratio = values.column("window").to_numpy(), values.column("ratio").to_numpy()
        order = np.argsort(window)
        window, ratio = window[order], ratio[order]
        made = []
        for part, texts in slices(iter(rows.select(names).combine_chunks().to_batches()), "url"):
            lengths = np.diff(texts.offsets)
            owner = np.repeat(np.arange(texts.n), lengths)
            each = ratio[np.searchsorted(window, url_windows(texts))] if len(owner) else np.zeros(0)
            score = np.bincount(owner, weights=each, minlength=texts.n) / np.maximum(lengths, 1)
            made.append(pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*names, "score"]))
        return pa.Table.from_batches(made)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema), "score double"])
    return urls.groupBy("chunk").cogroup(ratios.groupBy("chunk")).applyInArrow(work, schema)


def judge_urls(pages: DataFrame, rules: dict[str, str] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, score and verdict."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = small_batches(pages).select(F.col(id_col).alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*(F.lit(x) for pair in rules.items() for x in pair)) if rules else F.create_map().cast("map<string,string>")
    ruled = ruled.withColumn("ruled", F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule"))))
    # Equal urls fall on the same side of the split.
    ruled = ruled.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(5)) == 0)
    ruled = stored(chunked(ruled), "urls")
    known = F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "allow").cast("int"))
    used = stored(chunk_windows(ruled.withColumn("accepted", F.when(~F.col("held"), known))), "windows")
    counts = stored(used.groupBy("window").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "counts")
    scored = stored(scored_urls(ruled, used.select("chunk", "window").join(window_ratios(counts), "window")), "scored")
    bins = (scored.where("held and ruled is not null").groupBy(F.round("score", 3).alias("score"), known.alias("accepted"))
            .agg(F.count("*").alias("n")).toArrow())
    cut, both = None, counts.agg(F.max("a"), F.max("r")).first()
    if bins.num_rows and both[0] and both[1]:
        cut = best_cut(bins.column(0).to_numpy(), bins.column(1).to_numpy() == 1, bins.column(2).to_numpy())
    own = F.when(F.col("score") >= F.lit(float(cut) if cut is not None else float("-inf")), "allow").otherwise("block")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", "score", F.coalesce("ruled", own).alias("verdict"))
