"""Benchmark decontamination: windows of benchmark words looked up in the windows of every document.

The hashes of all distinct benchmark windows form a hash set that is broadcast when a count shows that it is small, and
joined by a shuffle otherwise. Documents meet it with one hash per word; a hit counts only after its words are compared.

Defined results: null or wordless text has no windows and is clean. Items without words are ignored, as are null item
ids. Rows that share an id are judged each by its own text; equal rows stay as many as they were. Very long texts are
scanned whole. With an empty benchmark all documents are clean; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import plain_words, repeated, text_mark, with_window_hashes

WINDOW = 10
# At most this many distinct windows are broadcast, about 100 bytes each.
BROADCAST_WINDOWS = 500_000


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: hash, length, their words as one string, and the items that hold them."""
    items = (benchmark.select(F.col(id_col).alias("item"), plain_words(F.col(text_col)).alias("words"))
             .where("size(words) > 0").withColumn("length", F.least(F.size("words"), F.lit(window))))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    cut = items.select("item", "length", F.explode(F.transform(starts, lambda i: F.slice("words", i, F.col("length")))).alias("words"))
    grouped = cut.groupBy("length", "words").agg(F.collect_set("item").alias("items"))
    # Every length gets its hash the way documents get theirs.
    hashed = with_window_hashes(grouped, "words", tuple(range(1, window + 1)))
    pick = reduce(lambda c, n: c.when(F.col("length") == n, F.element_at(f"w{n}", 1)), range(2, window + 1),
                  F.when(F.col("length") == 1, F.element_at("w1", 1)))
    return hashed.select(pick.alias("hash"), "length", F.array_join("words", " ").alias("window_words"), "items")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                       text_col: str = "text", broadcast_limit: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: id, text_mark, n_words, spans (start, length in words) and the items found."""
    windows = benchmark_windows(benchmark, window)
    stats = windows.agg(F.count("*"), F.collect_set("length")).first()
    lengths = tuple(sorted(stats[1]))
    windows = windows.withColumn("items", F.col("items").cast("array<bigint>"))
    words = docs.select(F.col(id_col).alias("id"), text_mark(F.col(text_col)).alias("mark"), plain_words(F.col(text_col)).alias("words"))
    hashed = with_window_hashes(words, "words", lengths)
    find = _found_by_broadcast if stats[0] <= broadcast_limit else _found_by_shuffle
    found = find(hashed, windows, lengths)
    per_doc = found.groupBy("id", "mark", "n_words").agg(
        F.count_if("itself").alias("copies"), F.collect_set("span").alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return repeated(per_doc, "copies").select(F.col("id").alias(id_col), "mark", F.col("n_words").cast("long"), "spans", "items",
                                              hit_words(F.col("spans")).alias("n_hit"))


def _places(hashed: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """A row for each window of each document, and one with place 0 and hash 0 for the document itself."""
    every = F.concat(F.array(F.lit(0).cast("long")), *(F.col(f"w{n}") for n in lengths))
    return hashed.select("id", "mark", "words", F.size("words").alias("n_words"), F.posexplode(every).alias("place", "doc_hash"))


def _window(start: Column) -> Column:
    return F.array_join(F.slice("words", start + 1, F.col("length")), " ")


def _found_by_broadcast(hashed: DataFrame, windows: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """Hits and documents in one pass: the words are compared where the hash meets the broadcast set."""
    itself = hashed.sparkSession.range(1).select(F.lit(0).cast("long").alias("hash"), F.lit(-1).alias("length"),
                                                 F.lit("").alias("window_words"), F.array().cast("array<bigint>").alias("items"))
    start, length = _decoded(lengths)
    same = (F.col("length") == length) & (F.col("window_words") == _window(start))
    hits = _places(hashed, lengths).join(F.broadcast(windows.unionByName(itself)), (F.col("doc_hash") == F.col("hash")) & F.when(
        F.col("place") == 0, F.col("length") == -1).otherwise(same))
    return hits.select("id", "mark", "n_words", "items", (F.col("place") == 0).alias("itself"),
                       F.when(F.col("place") > 0, F.struct(start.cast("long").alias("start"), F.col("length"))).alias("span"))


def _found_by_shuffle(hashed: DataFrame, windows: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """The same for a benchmark of any size: only hashes and places are shuffled, and candidates go back to their words."""
    start, length = _decoded(lengths)
    narrow = _places(hashed, lengths).where("place > 0").select("id", "mark", "n_words", start.alias("start"), length.alias("doc_length"), "doc_hash")
    near = narrow.join(windows, (F.col("doc_hash") == F.col("hash")) & (F.col("doc_length") == F.col("length")))
    texts = hashed.select(F.col("id").alias("own_id"), F.col("mark").alias("own_mark"), "words").dropDuplicates(["own_id", "own_mark"])
    checked = near.join(texts, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))).where(
        F.col("window_words") == _window(F.col("start")))
    itself = hashed.select("id", "mark", F.size("words").alias("n_words"), F.array().cast("array<bigint>").alias("items"), F.lit(True).alias("itself"),
                           F.lit(None).cast("struct<start:bigint,length:int>").alias("span"))
    return itself.unionByName(checked.select("id", "mark", "n_words", "items", F.lit(False).alias("itself"), F.struct(
        F.col("start").cast("long").alias("start"), "length").alias("span")))


def _decoded(lengths: tuple[int, ...]) -> tuple[Column, Column]:
    """Start and length of the window at ``place`` among the joined arrays of all lengths."""
    start, length, before = F.lit(0), F.lit(0), F.lit(1)
    for n in lengths:
        size = F.greatest(F.col("n_words") - (n - 1), F.lit(0))
        inside = (F.col("place") >= before) & (F.col("place") < before + size)
        start = F.when(inside, F.col("place") - before).otherwise(start)
        length = F.when(inside, F.lit(n)).otherwise(length)
        before = before + size
    return start, length


def hit_words(spans: Column) -> Column:
    """Words inside any span."""
    places = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    return F.size(F.array_distinct(places)).cast("long")


def without_contaminated(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without a hit, with all their columns."""
    bad = verdicts.where("n_hit > 0").select(F.col(id_col).alias("__bad_id"), F.col("mark").alias("__bad_mark")).distinct()
    return docs.join(bad, F.col("__bad_id").eqNullSafe(docs[id_col]) & (F.col("__bad_mark") == text_mark(docs[text_col])), "left_anti")


def without_spans(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents; hit words are cut out together with what separates them from the next word."""
    # The word characters of text that is not lower-cased, and the rest.
    word, rest = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    bad = verdicts.where("n_hit > 0").select(F.col(id_col).alias("__bad_id"), F.col("mark").alias("__bad_mark"), F.col("spans").alias("__bad_spans"))
    bad = bad.dropDuplicates(["__bad_id", "__bad_mark"])
    both = docs.withColumn("__text_parts", F.when(F.col(text_col).isNotNull(), F.struct(
        F.array_remove(F.split(text_col, rest, -1), "").alias("w"), F.split(text_col, word, -1).alias("s"))))
    both = both.join(bad, F.col("__bad_id").eqNullSafe(both[id_col]) & (F.col("__bad_mark") == text_mark(both[text_col])), "left")
    hit = F.flatten(F.transform("__bad_spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    left = F.array_except(F.sequence(F.lit(0).cast("long"), F.size("__text_parts.w").cast("long") - 1), hit)
    rebuilt = F.concat(F.element_at("__text_parts.s", 1), F.array_join(F.transform(left, lambda i: F.concat(
        F.get("__text_parts.w", i.cast("int")), F.get("__text_parts.s", i.cast("int") + 1))), ""))
    text = F.when(F.col("__bad_spans").isNull(), F.col(text_col)).otherwise(rebuilt)
    return both.withColumn(text_col, text).select(*docs.columns)
